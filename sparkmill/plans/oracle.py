"""Equivalent SQL for the registered queries, written for DuckDB over the
same parquet tables (views named after the tables).

The SQL is an independent formulation: brute-force self-joins where the
Spark plan salts and prunes, window row numbers where Spark range-sorts,
unrolled CTEs where Spark loops.
"""

from __future__ import annotations

import warnings

from sparkmill.functions.weblog import LOG_PATTERN, MONTHS
from sparkmill.plans import queries as Q
from sparkmill.sources.stopwords import spark_stop_words
from sparkmill.sources.tables import STATUS_BY_TYPE

WS = r"[ \t\n\r\f\x0B]"
NOT_KEPT = r"[^a-z0-9 \t\n\r\f\x0B]"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(xs) -> str:
    return "[" + ", ".join(_lit(x) for x in xs) + "]"


def _clean_expr(col: str) -> str:
    return f"regexp_replace(lower({col}), '{NOT_KEPT}', '', 'g')"


def _tokens(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, '{WS}+'), lambda t: t <> '')"


def _word_count(expr: str) -> str:
    return (f"SELECT word, count(*) AS n FROM (SELECT unnest({_tokens(expr)}) AS word FROM documents) "
            f"GROUP BY word")


def _clean_docs() -> str:
    stop = _list(spark_stop_words("english"))
    return (f"SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(lower({_clean_expr('text')}), "
            f"'\\W+'), lambda t: t <> '' AND NOT list_contains({stop}, t)), ' ') AS text FROM documents")

# ------------------------------------------------------------------ web log
_status = " ".join(f"WHEN {_lit(k)} THEN {v}" for k, v in STATUS_BY_TYPE.items())
LOG_LINES = f"""
ev AS (SELECT event_id, ts, user_id, event_type, value,
              TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
lines AS (SELECT event_id, CASE WHEN k >= 97 THEN 'corrupt record ' || CAST(event_id AS VARCHAR) ELSE
   'host' || CAST(user_id AS VARCHAR) || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0400] "GET /'
   || event_type || '/' || coalesce(CAST(k AS VARCHAR), 'x') || ' HTTP/1.0" '
   || CAST((CASE event_type {_status} ELSE 500 END) AS VARCHAR) || ' '
   || (CASE WHEN event_type IN ('view', 'signup') THEN '-'
            ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END) END AS raw FROM ev),
g AS (SELECT raw, regexp_matches(raw, {_lit(LOG_PATTERN)}) AS m,
      {", ".join(f"regexp_extract(raw, {_lit(LOG_PATTERN)}, {i}) AS g{i}" for i in range(1, 10))} FROM lines),
recs AS (SELECT
   CASE WHEN m THEN g1 END AS host, CASE WHEN m THEN g2 END AS client_identd,
   CASE WHEN m THEN g3 END AS user_id,
   CASE WHEN m THEN make_timestamp(CAST(substr(g4, 8, 4) AS BIGINT),
        list_position({_list(MONTHS)}, substr(g4, 4, 3)), CAST(substr(g4, 1, 2) AS BIGINT),
        CAST(substr(g4, 13, 2) AS BIGINT), CAST(substr(g4, 16, 2) AS BIGINT),
        CAST(substr(g4, 19, 2) AS DOUBLE)) END AS date_time,
   CASE WHEN m THEN g5 END AS method, CASE WHEN m THEN g6 END AS endpoint,
   CASE WHEN m THEN g7 END AS protocol, CASE WHEN m THEN CAST(g8 AS INTEGER) END AS response_code,
   CASE WHEN m THEN (CASE WHEN g9 = '-' THEN CAST(0 AS BIGINT) ELSE CAST(g9 AS BIGINT) END) END AS content_size,
   m AS is_valid, raw FROM g)
"""


def _with_log(body: str) -> str:
    return "WITH " + LOG_LINES + body


# ------------------------------------------------------------------ ratings
RATINGS = """
ratings AS (SELECT o.o_custkey AS "user", l.l_partkey AS item,
                   CAST(max(ceil(l.l_quantity / 10)) AS DOUBLE) AS rating,
                   CAST(max(epoch(o.o_orderdate)) AS BIGINT) AS ts
            FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2)
"""
SPLIT = RATINGS + f""",
numbered AS (SELECT *, row_number() OVER (ORDER BY ts, "user", item) AS rn, count(*) OVER () AS total
             FROM ratings),
cuts AS (SELECT *, floor(total * CAST({Q.SPLIT_TEST} AS DOUBLE)) AS c1,
                floor(total * CAST({Q.SPLIT_TEST} AS DOUBLE)) + floor(total * CAST({Q.SPLIT_VALID} AS DOUBLE)) AS c2
         FROM numbered),
split AS (SELECT "user", item, rating, ts,
                 CASE WHEN rn <= c1 THEN 'test' WHEN rn <= c2 THEN 'valid' ELSE 'train' END AS split FROM cuts),
train AS (SELECT "user", item, rating, ts FROM split WHERE split = 'train'),
valid AS (SELECT "user", item, rating, ts FROM split WHERE split = 'valid'),
test AS (SELECT "user", item, rating, ts FROM split WHERE split = 'test')
"""


def _sims(src: str, base: str, over: str, name: str) -> str:
    key = f'"{base}"'
    over = f'"{over}"'
    return f"""
{name}_nrm AS (SELECT {key} AS k, sqrt(sum(rating * rating)) AS norm FROM {src} GROUP BY 1),
{name}_dots AS (SELECT a.{key} AS {base}_1, b.{key} AS {base}_2, sum(a.rating * b.rating) AS dot,
                       count(*) AS n_common
                FROM {src} a JOIN {src} b ON a.{over} = b.{over} AND a.{key} < b.{key} GROUP BY 1, 2),
{name} AS (SELECT {base}_1, {base}_2, dot, n_common,
                  CASE WHEN n1.norm * n2.norm = 0 THEN 0.0 ELSE dot / (n1.norm * n2.norm) END AS sim
           FROM {name}_dots JOIN {name}_nrm n1 ON n1.k = {base}_1 JOIN {name}_nrm n2 ON n2.k = {base}_2),
{name}_both AS (SELECT {base}_1 AS k, {base}_2 AS other, sim FROM {name}
                UNION ALL SELECT {base}_2, {base}_1, sim FROM {name})
"""


def _item_cf(target_src: str, name: str) -> str:
    return f"""
{name} AS (SELECT c."user", c.target AS item, sum(b.sim * c.rating) / sum(b.sim) AS prediction
           FROM (SELECT t."user", t.item AS target, r.item AS other, r.rating
                 FROM {target_src} t JOIN train r ON r."user" = t."user") c
           JOIN isim_both b ON b.k = c.target AND b.other = c.other
           GROUP BY 1, 2 HAVING sum(b.sim) <> 0)
"""


def _user_cf(target_src: str, name: str) -> str:
    return f"""
{name} AS (SELECT c.target AS "user", c.item, sum(b.sim * c.rating) / sum(b.sim) AS prediction
           FROM (SELECT t."user" AS target, t.item, r."user" AS other, r.rating
                 FROM {target_src} t JOIN train r ON r.item = t.item) c
           JOIN usim_both b ON b.k = c.target AND b.other = c.other
           GROUP BY 1, 2 HAVING sum(b.sim) <> 0)
"""


def _rmse(pred: str, actual: str) -> str:
    return (f"SELECT round(sqrt(avg(power(p.prediction - a.rating, 2))), 6) AS rmse, count(*) AS n "
            f"FROM {pred} p JOIN {actual} a ON p.\"user\" = a.\"user\" AND p.item = a.item")


HASH_SPLIT = ("CASE WHEN CAST('0x' || substr(md5('0,' || \"user\" || ',' || item), 1, 8) AS BIGINT) % 10 < 8 THEN 'train' "
              "WHEN CAST('0x' || substr(md5('0,' || \"user\" || ',' || item), 1, 8) AS BIGINT) % 10 < 9 THEN 'valid' "
              "ELSE 'test' END")


def _baseline(target: str, name: str) -> str:
    return f"""
{name} AS (SELECT t."user", t.item, coalesce(um.um, mu.mu) + coalesce(im.im, mu.mu) - mu.mu AS prediction
         FROM {target} t CROSS JOIN mu LEFT JOIN um ON um."user" = t."user" LEFT JOIN im ON im.item = t.item)
"""


BASELINE = """,
mu AS (SELECT avg(rating) AS mu FROM train),
um AS (SELECT "user", avg(rating) AS um FROM train GROUP BY 1),
im AS (SELECT item, avg(rating) AS im FROM train GROUP BY 1),
base AS (SELECT t."user", t.item, coalesce(um.um, mu.mu) + coalesce(im.im, mu.mu) - mu.mu AS prediction
         FROM test t CROSS JOIN mu LEFT JOIN um ON um."user" = t."user" LEFT JOIN im ON im.item = t.item)
"""

# ------------------------------------------------------------------ graph
EDGES = """
lo AS (SELECT l.l_partkey, l.l_suppkey, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
edges AS (SELECT DISTINCT src, dst FROM (
    SELECT 'p' || CAST(l_partkey AS VARCHAR) AS src, 's' || CAST(l_suppkey AS VARCHAR) AS dst FROM lineitem
    UNION ALL SELECT 's' || CAST(l_suppkey AS VARCHAR), 'c' || CAST(o_custkey AS VARCHAR) FROM lo
    UNION ALL SELECT 'c' || CAST(o_custkey AS VARCHAR), 'p' || CAST(l_partkey AS VARCHAR) FROM lo
    UNION ALL SELECT 'o' || CAST(o_orderkey AS VARCHAR), 'c' || CAST(o_custkey AS VARCHAR) FROM orders
    UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR), 'n' || CAST(c_nationkey AS VARCHAR) FROM customer
    UNION ALL SELECT 'n' || CAST(n_nationkey AS VARCHAR), 'r' || CAST(n_regionkey AS VARCHAR) FROM nation)),
degs AS (SELECT node, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree FROM (
    SELECT src AS node, 1 AS o, 0 AS i FROM edges UNION ALL SELECT dst, 0, 1 FROM edges) GROUP BY node)
"""


def _pagerank(rounds: int) -> str:
    parts = [EDGES, ",\nodeg AS (SELECT src, count(*) AS d FROM edges GROUP BY src)",
             ",\nr0 AS (SELECT src AS node, CAST(1.0 AS DOUBLE) AS rank FROM odeg)"]
    for i in range(1, rounds + 1):
        parts.append(
            f",\nr{i} AS (SELECT e.dst AS node, sum(r.rank / d.d) * CAST(0.85 AS DOUBLE) + CAST(0.15 AS DOUBLE) AS rank "
            f"FROM edges e JOIN odeg d ON d.src = e.src JOIN r{i - 1} r ON r.node = e.src GROUP BY e.dst)")
    return "".join(parts)


PR = _pagerank(Q.PAGERANK_ROUNDS)
FINAL = f"r{Q.PAGERANK_ROUNDS}"

# ------------------------------------------------------------------ word sets
def _wordsets() -> str:
    return f"""
clean AS ({_clean_docs()}),
thr AS (SELECT CAST(floor(CAST({Q.SUPPORT_FRACTION} AS DOUBLE) * count(*)) AS BIGINT) AS t FROM documents),
dw AS (SELECT DISTINCT doc_id AS doc, word FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM clean)
       WHERE word <> ''),
dwf AS (SELECT * FROM dw WHERE word IN (SELECT word FROM dw GROUP BY word HAVING count(*) > (SELECT t FROM thr))),
l2 AS (SELECT a.word AS w1, b.word AS w2, count(*) AS support FROM dwf a JOIN dwf b ON a.doc = b.doc AND a.word < b.word
       GROUP BY 1, 2 HAVING count(*) > (SELECT t FROM thr)),
o3 AS (SELECT a.doc, a.word AS w1, b.word AS w2, c.word AS w3
       FROM dwf a JOIN dwf b ON a.doc = b.doc AND a.word < b.word
       JOIN l2 p ON p.w1 = a.word AND p.w2 = b.word
       JOIN dwf c ON c.doc = a.doc AND b.word < c.word),
l3 AS (SELECT w1, w2, w3, count(*) AS support FROM o3 GROUP BY 1, 2, 3 HAVING count(*) > (SELECT t FROM thr)),
l4 AS (SELECT o.w1, o.w2, o.w3, d.word AS w4, count(*) AS support
       FROM o3 o JOIN l3 x ON x.w1 = o.w1 AND x.w2 = o.w2 AND x.w3 = o.w3
       JOIN dwf d ON d.doc = o.doc AND o.w3 < d.word
       GROUP BY 1, 2, 3, 4 HAVING count(*) > (SELECT t FROM thr))
"""


def _texts() -> dict:
    """SQL, or a function that builds it, per query."""
    sql = {
        "word_count_raw": _word_count("text"),
        "word_count_lower": _word_count("lower(text)"),
        "word_count_clean": _word_count(_clean_expr("text")),
        "word_count_lower_top10_ties": (
            f"WITH c AS MATERIALIZED ({_word_count('lower(text)')}) "
            f"SELECT word, n FROM c QUALIFY rank() OVER (ORDER BY n DESC) <= {Q.TOP_WORDS_TIES}"),
        "word_count_clean_top20": (
            f"{_word_count(_clean_expr('text'))} ORDER BY n DESC, word LIMIT {Q.TOP_WORDS}"),
        "clean_documents": _clean_docs,
        "log_records": _with_log("SELECT * FROM recs"),
        "log_parse_stats": _with_log(
            "SELECT count(*) AS n_read, count(*) FILTER (WHERE is_valid) AS n_parsed, "
            "count(*) FILTER (WHERE NOT is_valid) AS n_failed FROM recs"),
        "log_invalid_sample": _with_log(
            f"SELECT raw FROM recs WHERE NOT is_valid ORDER BY raw LIMIT {Q.INVALID_SAMPLE}"),
        "log_top_error_endpoints": _with_log(
            "SELECT endpoint, count(*) AS n FROM recs WHERE is_valid AND response_code <> 200 "
            f"GROUP BY endpoint ORDER BY n DESC, endpoint LIMIT {Q.TOP_ERRORS}"),
        "log_unique_hosts": _with_log("SELECT count(DISTINCT host) AS n_hosts FROM recs WHERE is_valid"),
        "log_daily_hosts": _with_log(
            "SELECT CAST(day(date_time) AS INTEGER) AS day, count(DISTINCT host) AS n_hosts FROM recs "
            f"WHERE is_valid GROUP BY 1 ORDER BY 1 LIMIT {Q.DAYS}"),
        "log_404_count": _with_log(
            "SELECT count(*) FILTER (WHERE is_valid AND response_code = 404) AS n_404 FROM recs"),
        "log_top_404_endpoints": _with_log(
            "SELECT endpoint, count(*) AS n FROM recs WHERE is_valid AND response_code = 404 "
            f"GROUP BY endpoint ORDER BY n DESC, endpoint LIMIT {Q.TOP_404}"),
        "ratings": f"WITH {RATINGS} SELECT * FROM ratings",
        "item_rating_stats": (
            f"WITH {RATINGS}, s AS (SELECT item, count(*) AS n_ratings, avg(rating) AS avg_rating FROM ratings "
            "GROUP BY item) SELECT s.item, p.p_name AS title, s.n_ratings, round(s.avg_rating, 6) AS avg_rating "
            "FROM s JOIN part p ON p.p_partkey = s.item"),
        "top_rated_items": (
            f"WITH {RATINGS}, s AS (SELECT item, count(*) AS n_ratings, avg(rating) AS avg_rating FROM ratings "
            f"GROUP BY item HAVING count(*) > {Q.MIN_RATINGS}) "
            "SELECT round(s.avg_rating, 6) AS avg_rating, p.p_name AS title, s.n_ratings, s.item "
            "FROM s JOIN part p ON p.p_partkey = s.item "
            f"ORDER BY round(s.avg_rating, 3) DESC, title DESC, s.item DESC LIMIT {Q.TOP_RATED}"),
        "global_mean": f"WITH {RATINGS} SELECT round(avg(rating), 6) AS global_mean FROM ratings",
        "user_means": (f"WITH {RATINGS} SELECT \"user\", round(avg(rating), 6) AS user_mean, count(*) AS n_ratings "
                       "FROM ratings GROUP BY 1"),
        "item_means": (f"WITH {RATINGS} SELECT item, round(avg(rating), 6) AS item_mean, count(*) AS n_ratings "
                       "FROM ratings GROUP BY 1"),
        "ratings_dat_files": f"WITH {RATINGS} SELECT * FROM ratings",
        "ratings_csv_files": f"WITH {RATINGS} SELECT * FROM ratings",
        "rated_movie_files": (
            f"WITH {RATINGS}, s AS (SELECT item, count(*) AS n_ratings, avg(rating) AS avg_rating FROM ratings GROUP BY item) "
            "SELECT s.item, p.p_name AS title, p.p_type AS genres, s.n_ratings, round(s.avg_rating, 6) AS avg_rating FROM s JOIN part p ON p.p_partkey = s.item"),
        "split_files": f"WITH {SPLIT} SELECT \"user\", item, rating, ts, split FROM split",
        "clean_document_lines": lambda: f"SELECT text FROM ({_clean_docs()})",
        "whole_file_word_counts": lambda: f"SELECT word, count(*) AS n FROM (SELECT unnest({_tokens('text')}) AS word FROM ({_clean_docs()})) GROUP BY word",
        "stop_word_file_counts": (
            f"WITH c AS MATERIALIZED ({_word_count(_clean_expr('text'))}), stop AS (SELECT word FROM c QUALIFY rank() OVER (ORDER BY n DESC) <= {Q.TOP_WORDS}), "
            f"t AS (SELECT unnest(regexp_split_to_array(lower({_clean_expr('text')}), '\\W+')) AS word FROM documents) "
            "SELECT word, count(*) AS n FROM t WHERE word <> '' AND word NOT IN (SELECT word FROM stop) GROUP BY word"),
        "access_log_files": _with_log("SELECT * FROM recs"),
        "edge_list_files": f"WITH {EDGES} SELECT src, dst FROM edges",
        "log_stats_observed": _with_log(
            "SELECT count(*) AS n_read, count(*) FILTER (WHERE is_valid) AS n_parsed, count(*) FILTER (WHERE NOT is_valid) AS n_failed FROM recs"),
        "log_sketched_hosts": _with_log(
            ", v AS (SELECT host, CAST(day(date_time) AS INTEGER) AS day FROM recs WHERE is_valid) "
            "SELECT CAST(day AS VARCHAR) AS days, count(DISTINCT host) AS n_hosts, true AS within FROM v GROUP BY day "
            "UNION ALL SELECT 'all', count(DISTINCT host), true FROM v UNION ALL SELECT '8-14', count(DISTINCT host), true FROM v WHERE day BETWEEN 8 AND 14"),
        "random_split": f"WITH {RATINGS} SELECT \"user\", item, {HASH_SPLIT} AS split FROM ratings",
        "random_split_counts": (f"WITH {RATINGS} SELECT {HASH_SPLIT} AS split, count(*) AS n FROM ratings "
                                "GROUP BY 1"),
        "time_split": f"WITH {SPLIT} SELECT \"user\", item, rating, ts, split FROM split",
        "time_split_counts": f"WITH {SPLIT} SELECT split, count(*) AS n FROM split GROUP BY split",
        "baseline_predict": (f"WITH {SPLIT}{BASELINE} SELECT \"user\", item, round(prediction, 6) AS prediction "
                             "FROM base"),
        "baseline_rmse": f"WITH {SPLIT}{BASELINE} {_rmse('base', 'test')}",
        "item_norms": (f"WITH {RATINGS} SELECT item, round(sqrt(sum(rating * rating)), 6) AS norm FROM ratings "
                       "GROUP BY item"),
        "user_norms": (f"WITH {RATINGS} SELECT \"user\", round(sqrt(sum(rating * rating)), 6) AS norm "
                       "FROM ratings GROUP BY 1"),
        "item_cosine": (f"WITH {RATINGS}, {_sims('ratings', 'item', 'user', 'isim')} "
                        "SELECT item_1, item_2, round(dot, 6) AS dot, n_common, round(sim, 6) AS sim FROM isim"),
        "item_cosine_sampled": (f"WITH {RATINGS}, {_sims('ratings', 'item', 'user', 'isim')} "
                                f"SELECT count(*) AS n_similar, true AS recalled, true AS within FROM isim WHERE sim >= {Q.SIMILAR} - 1e-9"),
        "user_cosine": (f"WITH {RATINGS}, {_sims('ratings', 'user', 'item', 'usim')} "
                        "SELECT user_1, user_2, round(dot, 6) AS dot, n_common, round(sim, 6) AS sim FROM usim"),
        "item_neighbors_top10": (
            f"WITH {RATINGS}, {_sims('ratings', 'item', 'user', 'isim')}, "
            "ranked AS (SELECT k AS item, other, sim, row_number() OVER (PARTITION BY k "
            "ORDER BY round(sim, 9) DESC, other) AS rank FROM isim_both) "
            f"SELECT item, other, round(sim, 6) AS sim, CAST(rank AS INTEGER) AS rank FROM ranked "
            f"WHERE rank <= {Q.NEIGHBORS}"),
        "user_neighbors_top10": (
            f"WITH {RATINGS}, {_sims('ratings', 'user', 'item', 'usim')}, "
            "ranked AS (SELECT k AS \"user\", other, sim, row_number() OVER (PARTITION BY k "
            "ORDER BY round(sim, 9) DESC, other) AS rank FROM usim_both) "
            f"SELECT \"user\", other, round(sim, 6) AS sim, CAST(rank AS INTEGER) AS rank FROM ranked "
            f"WHERE rank <= {Q.NEIGHBORS}"),
        "ratings_by_time": (f"WITH {RATINGS} SELECT *, row_number() OVER (ORDER BY ts, \"user\", item) AS position "
                            "FROM ratings"),
        "item_cf_predict": (
            f"WITH {SPLIT}, {_sims('train', 'item', 'user', 'isim')}, {_item_cf('test', 'ip')} "
            "SELECT \"user\", item, round(prediction, 6) AS prediction FROM ip"),
        "user_cf_predict": (
            f"WITH {SPLIT}, {_sims('train', 'user', 'item', 'usim')}, {_user_cf('test', 'up')} "
            "SELECT \"user\", item, round(prediction, 6) AS prediction FROM up"),
        "cf_rmse": (
            f"WITH {SPLIT}, {_sims('train', 'item', 'user', 'isim')}, "
            f"{_sims('train', 'user', 'item', 'usim')}, "
            f"{_item_cf('valid', 'ipv')}, {_item_cf('test', 'ipt')}, {_user_cf('valid', 'upv')}, "
            f"{_user_cf('test', 'upt')} "
            f"SELECT 'item_cf' AS method, 'valid' AS split, * FROM ({_rmse('ipv', 'valid')}) "
            f"UNION ALL SELECT 'user_cf', 'valid', * FROM ({_rmse('upv', 'valid')}) "
            f"UNION ALL SELECT 'item_cf', 'test', * FROM ({_rmse('ipt', 'test')}) "
            f"UNION ALL SELECT 'user_cf', 'test', * FROM ({_rmse('upt', 'test')})"),
        "als_scored_pairs": (
            f"WITH {SPLIT} SELECT \"user\", item FROM test WHERE \"user\" IN (SELECT \"user\" FROM train) "
            "AND item IN (SELECT item FROM train)"),
        "method_comparison_checked": (
            f"WITH {SPLIT}{BASELINE}, {_baseline('valid', 'basev')}, {_sims('train', 'item', 'user', 'isim')}, "
            f"{_sims('train', 'user', 'item', 'usim')}, "
            f"{_item_cf('valid', 'ipv')}, {_item_cf('test', 'ipt')}, {_user_cf('valid', 'upv')}, "
            f"{_user_cf('test', 'upt')} "
            + " UNION ALL ".join(
                f"SELECT '{m}' AS method, '{t}' AS split, n, rmse FROM ({_rmse(p, t)})"
                for m, t, p in (("item_cf", "valid", "ipv"), ("user_cf", "valid", "upv"), ("item_cf", "test", "ipt"),
                                ("user_cf", "test", "upt"), ("baseline", "valid", "basev"), ("baseline", "test", "base")))
            + "".join(f" UNION ALL SELECT 'als', '{t}', count(*), NULL FROM {t} WHERE \"user\" IN (SELECT \"user\" FROM train) "
                      "AND item IN (SELECT item FROM train)" for t in ("valid", "test"))),
        "graph_edges": f"WITH {EDGES} SELECT src, dst FROM edges",
        "edge_degrees": f"WITH {EDGES} SELECT node, out_degree, in_degree FROM degs",
        "adjacency": (f"WITH {EDGES} SELECT src, row_number() OVER (PARTITION BY src ORDER BY dst) AS position, dst "
                      "FROM edges"),
        "pagerank_ranks": f"WITH {PR} SELECT node, round(rank, 6) AS rank FROM {FINAL}",
        "pagerank_top20": (f"WITH {PR} SELECT node, round(rank, 6) AS rank FROM {FINAL} "
                           f"ORDER BY round(rank, 9) DESC, node LIMIT {Q.TOP_NODES}"),
        "pagerank_node_report": (
            f"WITH {PR}, top AS (SELECT node, rank FROM {FINAL} ORDER BY round(rank, 9) DESC, node "
            f"LIMIT {Q.TOP_NODES}), "
            f"nb AS (SELECT e.src AS node, sum(coalesce(r.rank, 0)) AS s, count(*) AS c FROM edges e "
            f"JOIN top t ON t.node = e.src LEFT JOIN {FINAL} r ON r.node = e.dst GROUP BY e.src) "
            "SELECT t.node, round(t.rank, 6) AS rank, coalesce(d.out_degree, 0) AS out_degree, "
            "coalesce(d.in_degree, 0) AS in_degree, round(nb.s / nb.c, 6) AS avg_neighbor_rank "
            "FROM top t LEFT JOIN degs d ON d.node = t.node LEFT JOIN nb ON nb.node = t.node"),
        "frequent_words": lambda: (
            f"WITH {_wordsets()} SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word "
            "FROM clean) WHERE word <> '' GROUP BY word HAVING count(*) > (SELECT t FROM thr)"),
        "frequent_pairs": lambda: f"WITH {_wordsets()} SELECT w1, w2, support FROM l2",
        "frequent_triples": lambda: f"WITH {_wordsets()} SELECT w1, w2, w3, support FROM l3",
        "quad_candidates": lambda: (
            f"WITH {_wordsets()} SELECT count(*) AS n_candidates FROM l3 x JOIN l3 y "
            "ON x.w1 = y.w1 AND x.w2 = y.w2 AND x.w3 < y.w3 "
            "WHERE EXISTS (SELECT 1 FROM l3 z WHERE z.w1 = x.w2 AND z.w2 = x.w3 AND z.w3 = y.w3)"),
        "frequent_quads": lambda: f"WITH {_wordsets()} SELECT w1, w2, w3, w4, support FROM l4",
        "frequent_quads_top10": lambda: (f"WITH {_wordsets()} SELECT w1, w2, w3, w4, support FROM l4 "
                                 f"ORDER BY support DESC, w1, w2, w3, w4 LIMIT {Q.TOP_SETS}"),
        "frequent_sets_fpgrowth": lambda: (
            f"WITH {_wordsets()} SELECT w1 || ' ' || w2 AS items, CAST(2 AS INTEGER) AS n_words, support FROM l2 "
            "UNION ALL SELECT w1 || ' ' || w2 || ' ' || w3, CAST(3 AS INTEGER), support FROM l3 "
            "UNION ALL SELECT w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, CAST(4 AS INTEGER), support FROM l4"),
    }
    sql |= {f"{key}_neighbors_bounded": sql[f"{key}_neighbors_top10"] for key in ("item", "user")}  # the same rows, found another way
    return sql


def oracle_sql() -> dict[str, str]:
    """SQL per query, each text built by itself: a fault costs its own query only."""
    out = {}
    for name, text in _texts().items():
        try:
            out[name] = text() if callable(text) else text
        except Exception as e:  # noqa: BLE001
            warnings.warn(f"no SQL for {name}: {e}", stacklevel=2)
    return out
