"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from sparkmill.llm import licenses, secrets

SPACE_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
q AS (SELECT page_id, strlen(body) AS n, sha1(body) AS digest FROM p),
r AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest) ELSE page_id END AS lead FROM q)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN lead = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN lead <> page_id THEN lead END AS refers_to
FROM r
"""

OP5 = """
WITH v AS (SELECT row_number() OVER () AS uid, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.uid, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.uid <> c.uid WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

FOLD = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {SPACE_WORDS.format(FOLD.format("text"))} AS words FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(words[s:s + 3], ' ') AS g
       FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS s FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT u, v FROM common JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 85 * (x.n + y.n - k)),
edge AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, edge.v FROM reach JOIN edge ON reach.b = edge.u)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(b) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = w.doc_id GROUP BY ALL
"""

OP6 = f"""
WITH d AS (SELECT doc_id, {ALNUM_WORDS.format(FOLD.format("text"))} AS words FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {ALNUM_WORDS.format(FOLD.format("text"))} AS words FROM benchmark),
bw AS (SELECT DISTINCT item, least(13, len(words)) AS k, array_to_string(words[s:s + least(13, len(words)) - 1], ' ') AS body
       FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 11, 2))) AS s FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, s, array_to_string(words[s:s + k - 1], ' ') AS body
       FROM (SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS s FROM d, sizes WHERE len(words) >= k)),
m AS (SELECT dw.doc_id, dw.s, dw.k, bw.item FROM dw JOIN bw USING (k, body)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM m) GROUP BY doc_id),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN own USING (doc_id)
"""



def _runs(name: str, pattern: str) -> str:
    """Rows (doc_id, start, found) of the leftmost non-overlapping matches, by what stands between them."""
    return f"""
{name}_p AS (SELECT doc_id, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS found FROM d),
{name} AS (SELECT doc_id, found[i] AS found, CAST(coalesce(list_sum(list_transform(gaps[:i], lambda x: length(x))), 0)
                  + coalesce(list_sum(list_transform(found[:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
           FROM (SELECT doc_id, gaps, found, unnest(range(1, len(found) + 1)) AS i FROM {name}_p))"""


def _either(word: str) -> str:
    return "".join(f"[{x}{x.upper()}]" for x in word)


_KEYS = "|".join(map(_either, ("password", "passwd", "secret", "token"))) + f"|{_either('api')}_?{_either('key')}"
_ASSIGN = f"""(?:{_KEYS})["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _entropy(k: int, c: secrets.CharacterClass) -> str:
    """Every window's sum from its own histogram; islands of the flagged ones."""
    allow = "^(" + "|".join(secrets.ALLOWED) + ")$"
    return f"""
{_runs(f"c{k}", f"{c.pattern}{{{c.window},}}").strip()},
w{k} AS (SELECT doc_id, start, i, substr(found, i, {c.window}) AS body
        FROM (SELECT *, unnest(range(1, length(found) - {c.window} + 2)) AS i FROM c{k} WHERE NOT regexp_matches(found, '{allow}'))),
f{k} AS (SELECT doc_id, start + i - 1 AS s FROM w{k}
        WHERE list_sum(list_transform(map_values(list_histogram(string_split(body, ''))), lambda n: {c.terms}[CAST(n AS BIGINT) + 1])) <= {c.most}),
g{k} AS (SELECT doc_id, s, sum(CAST(fresh AS INT)) OVER (PARTITION BY doc_id ORDER BY s) AS island
        FROM (SELECT *, s > coalesce(lag(s) OVER (PARTITION BY doc_id ORDER BY s), -1000) + {c.window} AS fresh FROM f{k})),
e{k} AS (SELECT doc_id, {3 + k} AS o, '{c.kind}' AS kind, min(s) AS start, max(s) + {c.window} AS stop FROM g{k} GROUP BY doc_id, island)"""


OP8 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{_runs("a", _ASSIGN).strip()},
{_runs("k", secrets.ACCESS).strip()},
{_runs("h", secrets.HEX).strip()},
base AS (SELECT doc_id, 0 AS o, 'assign' AS kind, start, start + length(found) AS stop FROM a WHERE length(regexp_extract(found, '{_ASSIGN}', 1)) >= 6
         UNION ALL SELECT doc_id, 1, 'access', start, start + length(found) FROM k WHERE length(found) >= 20
         UNION ALL SELECT doc_id, 2, 'hex', start, start + length(found) FROM h WHERE length(found) >= 24),
{", ".join(_entropy(k, c).strip() for k, c in enumerate(secrets.CLASSES))},
every AS (SELECT * FROM base {" ".join(f"UNION ALL SELECT * FROM e{k}" for k in range(len(secrets.CLASSES)))}),
b AS (SELECT doc_id, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) AS listed FROM base GROUP BY doc_id),
s AS (SELECT doc_id, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) AS spans FROM every GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(listed, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN s USING (doc_id)
"""

OP10 = f"""
WITH w AS (SELECT doc_id, {SPACE_WORDS.format("coalesce(text, '')")} AS words FROM documents),
win AS (SELECT doc_id, s, array_to_string(words[s:s + 34], ' ') AS body
        FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 33, 1))) AS s FROM w)),
rep AS (SELECT body FROM win GROUP BY body HAVING count(*) > 1),
hit AS (SELECT doc_id, list(DISTINCT p) AS gone
        FROM (SELECT doc_id, unnest(range(s, s + 35)) AS p FROM win SEMI JOIN rep USING (body)) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN words ELSE
              list_filter(words, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN hit USING (doc_id)
"""

OP11 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
g AS (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS u, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS v,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS p, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS q FROM d),
f AS (SELECT *, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR p >= 90 THEN 'plain'
                     WHEN q < 20 THEN 'spm' ELSE 'psm' END AS form, least(u, v) AS a, greatest(u, v) AS b FROM g),
x AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM x
"""


def _spelling(parts: tuple) -> str:
    """A template as a pattern over words that are each followed by one space."""
    return "".join(f"{p} " if isinstance(p, str) else f"(?:[^ ]+ ){{{p.least},{p.most}}}" if isinstance(p, licenses.Replaceable)
                   else f"(?:{_spelling(p.parts)})?" for p in parts)


def _fixed(parts: tuple) -> str:
    """The longest run of mandatory words: every spelling holds it."""
    runs = [[]]
    for p in parts:
        runs = [*runs[:-1], runs[-1] + [p]] if isinstance(p, str) else [*runs, []]
    return " ".join(max(runs, key=len))


def _op12() -> str:
    def places(phrase: str) -> str:
        same = " AND ".join(f"words[s + {i}] = '{x}'" for i, x in enumerate(phrase.split()))
        return f"list_filter(range(1, len(words) - {len(phrase.split()) - 2}), lambda s: {same})"

    bases = " UNION ALL ".join(f"SELECT doc_id, '{label}' AS label, unnest({places(phrase)}) - 1 AS place FROM w" for phrase, label in licenses.PHRASES)
    own = " UNION ALL ".join(f"SELECT doc_id, '{label}' AS label, {f"'{family}'" if family else 'NULL'} AS family FROM j "
                             f"WHERE contains(t, ' {_fixed(licenses.parse(text))} ') AND regexp_matches(t, ' {_spelling(licenses.parse(text))}')" for label, family, text in licenses.TEMPLATES)
    return f"""
WITH w AS (SELECT doc_id, {ALNUM_WORDS.format(FOLD.format("text"))} AS words FROM documents),
j AS (SELECT doc_id, ' ' || array_to_string(words, ' ') || ' ' AS t FROM w),
base AS ({bases}),
own AS ({own}),
b AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
proved AS (SELECT DISTINCT doc_id, label FROM own UNION SELECT o.doc_id, o.family FROM own o JOIN base s ON s.doc_id = o.doc_id AND s.label = o.family),
every AS (SELECT doc_id, label, max(good) AS good FROM (SELECT doc_id, label, 1 AS good FROM proved UNION ALL SELECT doc_id, label, 0 FROM base) GROUP BY doc_id, label),
l AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels, (sum(good) + 0.5::DOUBLE * (count(*) - sum(good))) / count(*) AS score FROM every GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id)
"""


OP13 = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({FOLD.format("text")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM p),
u AS (SELECT lang, word, count(*) AS f FROM (SELECT lang, unnest(words) AS word FROM w) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM u GROUP BY lang),
two AS (SELECT lang, words[i] AS x, words[i + 1] AS y, count(*) AS a FROM (SELECT lang, words, unnest(range(1, len(words))) AS i FROM w WHERE len(words) > 1) GROUP BY ALL),
three AS (SELECT lang, words[i] AS x, words[i + 1] AS y, words[i + 2] AS z, count(*) AS a
          FROM (SELECT lang, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2) GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT t.lang, x || ' ' || y AS phrase, a, 1 AS k, l.f AS l, r.f AS r FROM two t JOIN u l ON l.lang = t.lang AND l.word = x JOIN u r ON r.lang = t.lang AND r.word = y
      WHERE a >= 10 AND NOT EXISTS (SELECT 1 FROM three b WHERE b.lang = t.lang AND b.x = t.x AND b.y = t.y AND 100 * b.a >= 50 * t.a)
        AND NOT EXISTS (SELECT 1 FROM three b WHERE b.lang = t.lang AND b.y = t.x AND b.z = t.y AND 100 * b.a >= 50 * t.a)
      UNION ALL SELECT t.lang, t.x || ' ' || t.y || ' ' || z, t.a, 1, l.f, r.a FROM three t JOIN u l ON l.lang = t.lang AND l.word = t.x
                       JOIN two r ON r.lang = t.lang AND r.x = t.y AND r.y = z
      UNION ALL SELECT t.lang, t.x || ' ' || t.y || ' ' || z, t.a, 2, l.a, r.f FROM three t JOIN u r ON r.lang = t.lang AND r.word = z
                       JOIN two l ON l.lang = t.lang AND l.x = t.x AND l.y = t.y),
s AS (SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM c),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best JOIN totals USING (lang) QUALIFY rank <= 2000
"""


ORACLE = {
    "op2_warc_transactions": OP2,
    "op3_ngram_jaccard": OP3,
    "op5_exact_topk": OP5,
    "op6_decontamination": OP6,
    "op8_secret_scan": OP8,
    "op10_substring_dedup": OP10,
    "op11_fill_in_middle": OP11,
    "op12_license_scan": _op12(),
    "op13_collocations": OP13,
}
