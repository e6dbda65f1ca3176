"""Named queries over the test tables: (spark, sf_dir) -> DataFrame.

Every query reads whole tables.  Floating-point outputs are rounded to 6
decimals (the SQL oracle rounds the same way) so engines that sum in a
different order still agree.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmill.operators import graph, itemsets, ratings as rt, recommend as rc, text, weblog
from sparkmill.sources import files, sinks, tables
from sparkmill.sources.files import parse_log_lines
from sparkmill.session import checkpoint_dir, written
from sparkmill.sources.stopwords import spark_stop_words

# Parameters of the registered queries (scale-free where the data grows).
TOP_WORDS = 20
TOP_WORDS_TIES = 10
TOP_ERRORS = 10
TOP_404 = 20
DAYS = 30
INVALID_SAMPLE = 20
MIN_RATINGS = 40          # library default 500; parts here have at most ~50 ratings
TOP_RATED = 20
SPLIT_TEST = 0.1          # oldest 10% of rating rows -> test
SPLIT_VALID = 0.1         # next 10% -> validation
NEIGHBORS = 10
PAGERANK_ROUNDS = 10
TOP_NODES = 20
SUPPORT_FRACTION = 0.12   # minimum support = floor(0.12 * number of documents)
TOP_SETS = 10
ALS_RANKS = (4, 8, 12)
SIMILAR = 0.1             # threshold of the approximate similarities


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------- text

def _docs(spark, d):
    return tables.documents(spark, d)


def word_count_raw(spark, d):
    return text.word_count(_docs(spark, d), "text", "raw")


def word_count_lower(spark, d):
    return text.word_count(_docs(spark, d), "text", "lower")


def word_count_clean(spark, d):
    return text.word_count(_docs(spark, d), "text", "clean")


def word_count_lower_top10_ties(spark, d):
    return text.top_words_with_ties(text.word_count(_docs(spark, d), "text", "lower"), TOP_WORDS_TIES)


def word_count_clean_top20(spark, d):
    return text.top_words(text.word_count(_docs(spark, d), "text", "clean"), TOP_WORDS)


def clean_documents(spark, d):
    return text.clean_documents(_docs(spark, d), list(spark_stop_words("english")))


# ---------------------------------------------------------------- web log

def log_records(spark, d):
    return parse_log_lines(tables.log_lines(spark, d), "raw")


def log_parse_stats(spark, d):
    return weblog.parse_stats(log_records(spark, d))


def log_invalid_sample(spark, d):
    return weblog.invalid_sample(log_records(spark, d), INVALID_SAMPLE)


def log_top_error_endpoints(spark, d):
    return weblog.top_error_endpoints(log_records(spark, d), TOP_ERRORS)


def log_unique_hosts(spark, d):
    return weblog.unique_hosts(log_records(spark, d))


def log_daily_hosts(spark, d):
    return weblog.daily_hosts(log_records(spark, d), DAYS)


def log_404_count(spark, d):
    return weblog.not_found_count(log_records(spark, d))


def log_top_404_endpoints(spark, d):
    return weblog.top_not_found_endpoints(log_records(spark, d), TOP_404)


# ---------------------------------------------------------------- ratings

def _ratings(spark, d):
    return tables.ratings(spark, d)


def _ratings_once(spark, d):
    """Derived ratings written once to the checkpoint folder, for queries that
    read them several times (norms, hot-group sizes, pairs)."""
    checkpoint_dir(spark)
    return written(_ratings(spark, d), "ratings")


def ratings(spark, d):
    return _ratings(spark, d)


def item_rating_stats(spark, d):
    s = rt.item_stats_with_titles(_ratings(spark, d), tables.item_titles(spark, d))
    return s.select("item", "title", "n_ratings", r6("avg_rating").alias("avg_rating"))


def top_rated_items(spark, d):
    t = rt.top_rated(_ratings(spark, d), tables.item_titles(spark, d), MIN_RATINGS, TOP_RATED)
    return t.select(r6("avg_rating").alias("avg_rating"), "title", "n_ratings", "item")


def global_mean(spark, d):
    return _ratings(spark, d).agg(r6(F.avg("rating")).alias("global_mean"))


def user_means(spark, d):
    return rt.user_means(_ratings(spark, d)).select("user", r6("user_mean").alias("user_mean"), "n_ratings")


def item_means(spark, d):
    return rt.item_means(_ratings(spark, d)).select("item", r6("item_mean").alias("item_mean"), "n_ratings")


def random_split(spark, d):
    return rt.hash_split(_ratings(spark, d)).select("user", "item", "split")


def random_split_counts(spark, d):
    return rt.split_counts(rt.hash_split(_ratings(spark, d)))


def _time_split(spark, d):
    return rt.time_split(_ratings_once(spark, d), frac_test=SPLIT_TEST, frac_valid=SPLIT_VALID)


def time_split(spark, d):
    return _time_split(spark, d).select("user", "item", "rating", "ts", "split")


def time_split_counts(spark, d):
    return rt.split_counts(_time_split(spark, d))


def _splits(spark, d):
    s = written(_time_split(spark, d), "splits")  # read by every branch
    return (s.filter("split = 'train'").drop("split"), s.filter("split = 'valid'").drop("split"),
            s.filter("split = 'test'").drop("split"))


def baseline_predict(spark, d):
    train, _, test = _splits(spark, d)
    return rt.baseline_predict(train, test).select("user", "item", r6("prediction").alias("prediction"))


def baseline_rmse(spark, d):
    train, _, test = _splits(spark, d)
    return rt.rmse(rt.baseline_predict(train, test), test).select(r6("rmse").alias("rmse"), "n")


def item_norms(spark, d):
    return rc.norms(_ratings(spark, d), "item").select("item", r6("norm").alias("norm"))


def user_norms(spark, d):
    return rc.norms(_ratings(spark, d), "user").select("user", r6("norm").alias("norm"))


def _cos_out(df, key):
    return df.select(f"{key}_1", f"{key}_2", r6("dot").alias("dot"), "n_common", r6("sim").alias("sim"))


def item_cosine(spark, d):
    return _cos_out(rc.cosine_similarity(_ratings_once(spark, d), "item", "user"), "item")


def item_cosine_sampled(spark, d):
    """The approximate similarities held against the exact ones: how many pairs reach the threshold, whether at least 0.9 of
    those are found, and whether their mean relative error is at most 0.2."""
    checkpoint_dir(spark)
    ratings = _ratings_once(spark, d)
    exact = rc.cosine_similarity(ratings, then=lambda sims: sims.filter(F.col("sim") >= SIMILAR - 1e-9).select("item_1", "item_2", "sim"))
    found = rc.sampled_similarity(ratings, SIMILAR - 1e-9).withColumnRenamed("sim", "estimate")
    error = F.avg(F.abs(F.col("estimate") - F.col("sim")) / F.col("sim"))
    return exact.join(found, ["item_1", "item_2"], "left").agg(
        F.count(F.lit(1)).alias("n_similar"), (F.count("estimate") >= 0.9 * F.count(F.lit(1))).alias("recalled"),
        (F.coalesce(error, F.lit(0.0)) <= 0.2).alias("within"))


def user_cosine(spark, d):
    return _cos_out(rc.cosine_similarity(_ratings_once(spark, d), "user", "item"), "user")


def item_neighbors_top10(spark, d):
    nn = rc.cosine_neighbors(_ratings_once(spark, d), NEIGHBORS, "item", "user")
    return nn.select("item", "other", r6("sim").alias("sim"), F.col("rank").cast("int").alias("rank"))


def user_neighbors_top10(spark, d):
    nn = rc.cosine_neighbors(_ratings_once(spark, d), NEIGHBORS, "user", "item")
    return nn.select("user", "other", r6("sim").alias("sim"), F.col("rank").cast("int").alias("rank"))


def item_neighbors_bounded(spark, d):
    nn = rc.bounded_neighbors(_ratings_once(spark, d), NEIGHBORS, "item", "user")
    return nn.select("item", "other", r6("sim").alias("sim"), F.col("rank").cast("int").alias("rank"))


def user_neighbors_bounded(spark, d):
    nn = rc.bounded_neighbors(_ratings_once(spark, d), NEIGHBORS, "user", "item")
    return nn.select("user", "other", r6("sim").alias("sim"), F.col("rank").cast("int").alias("rank"))


def ratings_by_time(spark, d):
    return rt.sort_by_time(_ratings(spark, d))


def item_cf_predict(spark, d):
    train, _, test = _splits(spark, d)
    p = rc.item_based_predict(train, test)
    return p.select("user", "item", r6("prediction").alias("prediction"))


def user_cf_predict(spark, d):
    train, _, test = _splits(spark, d)
    p = rc.user_based_predict(train, test)
    return p.select("user", "item", r6("prediction").alias("prediction"))


def cf_rmse(spark, d):
    checkpoint_dir(spark)
    split = written(_time_split(spark, d), "splits")  # read by every branch below
    train, both = split.filter("split = 'train'").drop("split"), split.filter("split <> 'train'")
    out = None
    for method, predict in (("item_cf", rc.item_based_predict), ("user_cf", rc.user_based_predict)):
        p = predict(train, both, by=("split",))
        part = rt.rmse_by_split(p, both, ("valid", "test")).select(F.lit(method).alias("method"), "split", r6("rmse").alias("rmse"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def als_predict(spark, d):
    train, _, test = _splits(spark, d)
    model = rc.als_fit(train, rank=8)
    return rc.als_predict(model, test)


def als_rank_search(spark, d):
    train, valid, _ = _splits(spark, d)
    table, _ = rc.als_rank_search(train, valid, ALS_RANKS)
    return table


def als_scored_pairs(spark, d):
    """Which test pairs ALS scores: those whose user and item are both in the training split."""
    train, _, test = _splits(spark, d)
    return rc.als_predict(rc.als_fit(train, rank=4, max_iter=1), test).select("user", "item")


def method_comparison(spark, d):
    train, valid, test = _splits(spark, d)
    return rc.method_comparison(train, valid, test, ALS_RANKS)


def method_comparison_checked(spark, d):
    """The comparison with what any engine can recompute: all counts, and every rmse but that of ALS."""
    out = method_comparison(spark, d)
    return out.select("method", "split", "n", F.when(F.col("method") != "als", r6("rmse")).alias("rmse"))


# ---------------------------------------------------------------- graph

def graph_edges(spark, d):
    return tables.graph_edges(spark, d)


def edge_degrees(spark, d):
    return graph.degrees(tables.graph_edges(spark, d))


def adjacency(spark, d):
    return graph.adjacency(tables.graph_edges(spark, d))


def _ranks(spark, d):
    return graph.pagerank(tables.graph_edges(spark, d), PAGERANK_ROUNDS)


def pagerank_ranks(spark, d):
    return _ranks(spark, d).select("node", r6("rank").alias("rank"))


def pagerank_top20(spark, d):
    return graph.top_ranked(_ranks(spark, d), TOP_NODES).select("node", r6("rank").alias("rank"))


def pagerank_node_report(spark, d):
    # The derived graph feeds PageRank, the degree table and the neighbour
    # ranks: write it once to the checkpoint folder.
    edges = graph.prepare_edges(tables.graph_edges(spark, d))
    ranks = graph.pagerank(edges, PAGERANK_ROUNDS, assume_distinct=True)
    rep = graph.node_report(edges, ranks, TOP_NODES, assume_distinct=True)
    return rep.select("node", r6("rank").alias("rank"), "out_degree", "in_degree",
                      r6("avg_neighbor_rank").alias("avg_neighbor_rank"))


# ---------------------------------------------------------------- word sets

def _clean(spark, d):
    return text.clean_documents(_docs(spark, d), list(spark_stop_words("english")))


def min_support(spark, d) -> int:
    n_docs = tables.table(spark, d, "documents").count()
    return int(SUPPORT_FRACTION * n_docs)


def _mined(spark, d, level):
    return getattr(itemsets.mine_texts(_clean(spark, d), min_support(spark, d)), level)


def frequent_words(spark, d):
    return itemsets.frequent_words(_clean(spark, d), min_support(spark, d))


def frequent_pairs(spark, d):
    return _mined(spark, d, "pairs")


def frequent_triples(spark, d):
    return _mined(spark, d, "triples")


def quad_candidates(spark, d):
    return _mined(spark, d, "quad_candidates").agg(F.count(F.lit(1)).alias("n_candidates"))


def frequent_quads(spark, d):
    return _mined(spark, d, "quads")


def frequent_quads_top10(spark, d):
    return itemsets.top_sets(_mined(spark, d, "quads"), TOP_SETS)


def frequent_sets_fpgrowth(spark, d):
    dw = text.document_words(_clean(spark, d))
    sets = itemsets.fpgrowth_sets(dw, min_support(spark, d), 4, 2)
    return sets.select(F.array_join("items", " ").alias("items"), F.size("items").alias("n_words"), "support")


# ---------------------------------------------------------------- files
# Each writes rows derived from the tables to the shared folder with a sink and reads them with a source.

def _folder(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ratings_dat_files(spark, d):
    path = _folder(spark, "ratings-dat")
    sinks.write_ratings_dat(_ratings(spark, d), path)
    return files.read_ratings_dat(spark, path)


def ratings_csv_files(spark, d):
    path = _folder(spark, "ratings-csv")
    sinks.write_ratings_csv(_ratings(spark, d), path)
    return files.read_ratings_csv(spark, path)


def rated_movie_files(spark, d):
    """Ratings and movies, both from '::' files, as mean rating per title."""
    path, movies = _folder(spark, "ratings-dat"), _folder(spark, "movies-dat")
    sinks.write_ratings_dat(_ratings(spark, d), path)
    part = tables.table(spark, d, "part")
    sinks.write_movies_dat(part.select(F.col("p_partkey").alias("item"), F.col("p_name").alias("title"), F.col("p_type").alias("genres")), movies)
    s = rt.item_stats_with_titles(files.read_ratings_dat(spark, path), files.read_movies_dat(spark, movies))
    return s.select("item", "title", "genres", "n_ratings", r6("avg_rating").alias("avg_rating"))


def split_files(spark, d):
    path = _folder(spark, "splits")
    sinks.write_splits(_time_split(spark, d), path)
    return spark.read.parquet(path).select("user", "item", "rating", "ts", "split")


def clean_document_lines(spark, d):
    """Cleaned documents written as lines of text and read line by line."""
    path = _folder(spark, "clean-text")
    sinks.write_clean_documents(_clean(spark, d), path, "text")
    return files.read_lines(spark, path).withColumnRenamed("value", "text")


def whole_file_word_counts(spark, d):
    """Words of cleaned documents, counted over whole files."""
    path = _folder(spark, "clean-text")
    sinks.write_document_files(_clean(spark, d), path)
    return text.word_count(files.read_documents(spark, path), "text", "raw")


def stop_word_file_counts(spark, d):
    """Word counts of documents cleaned with a stop-word file; the list is the most frequent words, ties included."""
    path = _folder(spark, "stop-words")
    often = text.top_words_with_ties(text.word_count(_docs(spark, d), "text", "clean"), TOP_WORDS)
    often.select("word").write.text(path)
    clean = text.clean_documents_by_join(_docs(spark, d), files.stop_words(spark, path))
    return text.word_count(clean, "text", "raw")


def access_log_files(spark, d):
    path = _folder(spark, "access-log")
    tables.log_lines(spark, d).select("raw").write.text(path)
    return files.read_access_log(spark, path)


def edge_list_files(spark, d):
    path = _folder(spark, "edges")
    tables.graph_edge_lines(spark, d).write.text(path)
    return files.read_edge_list(spark, path)


def log_stats_observed(spark, d):
    """Lines read, parsed and failed, observed while the records are written."""
    seen = weblog.write_observed(log_records(spark, d), _folder(spark, "log-records"))
    return spark.createDataFrame([(seen["n_read"], seen["n_parsed"], seen["n_failed"])], "n_read long, n_parsed long, n_failed long")


def log_sketched_hosts(spark, d):
    """Distinct hosts per day, of days 8 to 14 and of all days, from one table of sketches, next to the exact count:
    whether each estimate is within the stated error."""
    checkpoint_dir(spark)
    records = log_records(spark, d).select("is_valid", "host", "date_time").checkpoint(eager=True)  # parsed once for both sides
    sketches = weblog.host_sketches(records).checkpoint(eager=True)
    valid = records.filter("is_valid").select("host", F.dayofmonth("date_time").alias("day"))
    hosts = F.countDistinct("host").alias("n_hosts")
    exact = valid.groupBy(F.col("day").cast("string").alias("days")).agg(hosts)
    exact = exact.unionByName(valid.agg(hosts).withColumn("days", F.lit("all")))
    exact = exact.unionByName(valid.filter("day between 8 and 14").agg(hosts).withColumn("days", F.lit("8-14")))
    guess = weblog.sketched_daily_hosts(sketches).select(F.col("day").cast("string").alias("days"), "estimate")
    guess = guess.unionByName(weblog.sketched_hosts(sketches).withColumn("days", F.lit("all")))
    guess = guess.unionByName(weblog.sketched_hosts(sketches, 8, 14).withColumn("days", F.lit("8-14")))
    near = F.abs(F.col("estimate") - F.col("n_hosts")) <= weblog.SKETCH_ERROR * F.col("n_hosts")
    return exact.join(guess, "days").select("days", "n_hosts", near.alias("within"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in [
        ("word_count_raw", word_count_raw),
        ("word_count_lower", word_count_lower),
        ("word_count_clean", word_count_clean),
        ("word_count_lower_top10_ties", word_count_lower_top10_ties),
        ("word_count_clean_top20", word_count_clean_top20),
        ("clean_documents", clean_documents),
        ("log_records", log_records),
        ("log_parse_stats", log_parse_stats),
        ("log_invalid_sample", log_invalid_sample),
        ("log_top_error_endpoints", log_top_error_endpoints),
        ("log_unique_hosts", log_unique_hosts),
        ("log_daily_hosts", log_daily_hosts),
        ("log_404_count", log_404_count),
        ("log_top_404_endpoints", log_top_404_endpoints),
        ("ratings", ratings),
        ("item_rating_stats", item_rating_stats),
        ("top_rated_items", top_rated_items),
        ("global_mean", global_mean),
        ("user_means", user_means),
        ("item_means", item_means),
        ("random_split", random_split),
        ("random_split_counts", random_split_counts),
        ("time_split", time_split),
        ("time_split_counts", time_split_counts),
        ("baseline_predict", baseline_predict),
        ("baseline_rmse", baseline_rmse),
        ("item_norms", item_norms),
        ("user_norms", user_norms),
        ("item_cosine", item_cosine),
        ("item_cosine_sampled", item_cosine_sampled),
        ("user_cosine", user_cosine),
        ("item_neighbors_top10", item_neighbors_top10),
        ("user_neighbors_top10", user_neighbors_top10),
        ("item_neighbors_bounded", item_neighbors_bounded),
        ("user_neighbors_bounded", user_neighbors_bounded),
        ("ratings_by_time", ratings_by_time),
        ("item_cf_predict", item_cf_predict),
        ("user_cf_predict", user_cf_predict),
        ("cf_rmse", cf_rmse),
        ("als_predict", als_predict),
        ("als_rank_search", als_rank_search),
        ("als_scored_pairs", als_scored_pairs),
        ("method_comparison", method_comparison),
        ("method_comparison_checked", method_comparison_checked),
        ("graph_edges", graph_edges),
        ("edge_degrees", edge_degrees),
        ("adjacency", adjacency),
        ("pagerank_ranks", pagerank_ranks),
        ("pagerank_top20", pagerank_top20),
        ("pagerank_node_report", pagerank_node_report),
        ("frequent_words", frequent_words),
        ("frequent_pairs", frequent_pairs),
        ("frequent_triples", frequent_triples),
        ("quad_candidates", quad_candidates),
        ("frequent_quads", frequent_quads),
        ("frequent_quads_top10", frequent_quads_top10),
        ("frequent_sets_fpgrowth", frequent_sets_fpgrowth),
        ("ratings_dat_files", ratings_dat_files),
        ("ratings_csv_files", ratings_csv_files),
        ("rated_movie_files", rated_movie_files),
        ("split_files", split_files),
        ("clean_document_lines", clean_document_lines),
        ("whole_file_word_counts", whole_file_word_counts),
        ("stop_word_file_counts", stop_word_file_counts),
        ("access_log_files", access_log_files),
        ("edge_list_files", edge_list_files),
        ("log_stats_observed", log_stats_observed),
        ("log_sketched_hosts", log_sketched_hosts),
    ]
}
