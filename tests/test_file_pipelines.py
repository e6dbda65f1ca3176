"""End-to-end runs from files, as the reference's scripts take their inputs."""

import os

from sparkmill.operators import graph, ratings as rt, recommend as rc, text as text_words, weblog
from sparkmill.sources import files, sinks


def _write(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_best_rated_from_dat_files(spark, tmp_dir):
    r = _write(os.path.join(tmp_dir, "ratings.dat"),
               [f"{u}::{m}::{s}::{978300000 + u}" for u, m, s in
                [(1, 1, 5), (2, 1, 4), (3, 1, 5), (1, 2, 3), (2, 2, 3), (3, 2, 2), (1, 3, 5)]])
    m = _write(os.path.join(tmp_dir, "movies.dat"),
               ["1::Alpha (1995)::Comedy", "2::Beta, The (1996)::Drama", "3::Gamma (1997)::Action"])
    ratings = files.read_ratings_dat(spark, r).select("user", "item", "rating")
    movies = files.read_movies_dat(spark, m).select("item", "title")
    best = rt.top_rated(ratings, movies, min_ratings=2, k=20).collect()
    assert [(x.title, x.n_ratings) for x in best] == [("Alpha (1995)", 3), ("Beta, The (1996)", 3)]
    assert abs(best[0].avg_rating - 14 / 3) < 1e-12


def test_split_files_round_trip_and_baseline(spark, tmp_dir):
    rows = [f"{u}::{i}::{(u + i) % 5 + 1}::{1000 + 10 * u + i}" for u in range(1, 6) for i in range(1, 5)]
    r = _write(os.path.join(tmp_dir, "ratings.dat"), rows)
    ratings = files.read_ratings_dat(spark, r)
    split = rt.time_split(ratings, n_test=4, n_valid=4)
    for name in ("train", "valid", "test"):
        sinks.write_ratings_dat(split.filter(f"split = '{name}'"), os.path.join(tmp_dir, name))
    train = files.read_ratings_dat(spark, os.path.join(tmp_dir, "train"))
    test = files.read_ratings_dat(spark, os.path.join(tmp_dir, "test"))
    assert train.count() == 12 and test.count() == 4
    res = rt.rmse(rt.baseline_predict(train, test), test).first()
    assert res.n == 4 and res.rmse is not None
    sims = rc.cosine_similarity(train, "item", "user")
    assert sims.count() > 0


def test_access_log_report_from_file(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "access.log"), [
        'a.com - - [01/Aug/1995:00:00:01 -0400] "GET /x.gif HTTP/1.0" 200 10',
        'b.com - - [01/Aug/1995:00:00:07 -0400] "GET /y.html HTTP/1.0" 404 -',
        'b.com - - [02/Aug/1995:00:00:07 -0400] "GET /y.html HTTP/1.0" 404 -',
        'garbage',
    ])
    recs = files.read_access_log(spark, p)
    assert [tuple(r) for r in weblog.top_not_found_endpoints(recs).collect()] == [("/y.html HTTP/1.0", 2)]
    assert [tuple(r) for r in weblog.daily_hosts(recs).collect()] == [(1, 2), (2, 1)]


def test_pagerank_from_edge_file(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "edges.txt"), ["# comment", "1 2", "2 3", "3 1", "3 2", "1\t2"])
    edges = files.read_edge_list(spark, p)
    ranks = {r.node: r.rank for r in graph.pagerank(edges, 20).collect()}
    assert set(ranks) == {"1", "2", "3"}
    # with every node on a cycle the un-normalised ranks sum to the node count
    assert abs(sum(ranks.values()) - 3.0) < 1e-9


def test_document_files_are_bounded(spark, tmp_dir):
    """However few tasks write, no file holds more than 8 MiB or one text."""
    rows = [(i, "ab " * 5000) for i in range(1100)] + [(2000 + i, "cd " * 40000) for i in range(70)] + [(3000, "ef " * 200000), (3001, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    path = f"{tmp_dir}/docs"
    sinks.write_document_files(df, path)
    sizes = [os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".txt")]
    assert len(sizes) > 4 and max(sizes) <= 8 << 20
    words = {r.word: r.n for r in text_words.word_count(files.read_documents(spark, path), "text", "raw").collect()}
    assert words == {"ab": 1100 * 5000, "cd": 70 * 40000, "ef": 200000}
