import random

from pyspark.sql import functions as F

from sparkmill.operators import ratings as rt
from sparkmill.operators.ordering import global_row_number


def test_global_row_number_matches_sort(spark):
    rnd = random.Random(11)
    data = [(rnd.randint(0, 5), u, i) for u in range(40) for i in range(rnd.randint(0, 6))]
    df = spark.createDataFrame(data, "ts long, user long, item long").repartition(5)
    got = sorted((r.rn, r.ts, r.user, r.item) for r in global_row_number(df, ["ts", "user", "item"], "rn", 4).collect())
    expect = [(n + 1, *t) for n, t in enumerate(sorted(data))]
    assert got == expect


def test_time_split_sizes_and_order(spark):
    rnd = random.Random(5)
    data = [(u, i, float(rnd.randint(1, 5)), rnd.randint(0, 20)) for u in range(30) for i in range(5)]
    df = spark.createDataFrame(data, "user long, item long, rating double, ts long")
    s = rt.time_split(df, n_test=20, n_valid=30)
    counts = {r.split: r.n for r in rt.split_counts(s).collect()}
    assert counts == {"test": 20, "valid": 30, "train": 100}
    rows = s.collect()
    key = lambda r: (r.ts, r.user, r.item)
    assert max(key(r) for r in rows if r.split == "test") < min(key(r) for r in rows if r.split == "valid")
    assert max(key(r) for r in rows if r.split == "valid") < min(key(r) for r in rows if r.split == "train")
    fr = rt.split_counts(rt.time_split(df, frac_test=0.1, frac_valid=0.2)).collect()
    assert {r.split: r.n for r in fr} == {"test": 15, "valid": 30, "train": 105}


def test_hash_split_is_stable(spark):
    df = spark.range(2000).select(F.col("id").alias("user"), (F.col("id") % 7).alias("item"))
    a = {r.split: r.n for r in rt.split_counts(rt.hash_split(df)).collect()}
    b = {r.split: r.n for r in rt.split_counts(rt.hash_split(df.repartition(7))).collect()}
    assert a == b and sum(a.values()) == 2000 and a["train"] > a["valid"]


def test_top_rated(spark):
    r = spark.createDataFrame([(u, 1, 5.0) for u in range(3)] + [(u, 2, 4.0) for u in range(5)] +
                              [(u, 3, 4.0) for u in range(5)] + [(0, 4, 5.0)],
                              "user long, item long, rating double")
    titles = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (4, "D")], "item long, title string")
    out = [(x.title, x.n_ratings) for x in rt.top_rated(r, titles, min_ratings=2, k=20).collect()]
    assert out == [("A", 3), ("C", 5), ("B", 5)]


def test_random_split_partitions_rows(spark):
    df = spark.range(3000).select(F.col("id").alias("user"), (F.col("id") % 11).alias("item"),
                                  F.lit(3.0).alias("rating"))
    parts = rt.random_split(df, (8, 1, 1), seed=0)
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 3000 and sizes[0] > sizes[1] and sizes[0] > sizes[2]
    ids = set()
    for p in parts:
        ids |= {r.user for r in p.select("user").collect()}
    assert len(ids) == 3000
