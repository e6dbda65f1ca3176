"""Hot groups are split: bucket counts and bucket sizes stay near block_size."""

import pytest
from pyspark.sql import functions as F

from sparkmill.operators.skew import balanced_join, pairs_within_groups, salted_join, sums_of_pairs, with_bucket_count


def _skewed(spark, hot_rows=3000, cold_groups=50, cold_rows=5):
    rows = [(0, i) for i in range(hot_rows)] + [(g, i) for g in range(1, cold_groups + 1) for i in range(cold_rows)]
    return spark.createDataFrame(rows, "g long, item long")


def test_bucket_counts_and_sizes(spark):
    df = _skewed(spark)
    sized = with_bucket_count(df, ["g"], 100)
    nb = {r.g: r._nb for r in sized.select("g", "_nb").distinct().collect()}
    assert nb[0] == 30 and all(v == 1 for k, v in nb.items() if k != 0)
    buckets = (sized.filter("g = 0").groupBy(F.pmod(F.xxhash64("item"), F.col("_nb")).alias("b"))
               .count().collect())
    assert len(buckets) == 30 and max(r["count"] for r in buckets) <= 200


def test_hot_group_pairs_exact(spark):
    df = _skewed(spark, hot_rows=300)
    pairs = pairs_within_groups(df, ["g"], "item", block_size=40)
    counts = {r.g: r["count"] for r in pairs.groupBy("g").count().collect()}
    assert counts[0] == 300 * 299 // 2 and counts[1] == 10
    assert pairs.filter("item_1 >= item_2").count() == 0
    assert pairs.select("g", "item_1", "item_2").distinct().count() == pairs.count()


def test_salted_join_hot_key(spark):
    left = _skewed(spark, hot_rows=500)
    right = spark.createDataFrame([(0, "x"), (0, "y"), (1, "z")], "g long, tag string")
    out = salted_join(left, right, ["g"], "item", 50)
    assert out.count() == 500 * 2 + 5
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, left.join(right, "g").collect()))


def _rows_per_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


@pytest.fixture()
def eager_skew_split(spark):
    """AQE thresholds so low that small test data is split; no broadcasts."""
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_balanced_join_splits_a_hot_key(spark, eager_skew_split):
    """One key holds 80 % of the rows; the other side is an aggregate."""
    rows = spark.range(0, 20000, 1, 16).select(F.when(F.col("id") % 5 > 0, 0).otherwise(F.col("id")).alias("k"), F.xxhash64("id").alias("v"))
    per_key = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = balanced_join(rows, per_key, ["k"])
    assert max(_rows_per_task(out)) < 0.5 * 20000
    assert out.agg(F.sum("n")).first()[0] == rows.join(per_key, "k").agg(F.sum("n")).first()[0]


@pytest.mark.parametrize("left_hot,right_hot", [(True, False), (False, True), (True, True)])
def test_salted_join_splits_either_side(spark, left_hot, right_hot):
    """Bounded rows per (key, bucket, bucket) whichever side is hot, and the plain join's answer."""
    left = spark.range(1000).select(F.when(F.lit(left_hot) & (F.col("id") % 5 > 0), 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
    right = spark.range(1000).select(F.when(F.lit(right_hot) & (F.col("id") % 5 > 0), 7).otherwise(F.col("id")).alias("k"), (F.col("id") * 3).alias("b"))
    out = salted_join(left, right, ["k"], "a", 50)
    plain = left.join(right, "k")
    total = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("k", "a", "b").cast("decimal(38,0)"))).first())
    assert total(out) == total(plain)


def test_salted_join_bounds_a_key(spark):
    """800 rows of one key on both sides, blocks of 50: no join key pairs more than about 2 x 50 rows a side."""
    from sparkmill.operators import skew

    side = spark.range(800).select(F.lit(1).alias("k"), F.col("id").alias("a"))
    out = skew.salted_join(side, side.withColumnRenamed("a", "b"), ["k"], "a", 50)
    cells = (out.select(F.pmod(F.xxhash64("a"), F.lit(16)).alias("x"), F.pmod(F.xxhash64("k", "b"), F.lit(16)).alias("y"))
             .groupBy("x", "y").count().collect())
    assert len(cells) == 256 and max(c["count"] for c in cells) <= 100 * 100 and sum(c["count"] for c in cells) == 640000


@pytest.mark.parametrize("block,per_task", [(2000, 1_000_000), (4, 1_000_000), (2000, 5), (4, 5)])
def test_sums_of_pairs_equal_grouped_pairs(spark, block, per_task):
    """Hot groups, hot items, repeated rows and nulls: the same sums as of the pairs themselves."""
    rows = [(u, i, float((u * i) % 5)) for u in range(12) for i in range(15) if (u + i) % 3 or u == 0]
    rows += [(0, 3, 2.0), (None, 3, 1.0), (None, 4, 1.0), (5, None, 1.0), (5, 4, None)]
    df = spark.createDataFrame(rows, "user long, item long, r double")
    sums = [F.sum(F.col("r_1") * F.col("r_2")).alias("dot"), F.count(F.lit(1)).alias("n")]
    want = {tuple(x) for x in pairs_within_groups(df, ["user"], "item", ["r"], keep_group=False).groupBy("item_1", "item_2").agg(*sums).collect()}
    got = [tuple(x) for x in sums_of_pairs(df, "user", "item", ["r"], sums, block, pairs_per_task=per_task).select("item_1", "item_2", "dot", "n").collect()]
    assert len(got) == len(want) and set(got) == want
    both = [tuple(x) for x in sums_of_pairs(df, "user", "item", ["r"], sums, block, True, pairs_per_task=per_task).select("item_1", "item_2", "dot", "n").collect()]
    assert len(both) == 2 * len(want) and set(both) == want | {(b, a, d, n) for a, b, d, n in want}


def test_no_pair_is_shuffled(spark):
    """The similarity of a pair is summed where it is formed, and neighbours are ranked there."""
    from sparkmill.operators import recommend as rc

    df = spark.createDataFrame([(u, i, 1.0) for u in range(9) for i in range(9) if (u * i) % 4], "user long, item long, rating double")
    for out in (rc.cosine_similarity(df), rc.sampled_similarity(df, 0.1), rc.cosine_neighbors(df, 3)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        moved = [line for line in plan.split("\n") if "Exchange hashpartitioning(item" in line]
        assert len(moved) == 1 and "REPARTITION_BY_NUM" in moved[0] and "item_2" not in moved[0]
