"""Rating statistics, splits, RMSE and the bias baseline
(A9-A11, A15, A22, J1, J2, J7, K7, K8, P1, P2, R5, F16, F18, F19)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmill.functions.metrics import squared_error
from sparkmill.operators.ordering import global_row_number
from sparkmill.operators.skew import balanced_join
from sparkmill.session import checkpoint_dir


def item_stats(ratings: DataFrame) -> DataFrame:
    """(item, n_ratings, avg_rating) per item."""
    return ratings.groupBy("item").agg(F.count(F.lit(1)).alias("n_ratings"),
                                       F.avg("rating").alias("avg_rating"))


def item_stats_with_titles(ratings: DataFrame, titles: DataFrame) -> DataFrame:
    """Per-item stats joined to titles (inner join: items without a title drop).

    No broadcast hint: the title table grows with the catalogue, so AQE picks
    broadcast only when the runtime size is under its threshold."""
    return item_stats(ratings).join(titles, "item")


def top_rated(ratings: DataFrame, titles: DataFrame, min_ratings: int = 500, k: int = 20) -> DataFrame:
    """Items with more than ``min_ratings`` ratings, best first by the average
    rounded to 3 decimals, then title descending (item id descending as last key)."""
    stats = item_stats(ratings).filter(F.col("n_ratings") > min_ratings)
    return (stats.join(titles, "item")
            .orderBy(F.round("avg_rating", 3).desc(), F.col("title").desc(), F.col("item").desc())
            .limit(k)
            .select("avg_rating", "title", "n_ratings", "item"))


def global_mean(ratings: DataFrame):
    """Scalar-subquery column with the mean rating."""
    return ratings.agg(F.avg("rating")).scalar()


def user_means(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("user").agg(F.avg("rating").alias("user_mean"),
                                       F.count(F.lit(1)).alias("n_ratings"))


def item_means(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("item").agg(F.avg("rating").alias("item_mean"),
                                       F.count(F.lit(1)).alias("n_ratings"))


def hash_split(ratings: DataFrame, weights=(8, 1, 1), names=("train", "valid", "test"),
               seed: int = 0) -> DataFrame:
    """Reproducible random split: the first 32 bits of md5("seed,user,item") modulo sum(weights).

    Unlike ``randomSplit`` the outcome does not depend on the partitioning, and any engine with
    md5 can recompute it."""
    total = sum(weights)
    digest = F.md5(F.concat_ws(",", F.lit(str(seed)), F.col("user").cast("string"), F.col("item").cast("string")))
    bucket = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(total))
    expr, upper = None, 0
    for w, name in zip(weights, names):
        upper += w
        cond = bucket < upper
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return ratings.withColumn("split", expr)


def random_split(ratings: DataFrame, weights=(8, 1, 1), seed: int = 0) -> list[DataFrame]:
    """``randomSplit`` as in the reference (depends on the input partitioning)."""
    return ratings.randomSplit([float(w) for w in weights], seed)


#: Bins of one step of the cut-off search; so many rows at most come to the driver.
CUT_BINS = 1 << 14


def _value_at(per: DataFrame, place: int, low: int, high: int, met: dict) -> tuple[int, int, int]:
    """(value, rows before it, rows of it) of the ``place``-th row, from rows (_k, _n): the range that
    holds it is cut into bins, and the bin that holds it into bins again, until it is one value.  ``met`` keeps
    the counts of ranges asked for before."""
    before = 0
    while True:
        width = -(-(high - low + 1) // CUT_BINS)
        bins = F.expr(f"(cast(_k as decimal(20,0)) - {low}bd) div {width}bd")
        if (low, high) not in met:
            rows = per.filter(F.col("_k").between(low, high)).groupBy(bins.alias("bin")).agg(F.sum("_n").alias("n")).collect()
            met[low, high] = sorted((r["bin"], r["n"]) for r in rows)
        for at, n in met[low, high]:
            if before + n >= place:
                break
            before += n
        low, high = low + at * width, min(high, low + at * width + width - 1)
        if low == high:
            return low, before, n


def time_split(ratings: DataFrame, n_test: int | None = 100_000, n_valid: int | None = 100_000,
               frac_test: float | None = None, frac_valid: float | None = None,
               newest_first: bool = False) -> DataFrame:
    """Time-ordered split: the first ``n_test`` rows by (ts, user, item) are
    ``test``, the next ``n_valid`` are ``valid``, the rest ``train``.  Sizes may
    be given as fractions of the row count instead.  ``newest_first`` orders
    by descending time instead (the reference sorts ascending).  ``ts`` is a whole number; rows
    without one come first in ascending order and last in descending order.

    Cut-off search: rows are counted per time, and the two times that hold the cut-offs are found by
    histograms over that table of counts.  All other rows are told by their time alone; only the rows of those two times
    are numbered, by a range sort that spreads a time with very many rows over tasks by (user, item).
    ``ratings`` is read three times: write it first if it is costly to form."""
    checkpoint_dir(ratings.sparkSession)
    ts = -F.col("ts").cast("long") if newest_first else F.col("ts").cast("long")
    per = ratings.groupBy(ts.alias("_k")).agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    found = per.agg(F.sum("_n").alias("total"), F.min("_k").alias("low"), F.max("_k").alias("high")).first()
    total, low, high = found["total"] or 0, found["low"] or 0, found["high"] or 0
    none = high + 1 if newest_first else low - 1  # stands for no time
    per, low, high = per.select(F.coalesce("_k", F.lit(none)).alias("_k"), "_n"), min(low, none), max(high, none)
    c1 = math.floor(total * frac_test) if frac_test is not None else n_test
    c2 = c1 + (math.floor(total * frac_valid) if frac_valid is not None else n_valid)
    met: dict = {}
    cuts = [_value_at(per, c, low, high, met) for c in (c1, c2) if 0 < c < total]
    keyed = ratings.withColumn("_k", F.coalesce(ts, F.lit(none)))

    def side(place: Column) -> Column:
        return F.when(place <= c1, F.lit("test")).when(place <= c2, F.lit("valid")).otherwise(F.lit("train"))

    if not cuts:  # no cut-off lies between two rows: each is before the first row or behind the last
        return keyed.withColumn("split", side(F.lit(max(total, 1)))).drop("_k")
    # a place that lies on the same side of both cut-offs as every row of that time
    place = F.lit(total)
    for value, before, _ in reversed(cuts):
        place = F.when(F.col("_k") < value, F.lit(before)).otherwise(place)
    values = sorted({v for v, *_ in cuts})
    clear = keyed.filter(~F.col("_k").isin(values)).withColumn("split", side(place))
    numbered = global_row_number(keyed.filter(F.col("_k").isin(values)), ["_k", "user", "item"], name="_rn")
    shift = F.lit(cuts[0][1])
    if len(values) > 1:
        shift = F.when(F.col("_k") == values[1], F.lit(cuts[1][1] - cuts[0][2])).otherwise(shift)
    on = numbered.withColumn("split", side(F.col("_rn") + shift)).drop("_rn")
    return clear.unionByName(on).drop("_k")


def sort_by_time(ratings: DataFrame, newest_first: bool = False) -> DataFrame:
    """Ratings in time order, ties by (user, item), with their place in that order from 1
    (``position``): a range-partitioned sort, not a single-partition one."""
    ts = F.col("ts").desc() if newest_first else F.col("ts").asc()
    return global_row_number(ratings, [ts, F.col("user").asc(), F.col("item").asc()], name="position")


def split_counts(split_df: DataFrame) -> DataFrame:
    return split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def rmse(predictions: DataFrame, actual: DataFrame, pred_col: str = "prediction") -> DataFrame:
    """One row (rmse, n) over (user, item) pairs present on both sides; NULL
    rmse with n = 0 when nothing matches."""
    joined = predictions.select("user", "item", pred_col).join(
        actual.select("user", "item", "rating"), ["user", "item"])
    return joined.agg(F.sqrt(F.avg(squared_error(F.col(pred_col), F.col("rating")))).alias("rmse"),
                      F.count(F.lit(1)).alias("n"))


def rmse_by_split(predictions: DataFrame, actual: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """(split, rmse, n) for each of ``names``; both sides have a ``split`` column."""
    spark = actual.sparkSession
    joined = predictions.select("split", "user", "item", "prediction").join(
        actual.select("split", "user", "item", "rating"), ["split", "user", "item"])
    scored = joined.groupBy("split").agg(F.sqrt(F.avg(squared_error(F.col("prediction"), F.col("rating")))).alias("rmse"),
                                         F.count(F.lit(1)).alias("n"))
    wanted = spark.createDataFrame([(x,) for x in names], "split string")
    return wanted.join(scored, "split", "left").select("split", "rmse", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def baseline_predict(train: DataFrame, pairs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Bias baseline ``user_mean + item_mean - global_mean`` for (user, item) pairs;
    a missing user or item mean falls back to the global mean.  Columns ``by`` of pairs are kept."""
    mu = global_mean(train)
    um = train.groupBy("user").agg(F.avg("rating").alias("_um"))
    im = train.groupBy("item").agg(F.avg("rating").alias("_im"))
    p = balanced_join(balanced_join(pairs.select("user", "item", *by), um, ["user"], "left"), im, ["item"], "left")
    pred = F.coalesce("_um", mu) + F.coalesce("_im", mu) - mu
    return p.select("user", "item", *by, pred.alias("prediction"))
