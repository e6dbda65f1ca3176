"""Global ordering without a single-partition window: ranks, top-k with ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmill.session import checkpoint_dir, written

_LOCAL_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def global_row_number(df: DataFrame, order_cols: Sequence[Column | str], name: str = "rn",
                      num_partitions: int | None = None, total_name: str | None = None, keep_order: bool = True) -> DataFrame:
    """1-based row number over a total order, computed in parallel.

    1. range-partition on the order keys and sort inside partitions (a
       distributed sort; a hot leading key is split by the later keys);
    2. tag rows with their partition and local position and checkpoint, so the
       numbering is fixed on reliable storage and survives executor loss (without ``keep_order``
       as Parquet, which is smaller and sorts once, but is not read back in order);
    3. count rows per partition -- one row per range partition, a bound we
       choose, so it may come to the driver -- and add each partition's
       offset as a literal array lookup: a plain projection, no join.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    ranged = (df.repartitionByRange(parts, *cols)
                .sortWithinPartitions(*cols)
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = ranged.checkpoint(eager=True) if keep_order else written(ranged, "numbered")
    pid = F.shiftrightunsigned(F.col("_mid"), _LOCAL_BITS)
    local = F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    counts = {r["_pid"]: r["_cnt"] for r in
              ranged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt")).collect()}
    n_slots = (max(counts) + 1) if counts else 1
    offsets, run = [], 0
    for p in range(n_slots):
        offsets.append(run)
        run += counts.get(p, 0)
    offset = F.element_at(F.array(*[F.lit(o).cast("bigint") for o in offsets]), (pid + 1).cast("int"))
    out = ranged.withColumn(name, offset + local + 1)
    if total_name:
        out = out.withColumn(total_name, F.lit(run).cast("bigint"))
    return out.drop("_mid")


def kth_largest(df: DataFrame, value_col: str, k: int) -> Column:
    """Scalar-subquery column holding the k-th largest value (ties counted)."""
    return df.select(value_col).orderBy(F.col(value_col).desc()).limit(k) \
             .agg(F.min(value_col)).scalar()


def top_k_with_ties(df: DataFrame, value_col: str, k: int) -> DataFrame:
    """Every row whose value is at least the k-th largest value (== ``rank() <= k``).

    The threshold comes from a distributed top-k (``TakeOrderedAndProject``)
    evaluated as a scalar subquery, so no global window is needed.
    """
    return df.filter(F.col(value_col) >= kth_largest(df, value_col, k))


def top_n_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column],
                    n: int, name: str = "rank") -> DataFrame:
    """First ``n`` rows per group; Spark inserts a partial per-partition limit
    (``WindowGroupLimit``) before the shuffle, so a hot group ships at most n
    rows per map task."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
