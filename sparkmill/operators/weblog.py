"""Access-log reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_stats(records: DataFrame) -> DataFrame:
    """One row: lines read, parsed and failed, in a single aggregate pass."""
    return records.agg(F.count(F.lit(1)).alias("n_read"),
                       F.count_if(F.col("is_valid")).alias("n_parsed"),
                       F.count_if(~F.col("is_valid")).alias("n_failed"))


def invalid_sample(records: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` unparsable lines, ordered by the raw text."""
    return records.filter(~F.col("is_valid")).select("raw").orderBy("raw").limit(n)


def _endpoint_counts(valid: DataFrame) -> DataFrame:
    return valid.groupBy("endpoint").agg(F.count(F.lit(1)).alias("n"))


def top_error_endpoints(records: DataFrame, k: int = 10) -> DataFrame:
    """Endpoints most often answered with a status other than 200."""
    bad = records.filter(F.col("is_valid") & (F.col("response_code") != 200))
    return _endpoint_counts(bad).orderBy(F.col("n").desc(), F.col("endpoint")).limit(k)


def unique_hosts(records: DataFrame) -> DataFrame:
    return records.filter("is_valid").agg(F.countDistinct("host").alias("n_hosts"))


def daily_hosts(records: DataFrame, n: int = 30, by_date: bool = False) -> DataFrame:
    """Distinct hosts per day of month (or per calendar date), first ``n`` days."""
    day = F.to_date("date_time") if by_date else F.dayofmonth("date_time")
    return (records.filter("is_valid")
            .groupBy(day.alias("day"))
            .agg(F.countDistinct("host").alias("n_hosts"))
            .orderBy("day").limit(n))


def not_found_count(records: DataFrame) -> DataFrame:
    return records.agg(F.count_if(F.col("is_valid") & (F.col("response_code") == 404)).alias("n_404"))


def top_not_found_endpoints(records: DataFrame, k: int = 20) -> DataFrame:
    bad = records.filter(F.col("is_valid") & (F.col("response_code") == 404))
    return _endpoint_counts(bad).orderBy(F.col("n").desc(), F.col("endpoint")).limit(k)


#: Buckets of a host sketch are 2**SKETCH_BITS; the relative standard error is about 0.83 / sqrt of that (1.3 percent).
SKETCH_BITS = 12
SKETCH_ERROR = 0.05  # about four standard errors


def host_sketches(records: DataFrame, by_date: bool = False, bits: int = SKETCH_BITS) -> DataFrame:
    """(day, sketch): a mergeable sketch of the hosts of each day, a few KB each however many hosts there are.  Kept, it
    answers for any range of days without reading the log again, and a new day's is added to it."""
    day = F.to_date("date_time") if by_date else F.dayofmonth("date_time")
    return records.filter("is_valid").groupBy(day.alias("day")).agg(F.hll_sketch_agg("host", F.lit(bits)).alias("sketch"))


def sketched_daily_hosts(sketches: DataFrame) -> DataFrame:
    """(day, estimate) of each day."""
    return sketches.select("day", F.hll_sketch_estimate("sketch").alias("estimate"))


def sketched_hosts(sketches: DataFrame, first=None, last=None) -> DataFrame:
    """One row: the estimate of the distinct hosts of all days, or of those from ``first`` to ``last``."""
    some = sketches if first is None else sketches.filter(F.col("day").between(first, last))
    return some.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def write_observed(records: DataFrame, path: str) -> dict[str, int]:
    """Write the records as Parquet and return how many lines were read, parsed and failed, counted by that
    same job: no second pass over the log."""
    from pyspark.sql import Observation

    seen = Observation()
    counted = records.observe(seen, F.count(F.lit(1)).alias("n_read"), F.count_if(F.col("is_valid")).alias("n_parsed"),
                              F.count_if(~F.col("is_valid")).alias("n_failed"))
    counted.write.parquet(path)
    return {k: int(v) for k, v in seen.get.items()}
