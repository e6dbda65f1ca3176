"""Structured Streaming entry points for the line-oriented operators.

The reference is batch-only; these run the same column expressions over a
file stream (new files in a folder), so a growing log or text folder can be
reported on incrementally.  Aggregates keep their state in the checkpoint
location supplied by the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmill.functions.text import clean_text, whitespace_tokens
from sparkmill.functions.weblog import log_fields


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def streaming_word_counts(lines: DataFrame, mode: str = "clean") -> DataFrame:
    """Running (word, n) over a stream of lines; use output mode ``update`` or ``complete``."""
    text = clean_text(F.col("value")) if mode == "clean" else (
        F.lower(F.col("value")) if mode == "lower" else F.col("value"))
    return (lines.select(F.explode(whitespace_tokens(text)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def streaming_log_records(lines: DataFrame, lenient: bool = True) -> DataFrame:
    """Parsed access-log records from a line stream (lenient by default: a bad
    line must not stop a long-running query)."""
    return log_fields(lines, "value", lenient)


def streaming_endpoint_status_counts(records: DataFrame) -> DataFrame:
    """Running request counts per (endpoint, response_code) for valid lines."""
    return (records.filter("is_valid").groupBy("endpoint", "response_code")
            .agg(F.count(F.lit(1)).alias("n")))
