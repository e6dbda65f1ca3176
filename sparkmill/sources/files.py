"""File sources S1-S8: text lines, whole files, '::' and CSV ratings, movies,
access logs, edge lists and stop-word lists.  All schemas are explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmill.functions.weblog import log_fields

RATING_SCHEMA = T.StructType([
    T.StructField("user", T.IntegerType()),
    T.StructField("item", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("ts", T.LongType()),
])
MOVIE_SCHEMA = T.StructType([
    T.StructField("item", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``; partitions follow maxPartitionBytes."""
    return spark.read.text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``path``, ``text`` (whole content)."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))


def _read_double_colon(spark: SparkSession, path: str, schema: T.StructType, mode: str) -> DataFrame:
    return (spark.read.schema(schema).option("sep", "::").option("mode", mode)
            .option("quote", "\u0000").csv(path))


def read_ratings_dat(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """S3: ``user::item::rating::ts`` lines (no header)."""
    return _read_double_colon(spark, path, RATING_SCHEMA, mode)


def read_movies_dat(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """``item::title::genres`` lines; titles may contain commas and quotes."""
    return _read_double_colon(spark, path, MOVIE_SCHEMA, mode)


#: First line of rating files of S5.
CSV_HEADER = "userId,movieId,rating,timestamp"


def read_ratings_csv(spark: SparkSession, path: str, mode: str = "FAILFAST", header: str = CSV_HEADER) -> DataFrame:
    """``userId,movieId,rating,timestamp`` lines.  Every line equal to ``header`` is dropped wherever it stands, so
    files may have it once, each, repeatedly (joined files) or not at all.  Other lines must parse; with another ``mode`` than
    FAILFAST, fields that do not are null."""
    names = [f.name for f in RATING_SCHEMA.fields]
    lines = spark.read.schema(", ".join(f"{n} string" for n in names)).option("mode", mode).csv(path)
    is_header = F.lit(True)
    for n, h in zip(names, header.split(","), strict=True):
        is_header = is_header & F.col(n).eqNullSafe(F.lit(h))
    typed = [F.col(f.name).cast(f.dataType) if mode == "FAILFAST" else F.col(f.name).try_cast(f.dataType) for f in RATING_SCHEMA.fields]
    return lines.filter(~is_header).select(*[c.alias(n) for c, n in zip(typed, names, strict=True)])


def read_access_log(spark: SparkSession, path: str, lenient: bool = False, compat: bool = True) -> DataFrame:
    """Access-log lines parsed into typed fields plus ``is_valid`` and ``raw``."""
    return parse_log_lines(read_lines(spark, path).withColumnRenamed("value", "raw"), "raw", lenient, compat)


def parse_log_lines(df: DataFrame, line_col: str = "raw", lenient: bool = False,
                    compat: bool = True) -> DataFrame:
    return log_fields(df, line_col, lenient, compat)


def parse_edge_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Drop lines containing '#', split on whitespace, keep the first two
    tokens; blank or one-token lines are dropped; edges are de-duplicated.

    One cached pattern reads both tokens; ``split`` would compile its pattern for every line."""
    two = "^[ \\t\\n\\r\\f\\x0B]*([^ \\t\\n\\r\\f\\x0B]+)[ \\t\\n\\r\\f\\x0B]+([^ \\t\\n\\r\\f\\x0B]+)"
    return (lines.filter(~F.col(line_col).contains("#"))
            .select(F.regexp_extract(line_col, two, 1).alias("src"), F.regexp_extract(line_col, two, 2).alias("dst"))
            .filter(F.col("dst") != "")
            .distinct())


def read_edge_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_edge_lines(read_lines(spark, path))


def stop_words(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, as a table (word), for lists of any length."""
    return read_lines(spark, path).select(F.trim("value").alias("word")).filter("word <> ''").distinct()


def read_stop_words(spark: SparkSession, path: str) -> list[str]:
    """One word per line, as a list for a plan's literals.  The list comes to the
    driver whole; a long one stays a table (``stop_words``)."""
    return sorted(r.word for r in stop_words(spark, path).collect())
