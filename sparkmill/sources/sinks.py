"""Sinks S9 (cleaned documents) and S10 (rating splits)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_clean_documents(clean: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """One row per document (doc id, cleaned text); ``fmt='text'`` writes the text column only."""
    if fmt == "text":
        clean.select("text").write.mode(mode).text(path)
    else:
        clean.write.mode(mode).format(fmt).save(path)


#: Classes of texts by length in bytes, and how many of each class share a file: no more than 8 MiB or one text.
FILE_CLASSES = ((1 << 14, 512), (1 << 18, 32), (None, 1))


def write_document_files(clean: DataFrame, path: str) -> None:
    """Text files for readers that take each file whole (S2): a file holds at most 8 MiB, or one text, however many rows a task writes."""
    from pyspark.sql import functions as F

    from sparkmill.session import written

    clean = written(clean.select("text"), "clean-documents")
    size, least = F.coalesce(F.octet_length("text"), F.lit(0)), -1
    for most, rows in FILE_CLASSES:
        part = clean.filter(size > least) if most is None else clean.filter((size > least) & (size <= most))
        part.write.mode("append").option("maxRecordsPerFile", rows).text(path)
        least = most


def write_splits(split_df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """All splits in one write, partitioned by ``split`` (readers prune by partition)."""
    split_df.write.mode(mode).partitionBy("split").format(fmt).save(path)


def write_ratings_dat(ratings: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``user::item::rating::ts`` text lines, as the reference's split files."""
    from pyspark.sql import functions as F

    line = F.concat_ws("::", F.col("user").cast("string"), F.col("item").cast("string"),
                       F.col("rating").cast("string"), F.col("ts").cast("string"))
    ratings.select(line.alias("value")).write.mode(mode).text(path)


def write_ratings_csv(ratings: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Comma-separated rating lines with the header of S5 in each file."""
    from sparkmill.sources.files import CSV_HEADER

    ratings.select("user", "item", "rating", "ts").toDF(*CSV_HEADER.split(",")).write.mode(mode).option("header", True).csv(path)


def write_movies_dat(movies: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``item::title::genres`` text lines."""
    from pyspark.sql import functions as F

    movies.select(F.concat_ws("::", F.col("item").cast("string"), "title", "genres").alias("value")).write.mode(mode).text(path)
