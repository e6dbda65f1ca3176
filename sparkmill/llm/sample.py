"""Bounded samples of labelled documents, on which classifiers are trained."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts longer than this are not trained on (they are scored whole like any other).
MOST_BYTES = 1 << 16


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned from; a null id counts as not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(id, label 0/1) of the ids outside the held-out fold that have one label only."""
    rows = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label")).filter("id is not null and label in (0, 1)")
    rows = rows.withColumn("out", held_out("id")).filter("not out")
    return (rows.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most")).filter("label = most").select("id", "label"))


def training_texts(docs: DataFrame, labels: DataFrame, label: str, per_class: tuple[int, int], id_col: str = "doc_id",
                   text_col: str = "text", most_bytes: int = MOST_BYTES) -> tuple[pa.Table, tuple[int, int]]:
    """((label, text) of at most ``per_class[c]`` documents of each class, in a
    pseudo-random order; how many ids each class has).  The ids are chosen by hash, and of rows of one id
    the text of the least hash, however often it is repeated."""
    ids = labelled(labels, label, id_col)
    counts = {r["label"]: r["count"] for r in ids.groupBy("label").count().collect()}
    order = F.xxhash64("id", F.lit(7))
    chosen = None
    for c in (0, 1):
        part = ids.filter(F.col("label") == c).orderBy(order, "id").limit(per_class[c])
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.octet_length("text") <= most_bytes)
    one = (texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("row")))
    table = one.select("label", F.col("row.text").alias("text"), order.alias("o"), "id").toArrow()  # at most sum(per_class) rows
    table = table.sort_by([("o", "ascending"), ("id", "ascending"), ("text", "ascending")]).select(["label", "text"])
    return table, (counts.get(0, 0), counts.get(1, 0))
