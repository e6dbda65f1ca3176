"""Connected components by alternating large and small stars.

Labels spread through joins and grouped minima only; each round is written to the
shared folder, so lineage stays short and no link comes to the driver.  The minima are
written before they are joined: a join with an aggregate takes over its placing, and the links
of a hub would lie in one task; with two plain tables Spark broadcasts the minima if their
size in bytes allows, or splits the hub's links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmill.llm.store import stored


def _least(pairs: DataFrame, name: str) -> DataFrame:
    """(u, m): the least of u and the nodes it is paired with, as a written table."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("lu"), F.least("u", "m").alias("m"))
    return stored(least, f"{name}-least")


def _large_star(edges: DataFrame, name: str) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.filter("v > u").join(_least(both, name), F.col("u") == F.col("lu"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, name: str) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down, name)
    joined = down.join(least, F.col("u") == F.col("lu"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("lu").alias("u"), F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.col("v") % 1000003).alias("s")).first()
    return r["n"], r["x"], r["s"]


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node of ``links`` (u, v longs); root is the least node it can reach."""
    edges = stored(links.select("u", "v").filter("u <> v").distinct(), name)
    before = None
    while True:
        wide = stored(_large_star(edges, name).distinct(), f"{name}-large")
        edges = stored(_small_star(wide, name).filter("u <> v").distinct(), name)
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
