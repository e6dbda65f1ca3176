"""Inputs derived from the driver's parquet tables.

The reference reads rating files, access logs, edge lists and document
folders; the test tables hold orders, line items, events and documents.
These adapters turn the tables into those shapes with plain DataFrame
plans, using every row (no sampling, no id subsets):

* ratings: (customer, part) pairs from line items joined with their order;
  rating = max(ceil(quantity / 10)) on a 1-5 scale, ts = latest order time;
* log lines: one Common Log Format line per event; status follows the event
  type, corrupted records are events whose payload key is 97 or more;
* edges: edge-list lines of a directed graph over parts, suppliers, customers, orders,
  nations and regions with string node ids ('p1', 's7', 'c42'), each edge taken from one
  row (or a line item joined with its order), so no derivation pairs rows of a group;
* words per document: the cleaned, stop-word-free tokens of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmill.sources.files import parse_edge_lines

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user bigint, item bigint, rating double, ts bigint), one row per pair."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = li.join(od, li.l_orderkey == od.o_orderkey)
    return (joined.groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
            .agg(F.max(F.ceil(F.col("l_quantity") / 10)).cast("double").alias("rating"),
                 # unix_timestamp of a timestamp_ntz reads the wall clock as UTC,
                 # independent of the session time zone.
                 F.max(F.unix_timestamp("o_orderdate")).alias("ts")))


def item_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item bigint, title string); titles are not unique."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item"),
                                               F.col("p_name").alias("title"))


# Status per event type: purchases and clicks succeed, views are "not
# modified", sign-ups redirect, errors are "not found".
STATUS_BY_TYPE = {"click": 200, "purchase": 200, "view": 304, "signup": 302, "error": 404}


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id bigint, raw string): one access-log line per event."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    status = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in STATUS_BY_TYPE.items()],
                        F.lit(500))
    key = F.get_json_object("props", "$.k").cast("int")
    size = F.when(F.col("event_type").isin("view", "signup"), F.lit("-")) \
            .otherwise(F.floor(F.col("value") * 100).cast("bigint").cast("string"))
    line = F.concat(
        F.lit("host"), F.col("user_id").cast("string"), F.lit(" - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' -0400] "GET /'),
        F.col("event_type"), F.lit("/"), F.coalesce(key.cast("string"), F.lit("x")),
        F.lit(' HTTP/1.0" '), status.cast("string"), F.lit(" "), size)
    corrupt = F.concat(F.lit("corrupt record "), F.col("event_id").cast("string"))
    return ev.select("event_id", F.when(key >= 97, corrupt).otherwise(line).alias("raw"))


def graph_edge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value string): edge-list lines ``src<tab>dst`` of the graph, one per row that
    holds the edge, and comment lines.

    part -> supplier -> customer -> part, order -> customer (orders have no in-links),
    customer -> nation -> region (nations are hubs by in-degree, regions have no out-links)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu, na = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    lo = li.join(od, li.l_orderkey == od.o_orderkey)

    def lines(df: DataFrame, a: str, src: str, b: str, dst: str) -> DataFrame:
        return df.select(F.concat(F.lit(a), F.col(src).cast("string"), F.lit(f"\t{b}"), F.col(dst).cast("string")).alias("value"))

    comments = table(spark, sf_dir, "region").select(F.concat(F.lit("# region "), F.col("r_regionkey").cast("string"), F.lit(" x")).alias("value"))
    parts = [lines(li, "p", "l_partkey", "s", "l_suppkey"), lines(lo, "s", "l_suppkey", "c", "o_custkey"),
             lines(lo, "c", "o_custkey", "p", "l_partkey"), lines(od, "o", "o_orderkey", "c", "o_custkey"),
             lines(cu, "c", "c_custkey", "n", "c_nationkey"), lines(na, "n", "n_nationkey", "r", "n_regionkey")]
    for p in parts:
        comments = comments.unionByName(p)
    return comments


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (src string, dst string) edges, parsed from the lines."""
    return parse_edge_lines(graph_edge_lines(spark, sf_dir))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")
