"""Write PLANS.md: a physical-plan summary of every registered query.

usage: python tools/plan_report.py [sf_dir]   (default /root/testdata/sf0.01)
Counts come from the frame's own final AQE plan, after its rows have been counted on the
executors; the notes column is the scale review for that query.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkmill.plans.queries import QUERIES  # noqa: E402
from sparkmill.session import build_session  # noqa: E402

NOTES = [  # most specific key first
    ("fpgrowth", "pyspark.ml parallel FP-growth over per-document word sets (cross-check)"),
    ("neighbors", "row_number with WindowGroupLimit: ≤ n rows per key leave each map task"),
    ("cosine", "salted per-group pairs, norms attached before pairing, partial aggregate"),
    ("cf_", "only similarities of wanted targets; salted many-to-many join on the user/item, pair join AQE can split"),
    ("top_rated", "filter on count before the title join; TakeOrderedAndProject"),
    ("item_rating_stats", "per-item aggregate; titles joined without hint (AQE decides at run time)"),
    ("ratings_by_time", "range sort + numbering from per-partition counts"),
    ("ratings", "line items ⋈ orders on order key (unique on orders side) + partial aggregate"),
    ("time_split", "range sort on (ts, user, item) + checkpoint; offsets as literals"),
    ("random_split", "partition-independent md5 split; counts by partial aggregate"),
    ("baseline", "means joined on unique keys; global mean as scalar subquery"),
    ("norms", "per-key aggregate"),
    ("means", "per-key aggregate"),
    ("global_mean", "partial + final aggregate"),
    ("als", "pyspark.ml ALS (blocked factor solves)"),
    ("method", "ALS + baseline + CF on one split"),
    ("pagerank", "cached (src, salt)-partitioned edges; shares shuffled per round; checkpoint every 2 rounds"),
    ("graph_edges", "row-local edges, union, distinct"),
    ("edge_degrees", "one union + partial aggregate"),
    ("adjacency", "range sort on (src, dst) + numbering; a hub is cut over tasks"),
    ("quad_candidates", "candidates pruned by semi-joins before counting"),
    ("frequent", "level-wise on demand; salted pair generation; joins with plain tables, which AQE can split"),
    ("clean_documents", "projection only (no shuffle)"),
    ("word_count", "explode + partial aggregate; a hot word costs one row per map task"),
    ("log_records", "one regex pass per line; projection only"),
    ("log_", "one regex pass per line; one aggregate per report"),
]


def note(name: str) -> str:
    for k, v in NOTES:
        if k in name:
            return v
    return ""


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="plan-report-"), "spark.driver.memory": "8g"})
    lines = ["# Physical plans of the registered queries", "",
             f"Executed (AQE final) plans at `{sf_dir}`, local[8], 8 shuffle partitions; generated by "
             "`tools/plan_report.py`. Exchanges = shuffles in the final query (stages materialised "
             "earlier by checkpoints are not repeated here). Python UDF nodes, Cartesian products and "
             "nested-loop joins: none in any query (see `tests/test_plans.py`).", "",
             "| Query | Exchanges | Joins (SMJ / BHJ) | Broadcasts | Parquet scans with pushed filters | Checkpoint reads | Scale note |",
             "| --- | --- | --- | --- | --- | --- | --- |"]
    for name, fn in QUERIES.items():
        if name in ("als_predict", "als_rank_search", "als_scored_pairs", "method_comparison", "method_comparison_checked", "frequent_sets_fpgrowth"):
            lines.append(f"| `{name}` | – | – | – | – | – | {note(name)} |")
            continue
        df = fn(spark, sf_dir)
        df._jdf.queryExecution().toRdd().count()  # runs this very plan, rows stay on the executors
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=false" not in plan.split("\n", 1)[0], name
        plan = plan.split("== Initial Plan ==")[0]
        ex = len(re.findall(r"(?<!Reused)Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        smj = plan.count("SortMergeJoin")
        bhj = plan.count("BroadcastHashJoin")
        bc = len(re.findall(r"(?<!Reused)BroadcastExchange", plan))
        pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", plan))
        scans = plan.count("FileScan parquet")
        ck = plan.count("Scan ExistingRDD")
        lines.append(f"| `{name}` | {ex} | {smj} / {bhj} | {bc} | {pushed} of {scans} | {ck} | {note(name)} |")
        print(name, ex, smj, bhj, flush=True)
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
