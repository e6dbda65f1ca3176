"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print one JSON line.  Each query is executed to completion with the no-op
sink (no collect to the driver), after one untimed warm-up query."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkmill.plans import queries as Q  # noqa: E402
from sparkmill.session import build_session  # noqa: E402

HEADLINE = [
    "word_count_clean_top20",
    "clean_documents",
    "log_records",
    "log_top_error_endpoints",
    "log_daily_hosts",
    "item_rating_stats",
    "top_rated_items",
    "time_split",
    "baseline_rmse",
    "item_cosine",
    "user_cosine",
    "item_cf_predict",
    "user_cf_predict",
    "pagerank_node_report",
    "frequent_quads_top10",
    "als_rank_search",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    extra = {"spark.checkpoint.dir": tempfile.mkdtemp(prefix="sparkmill-bench-ckpt-"),
             "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")}
    if os.environ.get("BENCH_EVENT_LOG"):  # optional: stage timings for analysis
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    parts = int(os.environ.get("BENCH_PARTITIONS", str(cpus)))  # one shuffle partition per core at this size
    spark = build_session(f"local[{cpus}]", parts, "sparkmill-bench", extra)
    Q.word_count_clean_top20(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in only or HEADLINE:
        t0 = time.perf_counter()
        Q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
