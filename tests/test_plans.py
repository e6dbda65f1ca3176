"""Plan checks on the registered queries (sf0.001): built-in expressions only,
no Cartesian products or nested-loop joins, top-k as TakeOrderedAndProject,
filters and column pruning reaching the parquet scan."""

import pytest

import __spark_entry__ as E
from sparkmill.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "PythonUDF"]
SKIP = {"als_predict", "als_rank_search", "als_scored_pairs", "method_comparison", "method_comparison_checked", "frequent_sets_fpgrowth"}


def _plan(df):
    """The plan that ran: rows are counted on the executors first, so that AQE's plan is final."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    plan = execution.executedPlan().toString()
    assert "isFinalPlan=false" not in plan.split("\n", 1)[0]
    return plan.split("== Initial Plan ==")[0]


WINDOWED = {"item_neighbors_top10", "user_neighbors_top10"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_plan_shape(spark, name):
    """No Python or Cartesian nodes; windows only in top-n-per-key queries, with a partial group limit."""
    plan = _plan(QUERIES[name](spark, SF))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"
    if name in WINDOWED:
        assert "WindowGroupLimit" in plan and "SinglePartition" not in plan
    else:
        assert "Window" not in plan, name


@pytest.mark.parametrize("name", ["word_count_clean_top20", "log_top_error_endpoints", "top_rated_items",
                                  "pagerank_top20", "frequent_quads_top10"])
def test_top_k_is_take_ordered(spark, name):
    assert "TakeOrderedAndProject" in _plan(QUERIES[name](spark, SF))


def test_scan_prunes_columns(spark):
    plan = _plan(QUERIES["ratings"](spark, SF))
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["word", "n"]


def test_oracle_covers_queries():
    q, s = set(QUERIES), set(E.oracle_sql())
    assert s <= set(E.queries()) and q - s == E.NO_ORACLE


TEXT_AND_LOG = ["word_count_raw", "word_count_lower", "word_count_clean", "clean_documents", "log_records", "log_parse_stats",
                "log_unique_hosts", "log_daily_hosts", "log_404_count", "log_top_404_endpoints", "log_top_error_endpoints"]


@pytest.mark.parametrize("name", TEXT_AND_LOG)
def test_input_is_a_pruned_scan(spark, name):
    """No checkpoint stands before the scan, no job but the footer read starts while the plan is built, unused columns are not read."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"plan-{name}", name)
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert len(tracker.getJobIdsForGroup(f"plan-{name}")) <= 1  # the parquet footer
    assert "FileScan parquet" in plan and "ExistingRDD" not in plan
    assert "n_chars" not in plan and "source" not in plan and "session_id" not in plan

