import os

import pytest

from sparkmill.operators import graph
from sparkmill.sources.files import parse_edge_lines

EDGE_TEXT = ["# from to", "A\tB", "A\tC", "B\tC", "C\tA", "C\tE", "D\tC", "A\tB", "", "lonely"]
ROUNDS = {
    1: {"A": 0.575, "B": 0.575, "C": 2.275, "E": 0.575},
    2: {"A": 1.116875, "B": 0.394375, "C": 0.883125, "E": 1.116875},
    3: {"A": 0.525328125, "B": 0.624671875, "C": 0.959890625, "E": 0.525328125},
}


@pytest.fixture()
def edges(spark):
    return parse_edge_lines(spark.createDataFrame([(x,) for x in EDGE_TEXT], "value string"))


def test_edge_parse(edges):
    assert sorted(map(tuple, edges.collect())) == [("A", "B"), ("A", "C"), ("B", "C"), ("C", "A"),
                                                   ("C", "E"), ("D", "C")]


@pytest.mark.parametrize("block", [100_000, 1])
@pytest.mark.parametrize("n", [1, 2, 3])
def test_pagerank_rounds(edges, n, block):
    got = {r.node: r.rank for r in graph.pagerank(edges, n, block=block, checkpoint_interval=2).collect()}
    assert set(got) == set(ROUNDS[n])
    for k, v in ROUNDS[n].items():
        assert abs(got[k] - v) < 1e-12


def test_degrees(edges):
    d = {r.node: (r.in_degree, r.out_degree) for r in graph.degrees(edges).collect()}
    assert d == {"A": (1, 2), "B": (1, 1), "C": (3, 2), "D": (0, 1), "E": (1, 0)}


def test_node_report(edges):
    ranks = graph.pagerank(edges, 3)
    rep = {r.node: r for r in graph.node_report(edges, ranks, 20).collect()}
    assert abs(rep["A"].avg_neighbor_rank - 0.79228125) < 1e-12
    assert abs(rep["B"].avg_neighbor_rank - 0.959890625) < 1e-12
    assert abs(rep["C"].avg_neighbor_rank - 0.525328125) < 1e-12
    assert rep["E"].avg_neighbor_rank is None and rep["E"].out_degree == 0
    assert rep["C"].in_degree == 3 and rep["C"].out_degree == 2
    assert list(rep) == ["C", "B", "A", "E"] or set(rep) == {"A", "B", "C", "E"}


@pytest.mark.parametrize("parts", [1, 7])
def test_adjacency(spark, edges, parts):
    """One shape at every size: a hub's list is cut over tasks and numbered through."""
    hub = edges.unionByName(spark.createDataFrame([("H", f"n{i:03d}") for i in range(300)] + [("H", "n000")], "src string, dst string"))
    rows = sorted((r.src, r.position, r.dst) for r in graph.adjacency(hub, parts).collect())
    lists = {}
    for src, position, dst in rows:
        lists.setdefault(src, []).append(dst)
        assert position == len(lists[src])
    assert lists == {"A": ["B", "C"], "B": ["C"], "C": ["A", "E"], "D": ["C"], "H": [f"n{i:03d}" for i in range(300)]}


def test_pagerank_of_nodes_that_share_a_hash(spark, edges, monkeypatch):
    """Ids are hashes of nodes unless two nodes share one."""
    monkeypatch.setattr(graph.F, "xxhash64", lambda *c: graph.F.lit(7).cast("bigint"))
    got = {r.node: r.rank for r in graph.pagerank(edges, 3).collect()}
    assert {k: round(v, 9) for k, v in got.items()} == ROUNDS[3]


def test_rounds_hold_no_names(spark, edges, monkeypatch):
    """What a round joins and keeps in memory is lists of numbers."""
    kept = []
    lists = graph._salted_lists
    monkeypatch.setattr(graph, "_salted_lists", lambda e, block: kept.append(dict(e.dtypes)) or lists(e, block))
    graph.pagerank(edges, 1)
    assert kept == [{"src": "bigint", "dst": "bigint"}]


def test_edge_lines_are_not_split_by_a_compiled_pattern(spark):
    rows = [("  a \t b c",), ("\x0b\fx\ty\n",), (None,), ("x#\ty",), ("\t",), ("one ",), ("x y",)]
    out = parse_edge_lines(spark.createDataFrame(rows, "value string"))
    assert sorted(map(tuple, out.collect())) == [("a", "b"), ("x", "y")]
    assert "split(" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_pagerank_keeps_no_table_that_is_not_read_again(spark, edges):
    """Of what the rounds write, the last ranks and the lists of links stay; the edge table and earlier ranks are removed."""
    from sparkmill.session import checkpoint_dir

    there = lambda: set(os.listdir(checkpoint_dir(spark).removeprefix("file:")))
    before = there()
    got = graph.pagerank(edges, 3, checkpoint_interval=1)
    names = sorted(x.partition("-")[0] for x in there() - before)
    assert names == ["links", "nodes", "ranks", "sources"]
    assert {r.node: round(r.rank, 9) for r in got.collect()} == ROUNDS[3]


def test_given_edges_stay(spark, edges):
    own = graph.prepare_edges(edges)
    graph.pagerank(own, 2, assume_distinct=True)
    assert own.count() == 6


def test_written_frees_what_was_shuffled(spark):
    import time

    from sparkmill.session import written

    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {b for b in str(blocks.getAllBlocks().mkString(" ")).split() if b.startswith("shuffle_")}
    before = shuffled()
    table = written(spark.range(1000).repartition(3, "id").groupBy("id").count(), "freed")
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before and table.count() == 1000
