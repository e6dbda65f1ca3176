"""Property checks on generated inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sparkmill.operators import graph, itemsets, recommend as rc, text

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

ratings_st = st.dictionaries(st.tuples(st.integers(0, 5), st.integers(0, 8)), st.integers(1, 5),
                             min_size=1, max_size=30)


@SETTINGS
@given(ratings_st, st.sampled_from([1, 3, 2000]))
def test_cosine_in_unit_interval_and_block_invariant(spark, data, block):
    df = spark.createDataFrame([(u, i, float(r)) for (u, i), r in data.items()],
                               "user long, item long, rating double")
    sims = {(r.item_1, r.item_2): (r.sim, r.n_common) for r in rc.cosine_similarity(df, "item", "user", block).collect()}
    ref = {(r.item_1, r.item_2): (r.sim, r.n_common) for r in rc.cosine_similarity(df, "item", "user", 10**6).collect()}
    assert sims.keys() == ref.keys()
    for k, (s, n) in sims.items():
        assert -1e-12 <= s <= 1 + 1e-12 and n == ref[k][1] and abs(s - ref[k][0]) < 1e-12


docs_st = st.lists(st.sets(st.sampled_from(list("abcdef")), min_size=0, max_size=6), min_size=1, max_size=12)


@SETTINGS
@given(docs_st, st.integers(0, 3))
def test_support_anti_monotone_and_complete(spark, docs, t):
    rows = [(d, w) for d, ws in enumerate(docs) for w in sorted(ws)]
    if not rows:
        return
    dw = spark.createDataFrame(rows, "doc long, word string")
    res = itemsets.mine(dw, t, block_size=2)
    sets = [set(ws) for ws in docs]

    def brute(k):
        from itertools import combinations

        out = {}
        for combo in combinations("abcdef", k):
            n = sum(1 for s in sets if set(combo) <= s)
            if n > t:
                out[combo] = n
        return out

    pairs = {(r.w1, r.w2): r.support for r in res.pairs.collect()}
    triples = {(r.w1, r.w2, r.w3): r.support for r in res.triples.collect()}
    quads = {(r.w1, r.w2, r.w3, r.w4): r.support for r in res.quads.collect()}
    assert pairs == brute(2) and triples == brute(3) and quads == brute(4)
    for (a, b, c), n in triples.items():
        assert n <= min(pairs[(a, b)], pairs[(a, c)], pairs[(b, c)])


@SETTINGS
@given(st.lists(st.integers(1, 9), min_size=1, max_size=25), st.integers(1, 8))
def test_top_k_with_ties_contains_top_k(spark, values, k):
    counts = spark.createDataFrame([(f"w{i:02d}", v) for i, v in enumerate(values)], "word string, n long")
    ties = {r.word for r in text.top_words_with_ties(counts, k).collect()}
    top = {r.word for r in text.top_words(counts, k).collect()}
    assert top <= ties and len(ties) >= min(k, len(values))


@SETTINGS
@given(st.sets(st.tuples(st.sampled_from("ABCDEF"), st.sampled_from("ABCDEF")), min_size=1, max_size=15))
def test_pagerank_support_shrinks(spark, edges):
    edges = [(a, b) for a, b in edges if a != b]
    if not edges:
        return
    df = spark.createDataFrame(edges, "src string, dst string")
    prev = None
    for n in (1, 2, 3):
        nodes = {r.node for r in graph.pagerank(df, n, block=1).collect()}
        if prev is not None:
            assert nodes <= prev
        prev = nodes


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50), st.integers(0, 50)), min_size=0, max_size=60,
                unique=True),
       st.integers(1, 7))
def test_global_row_number_is_a_dense_sorted_numbering(spark, rows, parts):
    from sparkmill.operators.ordering import global_row_number

    df = spark.createDataFrame(rows, "ts long, user long, item long")
    out = global_row_number(df, ["ts", "user", "item"], "rn", parts, total_name="total").collect()
    got = sorted((r.rn, r.ts, r.user, r.item) for r in out)
    assert got == [(i + 1, *t) for i, t in enumerate(sorted(rows))]
    assert all(r.total == len(rows) for r in out)
