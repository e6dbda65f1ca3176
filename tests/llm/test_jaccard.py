import random

import numpy as np
import pandas as pd
import pytest

from sparkmill.llm import jaccard
from tests.llm.helpers import docs, words


def shingles(text, k):
    w = words(text, lower=True)
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def corpus(rng, groups, length):
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice(length))]
        for _ in range(rng.randrange(1, 7)):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + len(w) // 40 + rng.randrange(3))):
                w[rng.randrange(len(w))] = f"e{rng.randrange(9000)}"
            rows.append((len(rows), " ".join(x.upper() if rng.random() < .1 else x for x in w)))
    return rows


@pytest.mark.parametrize("percent,k,length,block", [(85, 4, (5, 9, 30, 60), 2048), (80, 5, (200, 40), 2048), (85, 4, (120,), 4), (60, 2, (8, 12, 3), 4)])
def test_matches_brute_force(spark, monkeypatch, percent, k, length, block):
    rng = random.Random(percent + k + block)
    rows = corpus(rng, 25, length)
    line = " ".join(f"common{i}" for i in range(12))
    rows = [(i, t + " " + line if i % 3 == 0 else t) for i, t in rows]
    rows += [(900, None), (901, ""), (902, "one"), (903, "ONE"), (904, "two words"), (905, rows[3][1]), (None, rows[3][1]), (906, rows[3][1]), (906, rows[3][1]), (None, "alone here")]
    monkeypatch.setattr(jaccard, "BLOCK", block)
    got = jaccard.link(docs(spark, rows).repartition(3), k, percent)
    assert sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()], key=str) == brute(rows, k, percent)


def test_hot_group_of_near_copies(spark, monkeypatch):
    """Every text differs; most link only through others; blocks are far smaller than the group."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randrange(1, 4)):
            w[rng.randrange(150)] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    got = jaccard.link(docs(spark, rows).repartition(4))
    assert sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()], key=str) == brute(rows, 4, 85)


def test_keep_one(spark):
    near = [f"w{i}" for i in range(200)]
    other = near[:100] + ["changed"] + near[101:]
    rows = [(5, " ".join(near)), (3, " ".join(other)), (3, " ".join(other)), (8, "something else entirely in here"), (9, None), (9, None), (10, "")]
    got = jaccard.keep_one(docs(spark, rows), 5, 80)
    assert got.columns == docs(spark, []).columns
    assert sorted([r["doc_id"] for r in got.collect()]) == [3, 8, 9, 9, 10]
    assert jaccard.keep_one(docs(spark, [])).count() == 0


def test_boundary_follows_cost():
    small = pd.DataFrame({"n": [5, 20], "sets": [1000, 1000]})
    assert jaccard.choose_boundary(small, 0.9, 85) == 20
    large = pd.DataFrame({"n": [400, 900], "sets": [1000, 1000]})
    assert jaccard.choose_boundary(large, 0.0, 85) == 0


def test_maps_bound_differences():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 2 ** 63, 300).astype(np.uint64))
    b = np.concatenate([a[:250], np.unique(rng.integers(0, 2 ** 63, 20).astype(np.uint64))])
    maps = jaccard._maps(np.array([len(a), len(b)]), np.concatenate([a, b])).view(np.uint64)
    bound = int(np.bitwise_count(maps[0] ^ maps[1]).sum())
    assert 0 < bound <= len(set(a.tolist()) ^ set(b.tolist()))


def test_shared_lists_over_batches(monkeypatch):
    """Rows of a key that fit in size, once each, with their block, however Arrow cuts the batches."""
    import pyarrow as pa

    monkeypatch.setattr(jaccard, "BLOCK", 2)
    rng = np.random.default_rng(3)
    for _ in range(200):
        rows = sorted({(int(k), int(n), int(n) * 10 + int(x)) for k, n, x in zip(rng.integers(0, 4, 25), rng.choice([10, 11, 30, 31, 90], 25), rng.integers(0, 3, 25))})
        rows = sorted(rows + rows[::3])
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["key", "n", "name"]).select(["key", "name", "n"])
        cuts = sorted(set(rng.integers(0, len(rows) + 1, 5).tolist()) | {0, len(rows)})
        got = [r for b in jaccard._shared(85)(iter([batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:])])) for r in b.to_pylist()]
        expected = []
        for k in {r[0] for r in rows}:
            own = sorted({(n, x) for kk, n, x in rows if kk == k})
            for i, (n, x) in enumerate(own):
                if any(j != i and 100 * min(n, m) >= 85 * max(n, m) for j, (m, _) in enumerate(own)):
                    expected.append((k, x, n, i // 2))
        assert sorted((r["key"], r["name"], r["n"], r["block"]) for r in got) == sorted(expected)


@pytest.mark.parametrize("percent,boundary", [(50, 1000), (30, 1000), (30, 2), (50, 0)])
def test_low_percent_matches_brute_force(spark, monkeypatch, percent, boundary):
    rng = random.Random(percent)
    rows = [(i, " ".join(f"g{i % 30}x{rng.randrange(4)}" for _ in range(rng.randrange(1, 9)))) for i in range(90)]
    rows += [(100, "p"), (101, "p q"), (102, "q r s"), (103, "t u"), (104, "u v"), (105, "t u v w x y z"), (106, None), (107, "")]
    monkeypatch.setattr(jaccard, "choose_boundary", lambda *_: boundary)
    got = jaccard.link(docs(spark, rows).repartition(3), 1, percent)
    assert sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()], key=str) == brute(rows, 1, percent)


def test_percent_out_of_range_is_refused(spark):
    for percent in (0, 101):
        with pytest.raises(ValueError):
            jaccard.link(docs(spark, []), 4, percent)
