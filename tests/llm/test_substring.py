import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from sparkmill.llm import substring
from tests.llm.helpers import docs, words


def brute(rows, window):
    seen = {}
    split = [words(t) for _, t in rows]
    for w in split:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            seen[k] = seen.get(k, 0) + 1
    out = []
    for (doc_id, _), w in zip(rows, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def test_levels():
    assert substring.levels(35) == [9, 18, 35]
    assert substring.levels(8) == [8]
    assert substring.levels(100) == [13, 25, 50, 100]


@pytest.mark.parametrize("window,partitions", [(35, 3), (20, 1)])
def test_matches_brute_force(spark, window, partitions):
    rng = random.Random(window)
    vocabulary = ["a", "bé", "C", "dd", "ee f", "g"]
    text = lambda n: " ".join(rng.choice(vocabulary) + str(rng.randrange(40)) for _ in range(n))
    shared = [text(60) for _ in range(4)]
    rows = [(i, "\t".join(rng.choice([text(rng.randrange(1, 50)), rng.choice(shared), " ".join(rng.choice(shared).split()[5:45])]) for _ in range(3)))
            for i in range(40)]
    rows += [(90, None), (91, ""), (92, " \n "), (93, "x " * 200), (None, shared[0]), (94, rows[0][1]), (94, rows[0][1]), (95, text(9000) + " " + shared[1])]
    got = substring.drop_repeated_passages(docs(spark, rows).repartition(partitions), window)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(rows, window)))


def test_empty_table(spark):
    assert substring.drop_repeated_passages(docs(spark, [])).count() == 0


def test_runs_over_batches():
    """A key's count goes on over Arrow batches wherever they are cut."""
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 30))
        key = np.sort(rng.integers(0, 8, n))
        times = rng.choice([0, 1, 1, 1, 2], n).astype(np.int32)
        batch = pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.arange(n)), pa.array(np.arange(n)), pa.array(np.arange(n, dtype=np.int32)),
                                            pa.array(np.ones(n, np.int32)), pa.array(times)], names=["key", "doc_id", "text_hash", "pos", "length", "n"])
        cuts = sorted(set(rng.integers(0, n + 1, 4).tolist()) | {0, n})
        parts = [batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]
        got = sorted(x for b in substring._repeated(iter(parts)) for x in b.column("doc_id").to_pylist())
        sums = {k: times[key == k].sum() for k in set(key.tolist())}
        assert got == [i for i in range(n) if times[i] == 0 or (times[i] == 1 and sums[key[i]] >= 2)]
