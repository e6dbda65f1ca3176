import math
import random

import pytest
from pyspark.sql import functions as F

from sparkmill.llm import topk


def brute(rows, k, every):
    vectors = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
               if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (qid, q) in enumerate(vectors):
        if qid % every == 0:
            scores = [(-sum(x * y for x, y in zip(q, v)), vid) for b, (vid, v) in enumerate(vectors) if a != b]
            out += [(qid, r + 1, vid, -s) for r, (s, vid) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("bins,block,k", [(256, 4096, 20), (4, 3, 5), (16, 1, 1)])
def test_matches_brute_force(spark, monkeypatch, bins, block, k):
    rng = random.Random(bins)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(60)]
    rows += [(100 + i, [0.5] * 6) for i in range(40)]  # ties
    rows += [(200, None), (201, [1.0, None]), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (None, [1.0] * 6), (204, []), (205, [2.0, 2.0]),
             (5, [0.1] * 9), (5, rows[5][1]), (10, rows[10][1]), (10, rows[10][1]), (206, [-0.0] * 6)]
    rng.shuffle(rows)
    monkeypatch.setattr(topk, "BINS", bins)
    frame = spark.createDataFrame([(v, i, 7, 8) for i, v in rows], "embedding array<double>, vec_id long, uid int, score int").repartition(3)
    got = topk.top_k(topk.quantised(frame), F.col("vec_id") % 5 == 0, k, query_block=block)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, k, 5)


def test_empty_and_few(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(topk.quantised(none), F.col("vec_id") % 5 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0]), (3, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(topk.quantised(one), F.col("vec_id") % 5 == 0).collect()] == [(0, 1, 3, 64 * 128)]


def test_huge_components_stay_exact(spark):
    rows = [(0, [3e7, 1.0]), (1, [3e7, -1.0]), (2, [3e7, 1.5])]
    got = topk.top_k(topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), F.col("vec_id") == 0, 2)
    assert [(r["vec_id"], r["score"]) for r in got.orderBy("rank").collect()] == [(2, (64 * 3 * 10 ** 7) ** 2 + 64 * 96), (1, (64 * 3 * 10 ** 7) ** 2 - 64 * 64)]
