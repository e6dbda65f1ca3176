"""The cut-off search of the time split and the masked similarity product, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from sparkmill.operators import ratings as rt
from sparkmill.operators import recommend as rc

SCHEMA = "user long, item long, rating double, ts long"


def plain_split(rows, n_test, n_valid, newest_first=False):
    def place(r):
        ts = r[3]
        if newest_first:
            return (ts is None, 0 if ts is None else -ts, r[0], r[1])
        return (ts is not None, 0 if ts is None else ts, r[0], r[1])

    order = sorted(rows, key=place)
    return {(r[0], r[1]): "test" if i < n_test else "valid" if i < n_test + n_valid else "train" for i, r in enumerate(order)}


def rows_of(kind, n=600):
    rng = random.Random(kind)
    times = {"spread": lambda: rng.randrange(-10 ** 12, 10 ** 12), "few": lambda: rng.choice([5, 6, 7, None]), "one": lambda: 3,
             "hot": lambda: 1_000_000 if rng.random() < 0.4 else rng.randrange(2_000_000), "ends": lambda: rng.choice([-(2 ** 62), 0, 2 ** 62])}[kind]
    return [(i % 37, i, float(i % 5), times()) for i in range(n)]


@pytest.mark.parametrize("kind", ["spread", "few", "one", "hot", "ends"])
def test_time_split_is_exact(spark, kind):
    rows = rows_of(kind)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for n_test, n_valid, newest in ((60, 60, False), (1, 0, False), (250, 250, True), (0, 10, False)):
        got = {(r["user"], r["item"]): r["split"] for r in rt.time_split(frame, n_test, n_valid, newest_first=newest).collect()}
        assert got == plain_split(rows, n_test, n_valid, newest), (n_test, n_valid, newest)


def test_time_split_beyond_the_rows(spark):
    rows = rows_of("spread", 20)
    frame = spark.createDataFrame(rows, SCHEMA)
    for sizes in ((0, 0), (20, 0), (50, 5), (5, 15), (5, 500), (0, 20)):
        got = {(r["user"], r["item"]): r["split"] for r in rt.time_split(frame, *sizes).collect()}
        assert got == plain_split(rows, *sizes), sizes
    out = rt.time_split(frame.limit(0))
    assert out.collect() == [] and out.columns == ["user", "item", "rating", "ts", "split"]
    got = rt.split_counts(rt.time_split(frame, frac_test=0.1, frac_valid=0.25)).collect()
    assert {r["split"]: r["n"] for r in got} == {"test": 2, "valid": 5, "train": 13}


def test_only_boundary_rows_are_sorted(spark):
    rows = rows_of("spread", 400)
    out = rt.time_split(spark.createDataFrame(rows, SCHEMA), 40, 40)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan and "RepartitionByExpression" not in plan


def ratings_of(seed, users=40, items=30, n=500):
    rng = random.Random(seed)
    return [(u, i, float(rng.randrange(0, 6)), 0) for u, i in {(rng.randrange(users), rng.randrange(items)) for _ in range(n)}] + [(99, i, 3.0, 0) for i in range(items)]


@pytest.mark.parametrize("key,over", [("item", "user"), ("user", "item")])
@pytest.mark.parametrize("block", [2000, 3])
def test_masked_pairs_equal_the_full_table(spark, key, over, block):
    frame = spark.createDataFrame(ratings_of(4), SCHEMA)
    full = {(r[0], r[1]): r["sim"] for r in rc.cosine_similarity(frame, key, over).collect()}
    rng = random.Random(8)
    mask = rng.sample(sorted(full), 60) + [(1000, 1001), (0, 5000)]
    table = spark.createDataFrame(mask + mask[:20], f"{key}_1 long, {key}_2 long")
    for way in ("groups", "mask", None):
        rows = rc.masked_similarity(frame, table, key, over, block, way).collect()
        got = {(r[0], r[1]): r["sim"] for r in rows}
        assert len(rows) == len(got) and set(got) == set(mask) & set(full)
        assert all(abs(got[p] - full[p]) < 1e-12 for p in got)


def test_rows_formed(spark):
    data = ratings_of(4)
    frame = spark.createDataFrame(data, SCHEMA)
    mask = spark.createDataFrame([(1, 2), (1, 2), (3, 7)], "item_1 long, item_2 long")
    formed = rc.rows_formed(frame, mask, "item", "user")
    own = [sum(r[0] == u for r in data) for u in {r[0] for r in data}]
    assert formed["groups"] == sum(n * (n - 1) // 2 for n in own) and abs(formed["mask"] - 3 * len(data) / 30) < 0.2 * len(data) / 10
    assert rc._cheaper_way(frame, mask, "item", "user") == "mask"


def test_predictions_need_no_other_pair(spark, monkeypatch):
    frame = spark.createDataFrame(ratings_of(5), SCHEMA)
    wanted = spark.createDataFrame([(1, 2), (3, 4), (99, 7)], "user long, item long")
    seen = []
    real = rc.masked_similarity
    monkeypatch.setattr(rc, "masked_similarity", lambda *a, **k: seen.append((a[1], real(*a, **k))) or seen[-1][1])
    for predict, key in ((rc.item_based_predict, "item"), (rc.user_based_predict, "user")):
        got = {(r["user"], r["item"]): r["prediction"] for r in predict(frame, wanted).collect()}
        full = {(r["user"], r["item"]): r["prediction"] for r in predict(frame, wanted, rc.cosine_similarity(frame, key, "user" if key == "item" else "item")).collect()}
        assert got.keys() == full.keys() and all(abs(got[k] - full[k]) < 1e-9 for k in got) and got
        mask, sims = seen.pop()
        pairs = {(r[0], r[1]) for r in mask.select(f"{key}_1", f"{key}_2").collect()}
        assert {(r[0], r[1]) for r in sims.collect()} <= pairs
        assert sims.join(mask, [f"{key}_1", f"{key}_2"], "left_anti").isEmpty()


def test_zero_norms(spark):
    frame = spark.createDataFrame([(1, 1, 0.0, 0), (1, 2, 3.0, 0), (2, 1, 0.0, 0)], SCHEMA)
    mask = spark.createDataFrame([(1, 2)], "item_1 long, item_2 long")
    assert [r["sim"] for r in rc.masked_similarity(frame, mask).select(F.col("sim")).collect()] == [0.0]
