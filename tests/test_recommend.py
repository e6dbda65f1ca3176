import math
import random

import pytest

from sparkmill.operators import ratings as rt
from sparkmill.operators import recommend as rc

TRAIN = [(1, 10, 4.0), (1, 20, 2.0), (2, 10, 5.0), (2, 30, 3.0), (3, 20, 1.0), (3, 30, 2.0), (3, 10, 3.0)]
TEST = [(2, 20, 2.0), (1, 30, 3.0), (9, 10, 4.0), (1, 99, 3.0)]


@pytest.fixture()
def train(spark):
    return spark.createDataFrame(TRAIN, "user long, item long, rating double")


@pytest.fixture()
def test(spark):
    return spark.createDataFrame(TEST, "user long, item long, rating double")


def close(a, b, tol=1e-8):
    return a is not None and abs(a - b) < tol


def test_means_and_baseline(spark, train, test):
    assert close(train.select(rt.global_mean(train)).first()[0], 2.857142857)
    um = {r.user: r.user_mean for r in rt.user_means(train).collect()}
    assert um == {1: 3.0, 2: 4.0, 3: 2.0}
    im = {r.item: r.item_mean for r in rt.item_means(train).collect()}
    assert im == {10: 4.0, 20: 1.5, 30: 2.5}
    pred = {(r.user, r.item): r.prediction for r in rt.baseline_predict(train, test).collect()}
    expect = {(2, 20): 2.642857143, (1, 30): 2.642857143, (9, 10): 4.0, (1, 99): 3.0}
    assert all(close(pred[k], v) for k, v in expect.items())
    r = rt.rmse(rt.baseline_predict(train, test), test).first()
    assert close(r.rmse, 0.367701076) and r.n == 4


@pytest.mark.parametrize("block", [2000, 1])
def test_item_cosine(spark, train, block):
    sims = {(r.item_1, r.item_2): r.sim for r in rc.cosine_similarity(train, "item", "user", block).collect()}
    assert set(sims) == {(10, 20), (10, 30), (20, 30)}
    assert close(sims[(10, 20)], 0.695701085) and close(sims[(10, 30)], 0.823687768)
    assert close(sims[(20, 30)], 0.248069469)


@pytest.mark.parametrize("block", [2000, 1])
def test_user_cosine(spark, train, block):
    sims = {(r.user_1, r.user_2): r.sim for r in rc.cosine_similarity(train, "user", "item", block).collect()}
    assert close(sims[(1, 2)], 0.766964989) and close(sims[(1, 3)], 0.836660027)
    assert close(sims[(2, 3)], 0.962533422)


def test_cf_predictions(spark, train, test):
    isims = rc.cosine_similarity(train, "item", "user")
    ip = {(r.user, r.item): r.prediction for r in rc.item_based_predict(train, test, isims).collect()}
    assert set(ip) == {(2, 20), (1, 30)}
    assert close(ip[(2, 20)], 4.474301316) and close(ip[(1, 30)], 3.537078994)
    usims = rc.cosine_similarity(train, "user", "item")
    up = {(r.user, r.item): r.prediction for r in rc.user_based_predict(train, test, usims).collect()}
    assert set(up) == {(2, 20), (1, 30)}
    assert close(up[(2, 20)], 1.443460939) and close(up[(1, 30)], 2.478269534)


def test_rmse_empty_is_null(spark, train):
    empty = spark.createDataFrame([], "user long, item long, prediction double")
    r = rt.rmse(empty, train).first()
    assert r.rmse is None and r.n == 0


def test_rmse_of_self_is_zero(spark, train):
    r = rt.rmse(train.withColumnRenamed("rating", "prediction"), train).first()
    assert r.rmse == 0.0 and r.n == len(TRAIN)


def test_nearest_neighbors(spark, train):
    sims = rc.cosine_similarity(train, "item", "user")
    nn = rc.nearest_neighbors(sims, 1).collect()
    best = {r.item: r.other for r in nn}
    assert best == {10: 30, 20: 10, 30: 10}


def test_salted_pairs_match_plain_pairs(spark):
    import random

    rnd = random.Random(3)
    rows = {(u, i): float(rnd.randint(1, 5)) for u in range(6) for i in range(rnd.randint(1, 25))}
    df = spark.createDataFrame([(u, i, r) for (u, i), r in rows.items()], "user long, item long, rating double")
    plain = sorted(map(tuple, rc.cosine_similarity(df, "item", "user", 10_000).collect()))
    salted = sorted(map(tuple, rc.cosine_similarity(df, "item", "user", 3).collect()))
    assert len(plain) == len(salted)
    for a, b in zip(plain, salted):
        assert a[:2] == b[:2] and a[3] == b[3] and math.isclose(a[4], b[4], rel_tol=1e-12)


def test_als_unknown_ids_dropped(spark, train, test):
    model = rc.als_fit(train, rank=2, max_iter=3)
    got = {(r.user, r.item) for r in rc.als_predict(model, test).collect()}
    assert (9, 10) not in got and (1, 99) not in got
    assert (2, 20) in got


@pytest.mark.parametrize("block", [1, 2])
def test_cf_predictions_salted(spark, train, test, block):
    isims = rc.cosine_similarity(train, "item", "user", block)
    ip = {(r.user, r.item): r.prediction for r in rc.item_based_predict(train, test, isims, block).collect()}
    assert close(ip[(2, 20)], 4.474301316) and close(ip[(1, 30)], 3.537078994) and len(ip) == 2
    usims = rc.cosine_similarity(train, "user", "item", block)
    up = {(r.user, r.item): r.prediction for r in rc.user_based_predict(train, test, usims, block).collect()}
    assert close(up[(2, 20)], 1.443460939) and close(up[(1, 30)], 2.478269534) and len(up) == 2


def test_salted_join_equals_join(spark):
    from sparkmill.operators.skew import salted_join

    left = spark.createDataFrame([(k, i) for k in range(3) for i in range(k * 7 + 1)], "k long, i long")
    right = spark.createDataFrame([(k, j) for k in range(4) for j in range(3)], "k long, j long")
    plain = sorted(map(tuple, left.join(right, "k").select("k", "i", "j").collect()))
    salted = sorted(map(tuple, salted_join(left, right, ["k"], "i", 2).select("k", "i", "j").collect()))
    assert plain == salted


def test_method_comparison_shape(spark, train, test):
    valid = spark.createDataFrame([(3, 10, 3.0), (2, 30, 3.0)], "user long, item long, rating double")
    out = rc.method_comparison(train, valid, test, ranks=(2,)).collect()
    keys = {(r.method, r.split) for r in out}
    assert keys == {(m, s) for m in ("als", "baseline", "item_cf", "user_cf") for s in ("valid", "test")}
    base = {r.split: r for r in out if r.method == "baseline"}
    assert close(base["test"].rmse, 0.367701076) and base["test"].n == 4


def test_als_factors_solve_their_normal_equations(spark):
    """After a fit each user's factors minimise that user's regularised squared error given the item factors:
    (Q'Q + reg n I) p = Q'r, which any engine can recompute from the factors alone."""
    import random

    import numpy as np

    rng = random.Random(3)
    rows = [(u, i, float(rng.randrange(1, 6))) for u in range(40) for i in rng.sample(range(25), 9)]
    train = spark.createDataFrame(rows, "user long, item long, rating double")
    reg = 0.1
    model = rc.als_fit(train, rank=4, max_iter=6, reg=reg)
    p, q = ({r["id"]: np.array(r["features"], dtype=float) for r in f.collect()} for f in (model.userFactors, model.itemFactors))
    assert set(p) == set(range(40)) and all(len(v) == 4 for v in [*p.values(), *q.values()])
    for u, own in p.items():
        rated = [(i, r) for v, i, r in rows if v == u]
        m = np.array([q[i] for i, _ in rated])
        left = (m.T @ m + reg * len(rated) * np.eye(4)) @ own
        right = m.T @ np.array([r for _, r in rated])
        assert np.abs(left - right).max() <= 1e-3 * max(1.0, np.abs(right).max())
    got = {(r.user, r.item): r.prediction for r in rc.als_predict(model, train).collect()}
    assert all(abs(got[u, i] - p[u] @ q[i]) < 1e-4 for u, i, _ in rows) and len(got) == len(rows)
    table, best = rc.als_rank_search(train, train, (2, 4), max_iter=4)
    errors = {r["rank"]: r["valid_rmse"] for r in table.collect()}
    mean = np.mean([r for *_, r in rows])
    flat = float(np.sqrt(np.mean([(r - mean) ** 2 for *_, r in rows])))
    assert all(0 < e < flat for e in errors.values()) and errors[best] == min(errors.values())


def test_sampled_similarity_of_large_vectors(spark):
    """Keys of many ratings are sampled, small ones kept whole; similar pairs are found with a small error."""
    rng = random.Random(4)
    rows = [(u, i, float(rng.randrange(1, 6))) for i in range(12) for u in range(4000) if rng.random() < 0.6]
    rows += [(u, 100 + k, 5.0) for k in range(2) for u in range(6)]  # norm 12.2, below 5 * 9.4
    ratings = spark.createDataFrame(rows, "user long, item long, rating double")
    kept = rc._sampled_ratings(ratings, 0.3, "item", "user", 7, 10.0)
    assert 0 < kept.filter("item < 100").count() < 0.4 * len(rows) and kept.filter("item >= 100").count() == 12
    exact = {(r.item_1, r.item_2): r.sim for r in rc.cosine_similarity(ratings).filter("sim >= 0.3").collect()}
    got = {(r.item_1, r.item_2): r.sim for r in rc.sampled_similarity(ratings, 0.3).collect()}
    assert len(exact) == 12 * 11 // 2 + 1 and close(got[(100, 101)], 1.0)
    assert len(exact.keys() & got.keys()) >= 0.9 * len(exact)
    assert sum(abs(got[k] - exact[k]) / exact[k] for k in exact.keys() & got.keys()) / len(exact) <= 0.2
    again = {(r.item_1, r.item_2): r.sim for r in rc.sampled_similarity(ratings.repartition(7), 0.3).collect()}
    assert again.keys() == got.keys() and all(close(again[k], got[k]) for k in got)


def test_sampled_similarity_keeps_small_vectors_whole(spark, train):
    exact = {(r.item_1, r.item_2): r.sim for r in rc.cosine_similarity(train).collect()}
    got = {(r.item_1, r.item_2): r.sim for r in rc.sampled_similarity(train, 0.01).collect()}
    assert got.keys() == exact.keys() and all(close(got[k], exact[k]) for k in exact)
    assert rc.sampled_similarity(train.limit(0), 0.1).count() == 0
    with pytest.raises(ValueError):
        rc.sampled_similarity(train, 0.0)


def test_ranks_fitted_at_once_or_in_turn(spark, train):
    one, best = rc.als_rank_search(train, train, (2, 3, 4), max_iter=3, at_once=1)
    three, same = rc.als_rank_search(train, train, (2, 3, 4), max_iter=3, at_once=3)
    assert best == same and [r["rank"] for r in three.collect()] == [2, 3, 4]
    for x, y in zip(one.collect(), three.collect()):
        assert close(x.train_rmse, y.train_rmse, 1e-4) and x.is_best == y.is_best


def _same_neighbors(got, want, key):
    rows = [{(r[key], r["rank"]): (r["other"], r["sim"]) for r in df.collect()} for df in (got, want)]
    assert rows[0].keys() == rows[1].keys()
    for k, (other, sim) in rows[1].items():
        assert rows[0][k][0] == other and close(rows[0][k][1], sim)


@pytest.mark.parametrize("seed,rest,block", [(1, 0.1, 2000), (2, 0.3, 7), (3, 0.0, 2000), (4, 0.9, 40)])
def test_bounded_neighbors_are_exact(spark, seed, rest, block):
    """Users from few to very many ratings, negative and zero ratings, a key without a norm, keys with few partners."""
    rng = random.Random(seed)
    low = -2 if seed == 2 else 0
    rows = {(u, rng.randrange(60)): float(rng.randrange(low, 6)) for u in range(40) for _ in range(rng.randrange(1, 50 if u < 6 else 7))}
    rows |= {(u, 900): 0.0 for u in range(5)} | {(77, 901): 3.0, (78, 902): 4.0, (78, 903): 1.0}
    ratings = spark.createDataFrame([(u, i, r) for (u, i), r in rows.items()], "user long, item long, rating double")
    for key, over in (("item", "user"), ("user", "item")):
        want = rc.nearest_neighbors(rc.cosine_similarity(ratings, key, over), 4, key)
        _same_neighbors(rc.bounded_neighbors(ratings, 4, key, over, rest=rest, block_size=block), want, key)


def test_bounded_neighbors_form_fewer_pairs(spark):
    """One user rated every item: nearly all co-rated pairs are that user's, and next to none of them are formed."""
    rng = random.Random(5)
    rows = [(0, i, 3.0) for i in range(300)]
    rows += [(1 + 3 * (i // 10) + j, i, float(rng.randrange(2, 6))) for i in range(300) for j in range(3)]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double")
    sims = rc.cosine_similarity(ratings)
    unit = rc._head_and_rest(rc._unit(ratings, "item", "user"), "item", "user", 0.4)
    assert rc._formed_products(unit, "item", "user", 2000).count() < sims.agg({"n_common": "sum"}).first()[0] / 4
    _same_neighbors(rc.bounded_neighbors(ratings, 5, rest=0.4), rc.nearest_neighbors(sims, 5), "item")


def test_bounded_neighbors_of_nothing(spark, train):
    assert rc.bounded_neighbors(train.limit(0)).count() == 0
    with pytest.raises(ValueError):
        rc.bounded_neighbors(train, rest=1.0)


@pytest.mark.parametrize("seed,rest,block", [(1, 0.1, 2000), (2, 0.3, 7), (3, 0.0, 2000), (4, 0.9, 40), (5, 0.6, 9)])
def test_bounded_neighbors_with_any_cut_are_exact(spark, seed, rest, block):
    """The rests are kept however little they save; items of many pairs, negative ratings, open keys."""
    rng = random.Random(seed)
    low = -4 if seed in (2, 5) else 0
    rows = {(u, rng.randrange(60)): float(rng.randrange(low, 6)) for u in range(40) for _ in range(rng.randrange(1, 50 if u < 6 else 7))}
    ratings = spark.createDataFrame([(u, i, r) for (u, i), r in rows.items()], "user long, item long, rating double")
    for key, over in (("item", "user"), ("user", "item")):
        want = rc.nearest_neighbors(rc.cosine_similarity(ratings, key, over), 4, key)
        _same_neighbors(rc.bounded_neighbors(ratings, 4, key, over, rest=rest, block_size=block, least_saved=0.0), want, key)


def test_bounded_neighbors_write_candidates_only(spark):
    """Groups alike in size: no cut pays, the bounds are the similarities, and only what may enter a list is written."""
    rng = random.Random(8)
    rows = {(u, rng.randrange(120)): float(rng.randrange(1, 6)) for u in range(120) for _ in range(20)}
    ratings = spark.createDataFrame([(u, i, r) for (u, i), r in rows.items()], "user long, item long, rating double")
    unit = rc._head_and_rest(rc._unit(ratings, "item", "user"), "item", "user", 0.1).cache()
    assert rc._share_saved(unit, "user") < 0.5
    unit = unit.withColumn("_rest", rc.F.lit(False))
    none = unit.filter("_rest").selectExpr("item", "_w _s", "_rest _signed").checkpoint()
    cand = rc._candidates(unit, none, 3, "item", "user", 2000, 2e-9)
    pairs = 2 * rc.cosine_similarity(ratings).count()
    assert 120 * 3 <= cand.count() < pairs / 10
    _same_neighbors(rc.bounded_neighbors(ratings, 3), rc.nearest_neighbors(rc.cosine_similarity(ratings), 3), "item")


def test_sums_across_split_an_item_of_many_pairs(spark):
    rows = [(g, i, float(1 + (g * i) % 5)) for g in range(6) for i in range(40) if (g + i) % 4 or i == 0]
    df = spark.createDataFrame(rows, "g long, i long, w double")
    total = rc.F.sum(rc.F.col("w_1") * rc.F.col("w_2")).alias("p")
    got = rc.sums_across([(df, df.filter("i < 30")), (df.filter("i < 30"), df.filter("i >= 30"))], "g", "i", ["w"], [total], block_size=7, pairs_per_task=50)
    want = {}
    for g, i, w in rows:
        for h, j, v in rows:
            if g == h and i != j and (j < 30 or i < 30):
                want[i, j] = want.get((i, j), 0.0) + w * v
    assert {(r.i_1, r.i_2): r.p for r in got.collect()} == want
    assert got.select("_s").distinct().count() > 1


def test_bounded_neighbors_with_a_rest_of_zeros(spark):
    """User 1's rest has no weight: a pair of negative products must not come back with what the rests add, which is 0."""
    rows = [(1, 2, 4.0), (1, 6, 0.0), (2, 2, -1.0), (2, 6, 5.0), (2, 7, 5.0)] + [(u, 6, 2.0) for u in range(3, 9)] + [(u, 20 + u, 1.0) for u in range(3, 9)]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double")
    want = rc.nearest_neighbors(rc.cosine_similarity(ratings, "user", "item"), 2, "user")
    for rest in (0.4, 0.6, 0.9):
        _same_neighbors(rc.bounded_neighbors(ratings, 2, "user", "item", rest=rest, least_saved=0.0), want, "user")


@pytest.mark.parametrize("low", [0, 0.5])
def test_waves_give_the_same(spark, low):
    """Few pairs at a time: written wave by wave, the same rows; whole ratings are sent as bytes, others as they are."""
    rng = random.Random(11)
    rows = {(u, 10**10 * (i % 2) + i): low + rng.randrange(1, 6) for u in range(30) for i in rng.sample(range(40), 9)}
    ratings = spark.createDataFrame([(u, i, float(r)) for (u, i), r in rows.items()], "user long, item long, rating double")
    for key, over in (("item", "user"), ("user", "item")):
        _same_neighbors(rc.cosine_neighbors(ratings, 3, key, over, pairs_per_wave=300), rc.nearest_neighbors(rc.cosine_similarity(ratings, key, over), 3, key), key)
        got = rc.cosine_similarity(ratings, key, over, then=lambda s: s.filter("sim >= 0.3"), pairs_per_wave=300)
        assert len(got.inputFiles()) > 1  # written
        want = {tuple(r)[:2]: r.sim for r in rc.cosine_similarity(ratings, key, over).filter("sim >= 0.3").collect()}
        got = {tuple(r)[:2]: r.sim for r in got.collect()}
        assert got.keys() == want.keys() and all(close(got[k], want[k]) for k in want)
        sampled = [{tuple(r)[:2]: r.sim for r in rc.sampled_similarity(ratings, 0.3, key, over, pairs_per_wave=n).collect()} for n in (300, 10**9)]
        assert sampled[0].keys() == sampled[1].keys() and all(close(sampled[0][k], v) for k, v in sampled[1].items())


def test_masked_similarity_in_waves_and_blocks(spark):
    """Items asked for that no rating holds, repeated rows of the mask, few pairs at a time, hot items: the pairs of the full table."""
    rng = random.Random(12)
    rows = {(u, i): float(rng.randrange(1, 6)) for u in range(30) for i in rng.sample(range(40), 9)}
    ratings = spark.createDataFrame([(u, i, r) for (u, i), r in rows.items()], "user long, item long, rating double")
    full = {tuple(r)[:2]: r.sim for r in rc.cosine_similarity(ratings).collect()}
    asked = [(a, b) for a in range(40) for b in range(a + 1, 40) if (a + b) % 3 == 0] + [(1, 10**12), (-10**12, 3), (0, 300)]
    mask = spark.createDataFrame(asked + asked[:50], "item_1 long, item_2 long")
    want = {k: full[k] for k in asked if k in full}
    for block, wave in ((2000, 200), (2, 200), (2, 10**9)):
        got = {tuple(r)[:2]: r.sim for r in rc.masked_similarity(ratings, mask, block_size=block, way="groups", pairs_per_wave=wave).collect()}
        assert got.keys() == want.keys() and all(close(got[k], want[k]) for k in want)


def test_predictions_in_waves(spark, monkeypatch):
    rng = random.Random(13)
    rows = [(u, i, float(rng.randrange(1, 6))) for u in range(30) for i in rng.sample(range(40), 9)]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double")
    pairs = spark.createDataFrame([(u, i) for u in range(30) for i in range(0, 40, 3)], "user long, item long")
    for predict, key in ((rc.item_based_predict, "item"), (rc.user_based_predict, "user")):
        over = "user" if key == "item" else "item"
        want = {(r.user, r.item): r.prediction for r in predict(ratings, pairs, rc.cosine_similarity(ratings, key, over)).collect()}
        for most in (500, 10**9):
            monkeypatch.setattr(rc, "CANDIDATES_PER_WAVE", most)
            got = {(r.user, r.item): r.prediction for r in predict(ratings, pairs).collect()}
            assert got.keys() == want.keys() and all(close(got[k], want[k]) for k in want)


def test_als_blocks_grow_with_the_ratings(spark, monkeypatch):
    """A block holds a bounded number of ratings, and the model hangs on written factors, not on the blocks of the fit."""
    from pyspark.ml import recommendation

    seen, fit = [], recommendation.ALS.fit
    monkeypatch.setattr(recommendation.ALS, "fit", lambda self, data: seen.append(self.getNumUserBlocks()) or fit(self, data))
    monkeypatch.setattr(rc, "RATINGS_PER_BLOCK", 10)
    train = spark.createDataFrame([(u, i, float(1 + (u * i) % 5)) for u in range(20) for i in range(10)], "user long, item long, rating double")
    model = rc.als_fit(train, rank=2, max_iter=2)
    assert seen == [20] and model.userFactors.inputFiles() and rc.als_predict(model, train).count() == 200
