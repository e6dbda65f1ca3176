"""Recommenders: norms, cosine similarities, neighbourhood CF, ALS
(R1-R11, K9, A12-A14, J3, J5, J6, J8, F20)."""

from __future__ import annotations

import gc
import math
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmill.functions.metrics import cosine
from sparkmill.operators.ordering import top_n_per_group
from sparkmill.operators.ratings import baseline_predict, rmse_by_split
from sparkmill.operators.skew import DEFAULT_BLOCK_SIZE, PAIRS_PER_WAVE, balanced_join, pairs_within_groups, salted_join, sums_across, sums_of_pairs
from sparkmill.session import checkpoint_dir, discard, written


def norms(ratings: DataFrame, key: str) -> DataFrame:
    """(key, norm): L2 norm of each item's (or user's) rating vector."""
    return ratings.groupBy(key).agg(F.sqrt(F.sum(F.col("rating") * F.col("rating"))).alias("norm"))


def cosine_similarity(ratings: DataFrame, key: str = "item", over: str = "user",
                      block_size: int = DEFAULT_BLOCK_SIZE, targets: DataFrame | None = None, both: bool = False,
                      then: Callable[[DataFrame], DataFrame] | None = None, pairs_per_wave: int = PAIRS_PER_WAVE) -> DataFrame:
    """(a, b, dot, n_common, sim) for every pair of ``key`` values co-rated by
    at least one ``over`` value, a < b.  sim = dot / (norm_a * norm_b) with
    norms over all ratings of each key; 0.0 when a norm is 0.  With ``targets`` (a
    table of distinct ``key`` values) only pairs that hold one of them are summed.  With ``both`` each
    pair is there in both orientations.  ``then`` is what is kept of the similarities, row by row or per ``a``; it is written wave by wave
    (see ``sums_of_pairs``), so that the similarities need not fit on disk.

    Plan: the per-key square sum is attached to each rating first (a shuffle of the
    ratings, not of the much larger pair table; AQE splits a key with many ratings); pairs are formed and
    summed by ``sums_of_pairs`` in the task that owns ``a`` (hot groups and hot keys are split), so that only lists
    of ratings are shuffled.  The similarity is computed straight out of that
    aggregate, which is hash-partitioned on a."""
    a, b = f"{key}_1", f"{key}_2"
    per_key = ratings.groupBy(key).agg(F.sum(F.col("rating") * F.col("rating")).alias("_sq"))
    if targets is not None:
        per_key = per_key.join(targets.select(key, F.lit(True).alias("_t")), key, "left")
    rated = balanced_join(ratings.select(over, key, "rating"), per_key, [key])
    sums = [F.sum(F.col("rating_1") * F.col("rating_2")).alias("dot"), F.count(F.lit(1)).alias("n_common"),
            F.max("_sq_1").alias("_sq1"), F.max("_sq_2").alias("_sq2")]
    carry = ["rating", "_sq"] + (["_t"] if targets is not None else [])
    where = F.coalesce("_t_1", "_t_2", F.lit(False)) if targets is not None else None

    def similar(dots: DataFrame) -> DataFrame:
        return dots.select(a, b, "dot", "n_common", cosine(F.col("dot"), F.sqrt("_sq1"), F.sqrt("_sq2")).alias("sim"))

    if then is None:
        return similar(sums_of_pairs(rated, over, key, carry, sums, block_size, both, where))
    return sums_of_pairs(rated, over, key, carry, sums, block_size, both, where, then=lambda dots: then(similar(dots)), pairs_per_wave=pairs_per_wave)


def cosine_neighbors(ratings: DataFrame, n: int = 10, key: str = "item", over: str = "user", digits: int = 9,
                     block_size: int = DEFAULT_BLOCK_SIZE, pairs_per_wave: int = PAIRS_PER_WAVE) -> DataFrame:
    """``nearest_neighbors`` of ``cosine_similarity``.  Every pair is formed at both its keys, so that a key's neighbours are
    ranked in the task that owns the key and the pair table is not shuffled; the ranked ones are all that is written of a wave of keys."""
    a, b = f"{key}_1", f"{key}_2"

    def nearest(sims: DataFrame) -> DataFrame:
        return top_n_per_group(sims.select(a, b, "sim"), [a], [F.round("sim", digits).desc(), F.col(b).asc()], n)

    best = cosine_similarity(ratings, key, over, block_size, both=True, then=nearest, pairs_per_wave=pairs_per_wave)
    return best.select(F.col(a).alias(key), F.col(b).alias("other"), "sim", "rank")


def sampled_similarity(ratings: DataFrame, threshold: float, key: str = "item", over: str = "user", seed: int = 7,
                       oversampling: float = 10.0, block_size: int = DEFAULT_BLOCK_SIZE, pairs_per_wave: int = PAIRS_PER_WAVE) -> DataFrame:
    """(a, b, sim) of pairs whose estimated cosine similarity is at least ``threshold`` (above 0), a < b: the approximate
    option beside ``cosine_similarity``.

    A rating is kept with the chance min(1, limit / norm of its key) and divided by that chance, with limit =
    largest rating * sqrt(oversampling * ln(number of keys) / threshold): keys of small norm are kept whole, and a key of very many
    ratings sends only about limit / norm of them into the pairs.  An estimate is unbiased; the chance depends on the norm
    alone, so the error at or above the threshold does not grow with the data.  Whether a rating is kept is decided
    by a hash of (seed, over, key): the same rows in any partitioning."""
    if not threshold > 0:
        raise ValueError("the threshold must be above 0")
    a, b = f"{key}_1", f"{key}_2"
    unit = _sampled_ratings(ratings, threshold, key, over, seed, oversampling)
    return sums_of_pairs(unit, over, key, ["_w"], [F.sum(F.col("_w_1") * F.col("_w_2")).alias("sim")], block_size,
                         then=lambda sums: sums.select(a, b, "sim").filter(F.col("sim") >= threshold), pairs_per_wave=pairs_per_wave)


def _sampled_ratings(ratings: DataFrame, threshold: float, key: str, over: str, seed: int, oversampling: float) -> DataFrame:
    """(over, key, _w): the kept ratings, divided by their key's norm and by the chance of being kept."""
    checkpoint_dir(ratings.sparkSession)
    per_key = ratings.groupBy(key).agg(F.sqrt(F.sum(F.col("rating") * F.col("rating"))).alias("norm"),
                                       F.max(F.abs("rating")).alias("_most")).checkpoint(eager=True)
    n, most = per_key.agg(F.count(F.lit(1)), F.max("_most")).first()
    limit = float(most or 0) * math.sqrt(oversampling * math.log(max(2, n)) / threshold)
    chance = F.least(F.lit(1.0), limit / F.col("norm"))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), over, key), 11) / float(1 << 53)
    rated = balanced_join(ratings.select(over, key, "rating"), per_key.filter("norm > 0").drop("_most"), [key], written=True)
    return rated.filter(draw < chance).select(over, key, (F.col("rating") / F.col("norm") / chance).alias("_w"))


def _unit(ratings: DataFrame, key: str, over: str) -> DataFrame:
    """(over, key, _w): ratings divided by their key's norm (0 where the norm is 0)."""
    rated = balanced_join(ratings.select(over, key, "rating"), norms(ratings, key), [key])
    return rated.select(over, key, F.when(F.col("norm") == 0, F.lit(0.0)).otherwise(F.col("rating") / F.col("norm")).alias("_w"))


def masked_similarity(ratings: DataFrame, mask: DataFrame, key: str = "item", over: str = "user",
                      block_size: int = DEFAULT_BLOCK_SIZE, way: str | None = None, pairs_per_wave: int = PAIRS_PER_WAVE) -> DataFrame:
    """(a, b, sim) of the wanted pairs only: those rows of ``mask`` (a, b with a < b; a pair may be
    there more than once) that at least one ``over`` value co-rates.

    Ratings are divided by their key's norm first, so that a similarity is one sum of products and norms are not
    carried.  A dot product is summed for no other pair.  The products come from one of two ways:

    * ``groups``: the pairs inside each ``over`` group, summed in the task that owns ``a``, which keeps those it is asked for
      (``sums_of_pairs``: lists of ratings and of wanted keys are shuffled, wave by wave, and no pair);
    * ``mask``: each pair of the mask meets the ratings of its key with fewer of them, then the other key's: no group is
      ever paired with itself, so a group of very many ratings costs no more than its wanted pairs.

    Without ``way`` the one that forms fewer rows is taken; both give the same table, written."""
    a, b = f"{key}_1", f"{key}_2"
    unit = written(_unit(ratings, key, over), "unit-ratings")
    sums = [F.sum(F.col("_w_1") * F.col("_w_2")).alias("sim")]
    if (way or _cheaper_way(unit, mask, key, over)) == "groups":
        sims = sums_of_pairs(unit, over, key, ["_w"], sums, block_size, then=lambda df: df.select(a, b, "sim"),
                             pairs_per_wave=pairs_per_wave, wanted=mask)
    else:
        sims = _masked_products(unit, mask, key, over, block_size, "mask").groupBy(a, b).agg(*sums)
    sims = written(sims, "similarities")
    discard(unit)
    return sims


def _masked_products(unit: DataFrame, mask: DataFrame, key: str, over: str, block_size: int, way: str | None = None) -> DataFrame:
    """(a, b, _w_1, _w_2): the factors of each product that a pair of the mask needs."""
    a, b = f"{key}_1", f"{key}_2"
    if way is None:
        way = _cheaper_way(unit, mask, key, over)
    if way == "groups":
        rows = pairs_within_groups(unit, [over], key, carry=["_w"], block_size=block_size, keep_group=False)
        rows = rows.join(mask.select(a, b), [a, b], "left_semi")
    else:
        sizes = unit.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        wanted = mask.select(a, b).distinct()
        for c in (a, b):
            wanted = balanced_join(wanted, sizes.select(F.col(key).alias(c), F.col("_n").alias(f"_n_{c}")), [c])
        fewer = F.col(f"_n_{a}") <= F.col(f"_n_{b}")
        wanted = wanted.select(a, b, F.when(fewer, F.col(a)).otherwise(F.col(b)).alias("_p"), F.when(fewer, F.col(b)).otherwise(F.col(a)).alias("_q"))
        first = salted_join(wanted, unit.withColumnRenamed(key, "_p").withColumnRenamed("_w", "_w_1"), ["_p"], "_q", block_size)
        rows = balanced_join(first, unit.select(over, F.col(key).alias("_q"), F.col("_w").alias("_w_2")), [over, "_q"], written=True)
    return rows.select(a, b, "_w_1", "_w_2")


def rows_formed(unit: DataFrame, mask: DataFrame, key: str, over: str) -> dict[str, int]:
    """About how many rows each way of ``masked_similarity`` forms: the pairs of all groups, or for each row of the mask the
    mean number of ratings of a key."""
    n = F.col("count")
    groups = unit.groupBy(over).count().agg(F.sum(n * (n - 1) / 2), F.sum(n)).first()
    keys = unit.agg(F.approx_count_distinct(key)).first()[0]
    return {"groups": int(groups[0] or 0), "mask": int(mask.count() * (groups[1] or 0) / max(1, keys))}


def _cheaper_way(unit: DataFrame, mask: DataFrame, key: str, over: str) -> str:
    formed = rows_formed(unit, mask, key, over)
    return "mask" if formed["mask"] < formed["groups"] else "groups"


def symmetric(sims: DataFrame, key: str = "item") -> DataFrame:
    """Both orientations of a canonical (a < b) similarity table: (key, other, sim)."""
    a, b = f"{key}_1", f"{key}_2"
    ways = [F.struct(F.col(x).alias(key), F.col(y).alias("other"), "sim") for x, y in ((a, b), (b, a))]
    return sims.select(F.explode(F.array(*ways)).alias("_w")).select("_w.*")


def nearest_neighbors(sims: DataFrame, n: int = 10, key: str = "item", digits: int = 9) -> DataFrame:
    """The ``n`` most similar others per key (similarity rounded to ``digits``
    before ranking so float noise cannot flip ties; ties by id)."""
    return _ranked(symmetric(sims, key), n, key, digits)


def _ranked(both: DataFrame, n: int, key: str, digits: int) -> DataFrame:
    ranked = top_n_per_group(both, [key], [F.round("sim", digits).desc(), F.col("other").asc()], n)
    return ranked.select(key, "other", "sim", "rank")


def bounded_neighbors(ratings: DataFrame, n: int = 10, key: str = "item", over: str = "user", rest: float = 0.1,
                      digits: int = 9, block_size: int = DEFAULT_BLOCK_SIZE, least_saved: float = 0.5) -> DataFrame:
    """``nearest_neighbors`` of the exact cosine similarities without forming every co-rated pair.

    Each key's unit vector is cut in two: its *rest* holds the ratings that lie in the largest ``over`` groups, as many as
    make up at most ``rest`` of its squared norm; the others are its *head*.  Products are formed where at least one
    of the two ratings is in a head, so the pairs of the largest groups, quadratic in their size, are not formed.
    What a pair (a, b) still lacks is at most |rest of a| * |rest of b| (Cauchy-Schwarz), which bounds its similarity on both sides:

    * a key's threshold is the ``n``-th largest lower bound among its pairs;
    * a pair whose upper bound is below the threshold of a key is no candidate of that key; the candidates get their missing
      products by the mask (``_masked_products``);
    * a key is *open* if a pair without any formed product might reach its threshold, or if it has fewer than ``n``
      pairs: its rest meets all others' rests, whole.

    Pairs are formed at both their keys and summed where they are formed (``sums_across``): lists of ratings are shuffled, and a
    pair that is no candidate is neither shuffled nor written.  The rests are left empty where they would save less than the share
    ``least_saved`` of all pairs: no large group then holds enough of them to pay for the second round, and the bounds are the similarities.

    The result is exact for any ``rest`` in 0..1 and ratings of any sign; ``rest`` and ``least_saved`` only move work.  Hot groups and hot keys
    are split as in ``sums_across``, ``salted_join`` and ``balanced_join``."""
    if not 0 <= rest < 1:
        raise ValueError("rest must be in [0, 1)")
    a, b = f"{key}_1", f"{key}_2"
    unit = written(_head_and_rest(_unit(ratings, key, over), key, over, rest), "unit-ratings")
    if _share_saved(unit, over) < least_saved:
        unit = unit.withColumn("_rest", F.lit(False))
    tail = unit.filter("_rest").drop("_rest")
    left = tail.groupBy(key).agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_s"), (F.min("_w") < 0).alias("_signed"))
    left = left.checkpoint(eager=True)
    slack = 2 * 10.0 ** -digits  # similarities are ranked after rounding
    cand = _candidates(unit, left, n, key, over, block_size, slack)
    lower = cand.select(key, "other", F.col("_lower").alias("sim"))
    keys = _thresholds(lower, unit, left, n, key, rest, slack).checkpoint(eager=True)
    cand = balanced_join(cand, keys.select(key, "_t", "_open"), [key], written=True)
    cand = cand.filter((F.col("_upper") + slack >= F.col("_t")) | (F.col("_open") & (F.col("_p") < 0)))
    cand = written(cand.select(key, "other", "_p", (~F.col("_open") & (F.col("_lack") > 0)).alias("_lacks")), "neighbor-candidates")
    lacking = cand.filter("_lacks").select(key, "other")
    mask = lacking.select(F.least(key, "other").alias(a), F.greatest(key, "other").alias(b))
    products = _masked_products(tail, mask, key, over, block_size).groupBy(a, b).agg(F.sum(F.col("_w_1") * F.col("_w_2")).alias("sim"))
    completed = symmetric(products, key).join(lacking, [key, "other"], "left_semi").withColumnRenamed("sim", "_p")
    whole = cand.select(key, "other", "_p").unionByName(completed).unionByName(_open_products(tail, keys, key, over, block_size))
    ranked = _ranked(whole.groupBy(key, "other").agg(F.sum("_p").alias("sim")), n, key, digits)
    return written(ranked, "neighbors")


def _share_saved(unit: DataFrame, over: str) -> float:
    """The share of all pairs inside the groups whose two ratings are both in a rest."""
    n, rests = F.count(F.lit(1)), F.count_if("_rest")
    sizes = unit.groupBy(over).agg((n * (n - 1)).alias("_all"), (rests * (rests - 1)).alias("_saved"))
    every, saved = sizes.agg(F.sum("_all"), F.sum("_saved")).first()
    return saved / every if every else 0.0


def _candidates(unit: DataFrame, left: DataFrame, n: int, key: str, over: str, block_size: int, slack: float) -> DataFrame:
    """(key, other, _p, _lack, _lower, _upper): a key's pairs with their formed products and bounds, but for those below the ``n``-th
    largest lower bound among the pairs of the key that lie in the same task (nearly always all of them): no such pair can
    enter the key's list.  A pair whose formed products are negative stays where anything is in a rest, for an open key needs them
    beside what the rests add, also where that is 0."""
    a, b = f"{key}_1", f"{key}_2"
    rated = balanced_join(unit, left, [key], "left", written=True)
    rated = rated.select(over, key, "_w", F.coalesce("_s", F.lit(0.0)).alias("_norm"), F.coalesce("_signed", F.lit(False)).alias("_neg"), "_rest")
    cut = not left.isEmpty()
    carry = ["_w", "_norm", "_neg"] if cut else ["_w"]
    head, tail = rated.filter("not _rest"), rated.filter("_rest")
    sums = [F.sum(F.col("_w_1") * F.col("_w_2")).alias("_p")]
    if cut:
        sums += [F.max(F.col("_norm_1") * F.col("_norm_2")).alias("_lack"), F.max(F.col("_neg_1") | F.col("_neg_2")).alias("_neg")]

    def candidates(sums: DataFrame) -> DataFrame:
        if not cut:
            sums = sums.withColumn("_lack", F.lit(0.0)).withColumn("_neg", F.lit(False))
        sums = sums.withColumn("_lower", F.col("_p") - F.when(F.col("_neg"), F.col("_lack")).otherwise(0.0))
        part = Window.partitionBy(a, "_s")
        least = F.max(F.when(F.col("_place") == n, F.col("_lower")))
        sums = sums.withColumn("_place", F.row_number().over(part.orderBy(F.col("_lower").desc()))).withColumn("_t", least.over(part))
        sums = sums.withColumn("_upper", F.col("_p") + F.col("_lack"))
        kept = F.col("_t").isNull() | (F.col("_upper") + slack >= F.col("_t")) | ((F.col("_p") < 0) & F.lit(cut))
        return sums.filter(kept).select(F.col(a).alias(key), F.col(b).alias("other"), "_p", "_lack", "_lower", "_upper")

    sides = [(rated, head), (head, tail)] if cut else [(rated, head)]
    return written(sums_across(sides, over, key, carry, sums, block_size, then=candidates), "neighbor-bounds")


def _head_and_rest(unit: DataFrame, key: str, over: str, rest: float) -> DataFrame:
    """``unit`` with _rest: whether the rating belongs to its key's rest.

    Groups are ordered by classes of their size (eight to a doubling, each cut in 16 by hash), the largest first; the squares of a
    key's weights are summed per class, and its rest ends before the class that would pass ``rest``.  A key has at
    most 16 * 8 classes for each doubling of the largest group, so the running sum is over a bounded partition."""
    sizes = unit.groupBy(over).agg(F.count(F.lit(1)).alias("_n"))
    rank = (F.floor(8 * F.log2("_n")) * 16 + F.pmod(F.xxhash64(over), F.lit(16))).cast("int")
    placed = balanced_join(unit, sizes.select(over, rank.alias("_class")), [over])
    largest_first = Window.partitionBy(key).orderBy(F.col("_class").desc())
    running = (placed.groupBy(key, "_class").agg(F.sum(F.col("_w") * F.col("_w")).alias("_m"))
               .withColumn("_m", F.sum("_m").over(largest_first)))
    # a key without a norm has only weights of 0: all of them stay in its head, so that its pairs are formed
    ends = running.groupBy(key).agg(F.min(F.when(F.col("_m") <= rest, F.col("_class"))).alias("_end"), F.max("_m").alias("_all"))
    ends = ends.filter("_all > 0").select(key, "_end")
    joined = balanced_join(placed, ends, [key], "left")
    return joined.select(over, key, "_w", F.coalesce(F.col("_class") >= F.col("_end"), F.lit(False)).alias("_rest"))


def _formed_products(unit: DataFrame, key: str, over: str, block_size: int) -> DataFrame:
    """(a, b, _w_1, _w_2) of the pairs inside a group of which at least one rating is in a head: what ``_candidates`` sums."""
    a, b = f"{key}_1", f"{key}_2"
    head, tail = unit.filter("not _rest").drop("_rest"), unit.filter("_rest").drop("_rest")
    inside = pairs_within_groups(head, [over], key, carry=["_w"], block_size=block_size, keep_group=False)
    across = salted_join(head.select(over, F.col(key).alias("_p"), F.col("_w").alias("_wp")),
                         tail.select(over, F.col(key).alias("_q"), F.col("_w").alias("_wq")), [over], "_p", block_size, "_q")
    return inside.unionByName(_canonical(across, a, b))


def _open_products(tail: DataFrame, keys: DataFrame, key: str, over: str, block_size: int) -> DataFrame:
    """(key, other, _p): what the rests of two keys have in common, for each open key."""
    opened = balanced_join(tail, keys.filter("_open").select(key), [key], "left_semi", written=True)
    sums = sums_across([(opened, tail)], over, key, ["_w"], [F.sum(F.col("_w_1") * F.col("_w_2")).alias("_p")], block_size,
                       then=lambda df: df)
    return sums.select(F.col(f"{key}_1").alias(key), F.col(f"{key}_2").alias("other"), "_p")


def _canonical(rows: DataFrame, a: str, b: str) -> DataFrame:
    swap = F.col("_p") > F.col("_q")
    return rows.select(F.least("_p", "_q").alias(a), F.greatest("_p", "_q").alias(b), F.when(swap, F.col("_wq")).otherwise(F.col("_wp")).alias("_w_1"),
                       F.when(swap, F.col("_wp")).otherwise(F.col("_wq")).alias("_w_2"))


def _thresholds(bounds: DataFrame, unit: DataFrame, left: DataFrame, n: int, key: str, rest: float, slack: float) -> DataFrame:
    """(key, _t, _open) of every key: the n-th largest lower bound (minus infinity where there are fewer pairs)."""
    best = _ranked(bounds, n, key, 9).filter(F.col("rank") == n).select(key, F.col("sim").alias("_t"))
    keys = unit.select(key).distinct().join(best, key, "left").join(left.select(key, "_s"), key, "left")
    unseen = F.coalesce("_s", F.lit(0.0)) * float(math.sqrt(rest)) + slack
    t = F.coalesce("_t", F.lit(float("-inf")))
    return keys.select(key, t.alias("_t"), (F.col("_s").isNotNull() & (unseen >= t)).alias("_open"))


def _weighted(cand: DataFrame, sims: DataFrame, key: str, group: list[str], waves: int | None = None) -> DataFrame:
    """Join candidates, keyed by the pair they need (a < b), with the similarity table
    and form sum(sim * rating) / sum(sim) per group.
    A pair wanted by very many candidates is split (``balanced_join``).  With ``waves`` the similarities are a written table, and the
    candidates are joined by so many hash classes of their pairs, each summed and written before the next."""
    a, b = f"{key}_1", f"{key}_2"

    def sums(cand: DataFrame) -> DataFrame:
        scored = balanced_join(cand, sims.select(a, b, "sim"), [a, b], written=waves is not None)
        return scored.groupBy(*group).agg(F.sum("sim").alias("_s"), F.sum(F.col("sim") * F.col("rating")).alias("_sr"))

    if waves is None:
        agg = sums(cand)
    else:
        parts = [written(sums(cand.filter(F.pmod(F.xxhash64(a, b), F.lit(waves)) == w) if waves > 1 else cand), "weighted") for w in range(waves)]
        agg = parts[0]
        for p in parts[1:]:
            agg = agg.unionByName(p)
        if waves > 1:
            agg = agg.groupBy(*group).agg(F.sum("_s").alias("_s"), F.sum("_sr").alias("_sr"))
    return agg.filter(F.col("_s") != 0).withColumn("prediction", F.col("_sr") / F.col("_s"))


#: About how many candidates are shuffled to their similarities at once.
CANDIDATES_PER_WAVE = 200_000_000


def _predicted(train: DataFrame, rated: DataFrame, want: DataFrame, sims: DataFrame | None, key: str, over: str,
               group: list[str], block_size: int) -> DataFrame:
    """Candidates (target, other) that share an ``over`` value, then the similarities they need and no others.

    There are far more candidates than ratings: they are formed again where they are read, rather than written."""
    if sims is None:
        want = written(want, "wanted-pairs")
    cand = salted_join(rated, want, [over], "other", block_size).filter("target <> other")
    cand = cand.select(*group, "rating", F.least("target", "other").alias(f"{key}_1"), F.greatest("target", "other").alias(f"{key}_2"))
    if sims is not None:
        return _weighted(cand, sims, key, group)
    sizes = rated.groupBy(over).agg(F.count(F.lit(1)).alias("_n")).join(want.groupBy(over).agg(F.count(F.lit(1)).alias("_m")), over)
    formed = sizes.agg(F.sum(F.col("_n") * F.col("_m"))).first()[0] or 0
    sims = masked_similarity(train, cand, key, over, block_size)
    return _weighted(cand, sims, key, group, max(1, -(-formed // CANDIDATES_PER_WAVE)))


def item_based_predict(train: DataFrame, pairs: DataFrame, sims: DataFrame | None = None,
                       block_size: int = DEFAULT_BLOCK_SIZE, by: tuple[str, ...] = ()) -> DataFrame:
    """pred(u, i) = sum_j s(i, j) r(u, j) / sum_j s(i, j) over the items j the
    user rated in ``train``; no row when no such j is similar to i (or the
    similarity sum is 0).  Without ``sims`` only the similarities that some prediction needs are
    formed (``masked_similarity``).  A user with many ratings or many wanted items has them split into buckets
    (``salted_join``).  Columns ``by`` of pairs are kept."""
    want = pairs.select("user", F.col("item").alias("target"), *by).distinct()
    rated = train.select("user", F.col("item").alias("other"), "rating")
    out = _predicted(train, rated, want, sims, "item", "user", ["user", "target", *by], block_size)
    return out.select("user", F.col("target").alias("item"), *by, "prediction")


def user_based_predict(train: DataFrame, pairs: DataFrame, sims: DataFrame | None = None,
                       block_size: int = DEFAULT_BLOCK_SIZE, by: tuple[str, ...] = ()) -> DataFrame:
    """pred(u, i) = sum_v s(u, v) r(v, i) / sum_v s(u, v) over the users v who
    rated i in ``train`` (an item with many raters or many wanted users is split into
    buckets).  Without ``sims`` only the similarities that some prediction needs are formed."""
    want = pairs.select(F.col("user").alias("target"), "item", *by).distinct()
    rated = train.select(F.col("user").alias("other"), "item", "rating")
    out = _predicted(train, rated, want, sims, "user", "item", ["target", "item", *by], block_size)
    return out.select(F.col("target").alias("user"), "item", *by, "prediction")


def _int_id(name: str):
    """ALS takes 32-bit ids; a larger one fails instead of wrapping round to another."""
    c = F.col(name)
    fits = c.isNull() | c.between(-(1 << 31), (1 << 31) - 1)
    return F.when(fits, c).otherwise(F.raise_error(F.lit(f"{name} does not fit into 32 bits")).cast("bigint")).cast("int").alias(name)


#: About how many ratings one block of ALS holds at most: a task builds and solves a block in memory.
RATINGS_PER_BLOCK = 1_000_000

#: More ratings than this are fitted one rank at a time: each fit keeps its own blocks of all of them.
RATINGS_AT_ONCE = 10_000_000


def als_fit(train: DataFrame, rank: int = 8, max_iter: int = 5, reg: float = 0.1, seed: int = 5,
            num_blocks: int | None = None, checkpoint_interval: int = 1):
    """Explicit-feedback ALS (``pyspark.ml``); ids must fit in 32-bit ints.

    Blocks default to the cluster's parallelism (one factor block per core), or to more where a block would hold more than
    about ``RATINGS_PER_BLOCK`` ratings; item factors are checkpointed to the session's checkpoint folder every
    ``checkpoint_interval`` iterations, which bounds lineage on long fits and is when ALS removes what the iterations before have shuffled.
    The model is written and read back: it hangs on two small tables, not on the blocks of the fit."""
    from pyspark.ml.recommendation import ALS, ALSModel

    spark = train.sparkSession
    blocks = num_blocks or max(1, spark.sparkContext.defaultParallelism, -(-train.count() // RATINGS_PER_BLOCK))
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, seed=seed, userCol="user", itemCol="item",
              ratingCol="rating", coldStartStrategy="drop", numUserBlocks=blocks,
              numItemBlocks=blocks, checkpointInterval=checkpoint_interval)
    data = train.select(_int_id("user"), _int_id("item"), "rating")
    path = f"{checkpoint_dir(spark).rstrip('/')}/als-model-{uuid.uuid4().hex}"
    model = als.fit(data)
    model.write().save(path)
    del model
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # shuffles of RDDs go when the driver collects what refers to them
    return ALSModel.load(path)


def als_predict(model, pairs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Predictions for (user, item) pairs; unknown users or items give no row."""
    data = pairs.select(_int_id("user"), _int_id("item"), *by)
    return model.transform(data).select(F.col("user").cast("bigint").alias("user"),
                                        F.col("item").cast("bigint").alias("item"), *by,
                                        F.col("prediction").cast("double").alias("prediction"))


def als_rank_search(train: DataFrame, valid: DataFrame, ranks: Sequence[int] = (4, 8, 12),
                    max_iter: int = 5, reg: float = 0.1, seed: int = 5, at_once: int = 3) -> tuple[DataFrame, int]:
    """Fit one model per rank; train and validation RMSE per rank (scored in
    one pass over both splits); returns (table, best_rank) with the lowest
    validation RMSE.  Both splits are written once to the checkpoint folder; up to ``at_once`` ranks
    are fitted as concurrent jobs over them, so that one fit's short stages fill the cores another leaves idle; beyond
    ``RATINGS_AT_ONCE`` ratings one after another, since every fit holds all ratings."""
    table, best, _ = _rank_search(train, valid, ranks, max_iter, reg, seed, at_once)
    return table, best


def _rank_search(train: DataFrame, valid: DataFrame, ranks: Sequence[int], max_iter: int = 5, reg: float = 0.1, seed: int = 5,
                 at_once: int = 3):
    """(table, best rank, the model fitted with it)."""
    spark = train.sparkSession
    checkpoint_dir(spark)
    both = (train.select("user", "item", "rating", F.lit("train").alias("split"))
            .unionByName(valid.select("user", "item", "rating", F.lit("valid").alias("split"))))
    both = written(both, "rank-search")
    train = both.filter("split = 'train'").drop("split")
    models = {}

    def fitted(r: int) -> tuple:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"als-rank-{r}")  # this thread's jobs only
        model = models[r] = als_fit(train, r, max_iter, reg, seed)
        scored = model.transform(both.select(_int_id("user"), _int_id("item"), "rating", "split"))
        res = {x["split"]: x["rmse"] for x in scored.groupBy("split").agg(
            F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("rating"), 2))).alias("rmse")).collect()}
        return r, res.get("train"), res.get("valid")

    if train.count() > RATINGS_AT_ONCE:
        at_once = 1
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        rows = [f.result() for f in [pool.submit(inheritable_thread_target(spark)(fitted), int(r)) for r in ranks]]
    valid_rows = [x for x in rows if x[2] is not None]
    best = min(valid_rows, key=lambda x: x[2])[0] if valid_rows else int(ranks[0])
    table = spark.createDataFrame([(r, t, v, r == best) for r, t, v in rows],
                                  "rank int, train_rmse double, valid_rmse double, is_best boolean")
    return table, best, models[best]


def method_comparison(train: DataFrame, valid: DataFrame, test: DataFrame,
                      ranks: Sequence[int] = (4, 8, 12), block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """(method, split, rmse, n) for ALS (best rank by validation), the bias
    baseline, item-based and user-based CF on one split; the few rows of a method are written before the next one begins."""
    _, _, model = _rank_search(train, valid, ranks)
    both = valid.withColumn("split", F.lit("valid")).unionByName(test.withColumn("split", F.lit("test")))
    by = ("split",)
    preds = {
        "als": als_predict(model, both, by),
        "baseline": baseline_predict(train, both, by),
        "item_cf": item_based_predict(train, both, None, block_size, by),
        "user_cf": user_based_predict(train, both, None, block_size, by),
    }
    out = None
    for method, p in preds.items():
        part = rmse_by_split(p, both, ("valid", "test")).select(F.lit(method).alias("method"), "split", "rmse", "n")
        part = written(part, "scores")
        out = part if out is None else out.unionByName(part)
    return out
