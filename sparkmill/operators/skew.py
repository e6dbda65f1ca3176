"""Skew-safe building blocks: hot-group detection and salted pair generation.

Any single group (a user, an item, a document, a prefix) may hold a large
share of all rows.  Pairing rows inside a group is quadratic in its size, so a
hot group is cut into item buckets and every bucket pair becomes its own join
key: no task ever holds more than about ``2 * block_size`` rows of one group,
and groups at or under ``block_size`` rows are not replicated at all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BLOCK_SIZE = 2000

#: About how many pairs one task of ``sums_of_pairs`` forms and sums.
PAIRS_PER_TASK = 1_000_000

#: About how many pairs' entries of lists are shuffled before what is kept of them is written and they are removed.
PAIRS_PER_WAVE = 300_000_000


def balanced_join(df: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "inner", written: bool = False) -> DataFrame:
    """Join rows with a table of one row per key, whatever share of ``df`` one key holds.

    The per-key table is usually an aggregate, which leaves it hash-partitioned, and AQE
    only splits a skewed partition when *both* sides of the join come straight from a
    shuffle.  Written to the checkpoint folder it is a plain table again: Spark broadcasts
    it if its size in bytes allows, or shuffles both sides and splits the hot key's rows.
    No size is tested here.  ``written`` says that the table has just been written or checkpointed."""
    from sparkmill import session

    return df.join(per_key if written else session.written(per_key, "per-key"), list(keys), how)


def with_bucket_count(df: DataFrame, group_cols: Sequence[str], block_size: int,
                      name: str = "_nb") -> DataFrame:
    """Attach ``ceil(group size / block_size)`` (1 for ordinary groups) to every row."""
    group_cols = list(group_cols)
    hot = (df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"))
             .filter(F.col("_n") > block_size)
             .select(*group_cols, F.ceil(F.col("_n") / block_size).cast("int").alias(name)))
    joined = balanced_join(df, hot, group_cols, "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(1)))


def pairs_within_groups(df: DataFrame, group_cols: Sequence[str], item_col: str,
                        carry: Sequence[str] = (), block_size: int = DEFAULT_BLOCK_SIZE,
                        keep_group: bool = True) -> DataFrame:
    """Every unordered pair of distinct items that share a group, exactly once.

    Input: one row per (group, item) plus ``carry`` columns.  Output columns:
    group columns (if ``keep_group``), ``{item}_1``, ``{item}_2`` with
    ``{item}_1 < {item}_2``, and ``{c}_1`` / ``{c}_2`` for each carried column.

    Plan: bucket b = pmod(xxhash64(item), nb) per hot group; the left copy of a
    row goes to keys (b, q) for q >= b, the right copy to keys (p, b) for p <= b;
    an equi-join on (group, p, q) then meets every bucket pair once.
    """
    group_cols = list(group_cols)
    carry = list(carry)
    it1, it2 = f"{item_col}_1", f"{item_col}_2"
    sized = with_bucket_count(df.select(*group_cols, item_col, *carry), group_cols, block_size)
    bucket = F.pmod(F.xxhash64(F.col(item_col)), F.col("_nb")).cast("int")
    sized = sized.withColumn("_b", bucket)
    left = sized.select(
        *group_cols,
        F.col("_b").alias("_p"),
        F.explode(F.sequence(F.col("_b"), F.col("_nb") - 1)).alias("_q"),
        F.col(item_col).alias("_li"), *[F.col(c).alias(f"_l_{c}") for c in carry])
    right = sized.select(
        *group_cols,
        F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("_p"),
        F.col("_b").alias("_q"),
        F.col(item_col).alias("_ri"), *[F.col(c).alias(f"_r_{c}") for c in carry])
    joined = left.join(right, group_cols + ["_p", "_q"], "inner")
    joined = joined.filter((F.col("_p") < F.col("_q")) | (F.col("_li") < F.col("_ri")))
    swap = F.col("_li") > F.col("_ri")
    out = [*(group_cols if keep_group else []),
           F.least("_li", "_ri").alias(it1), F.greatest("_li", "_ri").alias(it2)]
    for c in carry:
        out.append(F.when(swap, F.col(f"_r_{c}")).otherwise(F.col(f"_l_{c}")).alias(f"{c}_1"))
        out.append(F.when(swap, F.col(f"_l_{c}")).otherwise(F.col(f"_r_{c}")).alias(f"{c}_2"))
    return joined.select(*out)


def sums_of_pairs(df: DataFrame, group_col: str, item_col: str, carry: Sequence[str], sums: Sequence[Column],
                  block_size: int = DEFAULT_BLOCK_SIZE, both: bool = False, where: Column | None = None,
                  pairs_per_task: int = PAIRS_PER_TASK, then: Callable[[DataFrame], DataFrame] | None = None,
                  pairs_per_wave: int = PAIRS_PER_WAVE, wanted: DataFrame | None = None) -> DataFrame:
    """``pairs_within_groups(...).filter(where).groupBy(item_1, item_2).agg(*sums)``, of which only lists are shuffled, never a pair.

    Each group is one list of its items (a group of more than ``block_size`` rows several, by hash of the item).  An item
    is sent the rest of each list it is in, as arrays in one row, to the task that owns it; that task forms the item's pairs and sums
    them where they are: no pair is shuffled, spilled or written.  Whole numbers are sent in the narrowest type that holds all of them (``_narrowest``).
    Tasks are as many as the pairs need (``pairs_per_task``); the
    pairs of an item with more are dealt to several by hash of the other item.  At most (pairs / ``pairs_per_task``) items
    are such, hence the broadcast.  With ``both`` each pair is there in both orientations.

    ``then`` is what is kept of the sums, row by row or per item_1.  Where there are more than ``pairs_per_wave`` pairs it is written for about as many
    at a time (the items of one hash class), and the lists sent for them are removed before the next: what stands on disk does not grow with the pairs.
    With ``wanted`` (item_1, item_2; item_1 < item_2, rows may repeat) only sums of those pairs are returned."""
    from sparkmill.session import written

    it1, it2 = f"{item_col}_1", f"{item_col}_2"
    carry = list(carry)
    sized = with_bucket_count(df.select(group_col, item_col, *carry).filter(F.col(group_col).isNotNull() & F.col(item_col).isNotNull()),
                              [group_col], block_size)
    sized = sized.withColumn("_b", F.pmod(F.xxhash64(item_col), F.col("_nb")).cast("int"))
    whole = F.sort_array(F.collect_list(F.struct(item_col, *carry)))
    lists = sized.repartition(group_col, "_b").groupBy(group_col, "_b").agg(whole.alias("_l"), F.max("_nb").alias("_nb"))
    arrays = {item_col: "_ids"} | {c: f"_c_{c}" for c in carry}
    lists = written(lists.select(group_col, "_b", "_nb", *[F.col("_l")[c].alias(n) for c, n in arrays.items()]), "lists")
    lists, wide = _narrowest(lists, arrays)

    def sent(rows: DataFrame, other: str) -> DataFrame:
        """One row per item of a list: the items of the ``other`` list it is paired with."""
        rows = rows.select("*", F.posexplode("_ids").alias("_i", it1))
        own = [F.col(f"_c_{c}")[F.col("_i")].alias(f"{c}_1") for c in carry]
        if both:
            skip = F.lit(0)
        elif other == "":
            skip = F.col("_i") + 1  # lists are sorted; an item that is there again is dropped behind
        else:
            skip = F.size(F.filter(F.col(f"_ids{other}"), lambda x: x <= F.col(it1)))
        rest = [F.slice(F.col(f"{n}{other}"), skip + 1, F.greatest(F.size(f"_ids{other}") - skip, F.lit(0))).alias(n) for n in arrays.values()]
        return rows.select(it1, *own, *rest).filter(F.size("_ids") > 0)

    rows = sent(lists, "")
    hot = lists.filter("_nb > 1")
    blocks = hot.withColumn("_q", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))).filter("_q <> _b")
    across = hot.select(F.col(group_col).alias("_g"), F.col("_b").alias("_q"), *[F.col(n).alias(f"{n}_o") for n in arrays.values()])
    across = blocks.withColumnRenamed(group_col, "_g").join(across, ["_g", "_q"])
    rows = rows.unionByName(sent(across, "_o"))
    where = F.lit(True) if where is None else where
    distinct = F.col(it1) != F.col(it2) if both else F.col(it1) < F.col(it2)
    if wanted is not None:
        rows = rows.withColumn("_asks", F.lit(False)).unionByName(_asking(rows, wanted, it1, it2, arrays, block_size))
    return _sums_of_sent(rows, item_col, carry, sums, distinct & where, pairs_per_task, wide, then, pairs_per_wave, wanted is not None)


def _narrowest(lists: DataFrame, arrays: dict[str, str]) -> tuple[DataFrame, dict[str, str]]:
    """Arrays of whole numbers in the narrowest type that holds every one of them, and the types they had: what is shuffled is bytes."""
    types = {c: t[len("array<"):-1] for c, t in lists.dtypes if c in arrays.values()}
    numeric = [n for n in arrays.values() if types[n] in ("bigint", "int", "double")]
    kinds = ("tinyint", "smallint", "int")

    def fits(n: str, kind: str) -> Column:
        # a value that does not fit becomes null
        return F.coalesce(F.every(F.forall(n, lambda x: x.isNull() | F.coalesce(x.try_cast(kind).cast(types[n]) == x, F.lit(False)))), F.lit(True))

    found = lists.agg(*[fits(n, k).alias(f"{n}:{k}") for n in numeric for k in kinds]).first() if numeric else {}
    least = {n: next((k for k in kinds if found[f"{n}:{k}"]), types[n]) for n in numeric}
    narrow = lists.select(*[F.col(c).cast(f"array<{least[c]}>").alias(c) if c in least else F.col(c) for c in lists.columns])
    return narrow, {c: types[n] for c, n in arrays.items() if n in least}


def _asking(rows: DataFrame, wanted: DataFrame, it1: str, it2: str, arrays: dict[str, str], block_size: int) -> DataFrame:
    """Rows like ``rows`` that form the wanted pairs, without values and marked by _asks; lists of at most ``block_size`` items or so."""
    from sparkmill.session import written

    types = dict(rows.dtypes)
    sized = with_bucket_count(wanted.select(it1, it2), [it1], block_size)
    lists = sized.groupBy(it1, F.pmod(F.xxhash64(it2), F.col("_nb")).alias("_b")).agg(F.collect_set(it2).alias("_ids"))

    def none(n: str) -> Column:
        return F.transform("_ids", lambda x: F.lit(None).cast(types[n][len("array<"):-1]))

    # an id that no narrowed list can hold is in none
    ids = F.transform("_ids", lambda x: x.try_cast(types["_ids"][len("array<"):-1]))
    lists = lists.select(F.col(it1).try_cast(types[it1]).alias(it1), F.filter(ids, lambda x: x.isNotNull()).alias("_ids")).filter(F.col(it1).isNotNull())
    lists = written(lists, "wanted")
    out = {it1: F.col(it1), "_ids": F.col("_ids")} | {n: none(n) for n in arrays.values() if n != "_ids"}
    return lists.select(*[out[c].alias(c) if c in out else F.lit(None).cast(types[c]).alias(c) for c in rows.columns], F.lit(True).alias("_asks"))


def sums_across(sides: Sequence[tuple[DataFrame, DataFrame]], group_col: str, item_col: str, carry: Sequence[str], sums: Sequence[Column],
                block_size: int = DEFAULT_BLOCK_SIZE, pairs_per_task: int = PAIRS_PER_TASK,
                then: Callable[[DataFrame], DataFrame] | None = None, pairs_per_wave: int = PAIRS_PER_WAVE) -> DataFrame:
    """({item}_1, _s, {item}_2, *sums) of the pairs of a left row and a right row of its group, over all (left, right) of ``sides``:
    ``sums_of_pairs`` in one orientation, between two tables.

    A left row is sent the lists of the right rows of its group (of at most ``block_size`` rows each), and no other; its pairs are summed in the task
    that owns its item.  ``_s`` tells apart the parts of an item with very many pairs: rows are hash-partitioned by ({item}_1, _s).
    ``then``: as in ``sums_of_pairs``."""
    from sparkmill.session import written

    rows = None
    for left, right in sides:
        left, right = (df.select(group_col, item_col, *carry).filter(F.col(group_col).isNotNull() & F.col(item_col).isNotNull()) for df in (left, right))
        sized = with_bucket_count(right, [group_col], block_size)
        sized = sized.withColumn("_b", F.pmod(F.xxhash64(item_col), F.col("_nb")).cast("int"))
        lists = sized.groupBy(group_col, "_b").agg(F.sort_array(F.collect_list(F.struct(item_col, *carry))).alias("_l"))
        lists = lists.select(group_col, F.col("_l")[item_col].alias("_ids"), *[F.col("_l")[c].alias(f"_c_{c}") for c in carry])
        own = left.select(group_col, F.col(item_col).alias(f"{item_col}_1"), *[F.col(c).alias(f"{c}_1") for c in carry])
        sent = balanced_join(own, written(lists, "lists"), [group_col], written=True).drop(group_col)
        rows = sent if rows is None else rows.unionByName(sent)
    where = F.col(f"{item_col}_1") != F.col(f"{item_col}_2")
    return _sums_of_sent(rows, item_col, list(carry), sums, where, pairs_per_task, {}, then, pairs_per_wave)


def _sums_of_sent(rows: DataFrame, item_col: str, carry: Sequence[str], sums: Sequence[Column], where: Column, pairs_per_task: int,
                  wide: dict[str, str], then: Callable[[DataFrame], DataFrame] | None, pairs_per_wave: int, asked: bool = False) -> DataFrame:
    """Sums per pair of items, from rows of an item, its carried values and the lists it is paired with; see ``sums_of_pairs``.
    ``wide``: the types of columns that were narrowed; ``asked``: only pairs of rows marked by _asks are returned."""
    from sparkmill.session import discard, written

    it1, it2 = f"{item_col}_1", f"{item_col}_2"
    arrays = {item_col: "_ids"} | {c: f"_c_{c}" for c in carry}
    per = written(rows.groupBy(it1).agg(F.sum(F.size("_ids")).alias("_n")), "pairs-of-items")
    formed, most = per.agg(F.sum("_n"), F.max("_n")).first()
    formed, most = formed or 0, most or 0
    at, marks = [it1], ["_asks"] if asked else []
    if most > pairs_per_task:
        salts = per.filter(F.col("_n") > pairs_per_task).select(it1, F.ceil(F.col("_n") / pairs_per_task).cast("int").alias("_salts"))
        rows = rows.join(F.broadcast(salts), it1, "left").withColumn("_salts", F.coalesce("_salts", F.lit(1)))
        rows = rows.withColumn("_s", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
        # by the id as it was, so that a narrowed one goes to the same part
        dealt = F.filter(F.arrays_zip(*arrays.values()), lambda x: F.pmod(F.xxhash64(x["_ids"].cast("bigint") if item_col in wide else x["_ids"]), F.col("_salts")) == F.col("_s"))
        rows = rows.select(it1, "_s", *marks, *[f"{c}_1" for c in carry],
                           F.when(F.col("_salts") == 1, F.arrays_zip(*arrays.values())).otherwise(dealt).alias("_z"))
        rows = rows.select(it1, "_s", *marks, *[f"{c}_1" for c in carry], *[F.col("_z")[n].alias(n) for n in arrays.values()])
        at = [it1, "_s"]

    def typed(c: str, name: str) -> Column:
        return F.col(name).cast(wide[c]).alias(name) if c in wide else F.col(name)

    def summed(rows: DataFrame, n: int) -> DataFrame:
        tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // pairs_per_task))
        pairs = rows.repartition(tasks, *at).select("*", F.posexplode("_ids").alias("_j", it2))
        pairs = pairs.select(*at, it2, *marks, *[f"{c}_1" for c in carry], *[F.col(f"_c_{c}")[F.col("_j")].alias(f"{c}_2") for c in carry])
        # keys stay as narrow as they were sent, for another column would not be what the rows are partitioned by
        pairs = pairs.select(*at, it2, *marks, *[typed(c, f"{c}_{i}") for c in carry for i in (1, 2)]).filter(where)
        if asked:
            plain = [F.max("_asks").alias("_asked"), F.max(~F.col("_asks")).alias("_formed")]
            pairs = pairs.groupBy(*at, it2).agg(*sums, *plain).filter("_asked and _formed").drop("_asked", "_formed")
        else:
            pairs = pairs.groupBy(*at, it2).agg(*sums)
        return pairs if "_s" in at else pairs.withColumn("_s", F.lit(0))  # a constant would not be part of the partitioning

    waves = max(1, -(-formed // pairs_per_wave)) if then else 1
    if waves == 1:
        out = then(summed(rows, formed)) if then else summed(rows, formed)
    else:
        out = None
        for w in range(waves):
            some = rows.filter(F.pmod(F.xxhash64(F.lit("wave"), it1), F.lit(waves)) == w)
            part = written(then(summed(some, formed // waves)), "wave")
            out = part if out is None else out.unionByName(part)
        discard(per)
    keys = [c for c in (it1, it2) if c in out.columns and item_col in wide]
    return out.select(*[F.col(c).cast(wide[item_col]).alias(c) if c in keys else F.col(c) for c in out.columns])


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], salt_by: str,
                block_size: int = DEFAULT_BLOCK_SIZE, right_salt_by: str | None = None) -> DataFrame:
    """Inner equi-join that stays balanced when a key is hot on either side or on both.

    A key of more than ``block_size`` rows on a side is cut there into
    ceil(n / block_size) buckets by hash of that side's salt column, and its rows on the
    other side are copied once per bucket.  A join key (key, left bucket, right bucket) then
    holds at most about ``block_size`` rows of each side; keys that are ordinary on both sides
    are not copied.  ``right_salt_by`` defaults to all columns of ``right``.
    The result equals ``left.join(right, keys)``."""
    from sparkmill.session import written

    keys = list(keys)

    def sizes(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block_size).cast("int").alias(name)).filter(F.col(name) > 1)

    hot = sizes(left, "_ln").join(sizes(right, "_rn"), keys, "full")
    hot = written(hot, "hot-keys")
    ones = {n: F.coalesce(n, F.lit(1)) for n in ("_ln", "_rn")}
    right_salt = [right_salt_by] if right_salt_by else right.columns

    def bucket(columns: list, n: str):
        return F.pmod(F.xxhash64(*columns), ones[n]).cast("int")

    a = (left.join(hot, keys, "left").withColumn("_lb", bucket([salt_by], "_ln"))
         .withColumn("_rb", F.explode(F.sequence(F.lit(0), ones["_rn"] - 1))).drop("_ln", "_rn"))
    b = (right.join(hot, keys, "left").withColumn("_rb", bucket(right_salt, "_rn"))
         .withColumn("_lb", F.explode(F.sequence(F.lit(0), ones["_ln"] - 1))).drop("_ln", "_rn"))
    return a.join(b, keys + ["_lb", "_rb"]).drop("_lb", "_rb")
