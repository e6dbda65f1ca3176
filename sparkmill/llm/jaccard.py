"""N-gram Jaccard join, size-aware: subsets for small sets, inverted lists for large ones.

A text's set holds its distinct word shingles, as 64-bit hashes.  Texts of equal sets form a
class; the join runs over classes, so exact copies cost nothing further.

Two linked sets share ``need(n)`` shingles at least, so in one order of all shingles
each shares its least with the other within its first n - need + 1 (its prefix), and two within
one more.  Shingles that recur within batches of texts come later in that order, the
more often the later (the order may be any; counts only make it cheap).

* Small sets (n up to the boundary) post every two-subset of their longer prefix.
* Large sets, and the small ones that a large one can link with, post their prefix
  to the inverted lists; so do sets that need share only one shingle, at 50 percent and less.

The boundary is chosen by cost from the histogram of set sizes: postings of either kind,
and the partners that an inverted list is expected to bring.

Lists with two classes or more are scanned in blocks.  A parity map of 512 bits per
class bounds the difference of two sets from below, which rules out most pairs.
Round one takes, for each class of a block, the nearest one before it, verifies these pairs
against the whole texts and joins what links into components.  Round two takes every pair,
over all blocks of a list, whose classes still lie in different components and that the
maps cannot rule out.  Pairs within a component are never listed, and none is lost.

Defined cases: null texts and texts without words have an empty set and link with nothing;
fewer words than a shingle make one shingle; repeated rows are copies; a null id never is
the smallest, unless all are null; an empty table gives none; further columns, whatever
their names, are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmill.llm import slots
from sparkmill.llm import words as W
from sparkmill.llm.components import components
from sparkmill.llm.store import fresh_name, give_back, lean_batches, small_batches, stored

_KIND = W.non_space(lower=True)
_MAP_BITS, _WIDE_BITS = 9, 13
_OFTEN = 4
_COUNTED = 1 << 22
BLOCK = 2048
SMALL = 16
_PARTNER_COST = 8.0
_U64 = np.uint64


def need(n: np.ndarray, percent: int) -> np.ndarray:
    """How many shingles a set of n shares with any set it links with."""
    return (percent * n + 99) // 100


# ------------------------------------------------------------------------ sets of shingles
def _sets(array: pa.Array, shingle: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, sizes, where each set begins, shingles ascending within a set) of runs of texts."""
    for row, data, offsets in W.chunks(array):
        w = W.split(data, offsets, _KIND)
        at, h = w.windows(shingle)
        short = w.first[:-1][(w.counts < shingle) & (w.counts > 0)]
        doc = np.concatenate([w.doc[at], w.doc[short]])
        h = np.concatenate([h, w.window_hash(short, w.counts[w.doc[short]])])
        order = np.lexsort((h, doc))
        doc, h = doc[order], h[order]
        if len(h):
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
            doc, h = doc[new], h[new]
        first = np.searchsorted(doc, np.arange(len(offsets)))
        yield row, np.diff(first), first, h


def _classes(sizes: np.ndarray, first: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One 64-bit name per set, the same for equal sets."""
    a, b = (np.concatenate([np.zeros(1, _U64), np.cumsum(W.mix(h ^ _U64(k)), dtype=_U64)]) for k in (1, 2))
    return W.mix(W.mix(a[first[1:]] - a[first[:-1]]) ^ (b[first[1:]] - b[first[:-1]]) ^ sizes.astype(_U64)).view(np.int64)


def _maps(sizes: np.ndarray, h: np.ndarray, bits: int = _MAP_BITS) -> np.ndarray:
    """Parity map per set: each shingle flips one of 2**bits bits."""
    bit = (W.mix(h ^ _U64(3)) >> _U64(64 - bits)).astype(np.int64) + np.repeat(np.arange(len(sizes)), sizes) * (1 << bits)
    spots, times = np.unique(bit, return_counts=True)
    out = np.zeros(len(sizes) << bits, dtype=np.uint8)
    out[spots] = times & 1
    return np.packbits(out.reshape(len(sizes), -1), axis=1)


def _summaries(shingle: int):
    """Rows of two kinds: a text's set in brief, and shingles that recur within ``_COUNTED`` of a task, with their counts."""
    def recur(held: list[np.ndarray]) -> pa.RecordBatch:
        h, times = np.unique(np.concatenate([np.zeros(0, _U64), *held]), return_counts=True)
        h, times = h[times > 1], times[times > 1]
        none = pa.array([None] * len(h), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, pa.array(h.view(np.int64)), pa.array([None] * len(h), pa.binary()), pa.array(times)],
                                          names=["doc_id", "text_hash", "n", "name", "map", "recurs"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        held, size = [], 0
        for batch in batches:
            for row, sizes, first, h in _sets(batch.column("text"), shingle):
                n = len(sizes)
                maps = _maps(sizes, h)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, n), batch.column("text_hash").slice(row, n), pa.array(sizes.astype(np.int64)),
                     pa.array(_classes(sizes, first, h)), pa.array([x.tobytes() for x in maps], pa.binary()), pa.array([None] * n, pa.int64())],
                    names=["doc_id", "text_hash", "n", "name", "map", "recurs"])
                held.append(h)
                size += len(h)
                if size >= _COUNTED:
                    yield recur(held)
                    held, size = [], 0
        yield recur(held)

    return rows


# ------------------------------------------------------------------------ order and boundary
def _order(recurring: DataFrame) -> np.ndarray:
    """By the top bits of a shingle: log2 of the largest count there, from ``_OFTEN`` on."""
    counts = recurring.groupBy("name").agg(F.sum("recurs").alias("times")).filter(F.col("times") >= _OFTEN)
    slot = F.shiftrightunsigned("name", 64 - slots.BITS)
    return slots.table(counts.groupBy(slot.alias("slot")).agg(F.least(F.max(F.floor(F.log2("times"))), F.lit(63)).cast("int").alias("value")))


def choose_boundary(sizes: pd.DataFrame, meeting: float, percent: int) -> int:
    """The size up to which two-subsets cost less: sizes has (n, sets), meeting is the
    share of shingles that recur."""
    sizes = sizes[sizes["n"] > 0].sort_values("n")
    n, sets = sizes["n"].to_numpy(dtype=np.int64), sizes["sets"].to_numpy(dtype=np.float64)
    prefix = n - need(n, percent) + 1
    subsets, lists = sets * prefix * (prefix + 1) / 2, sets * prefix * (1 + _PARTNER_COST * meeting)
    best, cost = 0, lists.sum()
    for b in n:
        c = subsets[n <= b].sum() + (lists[100 * n >= percent * (b + 1)].sum() if (n > b).any() else 0.0)
        if c < cost:
            best, cost = int(b), c
        if subsets[n <= b].sum() > cost:
            break
    return best


# ------------------------------------------------------------------------ postings
def _postings(shingle: int, percent: int, order: np.ndarray, boundary: int, largest: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        seen: set[int] = set()  # copies met lately post once
        for batch in batches:
            if len(seen) > 100_000:
                seen.clear()
            for _, sizes, first, h in _sets(batch.column("text"), shingle):
                names = _classes(sizes, first, h)
                fresh = np.zeros(len(sizes), dtype=bool)
                for d in np.flatnonzero(sizes):
                    if int(names[d]) not in seen:
                        seen.add(int(names[d]))
                        fresh[d] = True
                doc = np.repeat(np.arange(len(sizes)), sizes)
                rank = order[(h >> _U64(64 - slots.BITS)).astype(np.int64)].astype(_U64)
                place = np.lexsort(((rank << _U64(58)) | (W.mix(h) >> _U64(6)), doc))
                h = h[place]
                prefix = sizes - need(sizes, percent) + 1
                small, listed = fresh & (sizes <= boundary) & (sizes > 1), fresh & (100 * sizes >= percent * (boundary + 1)) & (largest > boundary)
                if need(2, percent) < 2:  # sets of different sizes may link by one shingle
                    listed |= fresh & (need(sizes, percent) < 2) & (sizes > 0)
                at = np.arange(len(h)) - first[doc]
                one = np.flatnonzero(listed[doc] & (at < prefix[doc]))
                keys, owner = [W.mix(h[one] ^ _U64(5))], [doc[one]]
                # each member of the longer prefix with every later one
                lead = np.flatnonzero(small[doc] & (at < prefix[doc]))
                later = np.minimum(prefix, sizes - 1)[doc[lead]] - at[lead]
                a = np.repeat(lead, later)
                b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(later) - later, later)
                low, high = np.minimum(h[a], h[b]), np.maximum(h[a], h[b])
                keys.append(W.mix(W.mix(low) + high))
                owner.append(doc[a])
                who = np.concatenate(owner)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(names[who]), pa.array(sizes[who].astype(np.int64))],
                                                 names=["key", "name", "n"])

    return rows


def _shared(percent: int):
    """Of rows sorted by (key, n, name): one per (key, name) that another name of its key fits in size,
    with the number of its block in the key's list.  In order of size a class fits some other if it
    fits a neighbour."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        held = None  # the last row: (key, n, name), its place in the list, and the row if it is not out yet

        def out(batch: pa.RecordBatch, place: np.ndarray) -> pa.RecordBatch:
            return batch.append_column("block", pa.array(place // BLOCK))

        for batch in batches:
            key, n, name = (batch.column(c).to_numpy() for c in ("key", "n", "name"))
            if not len(key):
                continue
            fresh = np.concatenate([[held is None or (key[0], n[0], name[0]) != held[0]], (key[1:] != key[:-1]) | (name[1:] != name[:-1])])
            at = np.flatnonzero(fresh)
            if not len(at):
                continue
            k, size = key[at], n[at]
            head = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            place = np.arange(len(at)) - np.repeat(head, np.diff(np.append(head, len(at))))
            same_key = held is not None and k[0] == held[0][0]
            if same_key:
                place[k == k[0]] += held[1] + 1
            fits = (k[1:] == k[:-1]) & (100 * size[:-1] >= percent * size[1:])
            with_held = same_key and 100 * held[0][1] >= percent * size[0]
            if with_held and held[2] is not None:
                yield out(held[2], np.array([held[1]]))
            take = np.concatenate([[with_held], fits]) | np.concatenate([fits, [False]])
            if take.any():
                yield out(batch.take(pa.array(at[take])), place[take])
            held = ((k[-1], size[-1], name[at[-1]]), int(place[-1]), None if take[-1] else batch.slice(int(at[-1]), 1))

    return rows


# ------------------------------------------------------------------------ candidates
def _compatible(n, maps, comp, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Matrix: which of rows a may link with which of rows b; the value is the bound of the
    difference, or -1."""
    differ = np.bitwise_count(maps[a][:, None, :] ^ maps[b][None, :, :]).sum(axis=2, dtype=np.int64)
    total = n[a][:, None] + n[b][None, :]
    ok = ((100 + percent) * differ <= (100 - percent) * total) & (comp[a][:, None] != comp[b][None, :])
    ok &= 100 * np.minimum(n[a][:, None], n[b][None, :]) >= percent * np.maximum(n[a][:, None], n[b][None, :])
    return np.where(ok, differ, -1)


def _block_pairs(group: pd.DataFrame, percent: int, nearest: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    n, comp, side = (group[c].to_numpy() for c in ("n", "comp", "side"))
    maps = np.frombuffer(b"".join(group["map"]), dtype=_U64).reshape(len(group), -1)
    rows = np.arange(len(group))
    for at in range(0, len(rows), 64):
        a = rows[at:at + 64]
        bound = _compatible(n, maps, comp, a, rows, percent)
        bound[a[:, None] >= rows[None, :]] = -1  # each pair once
        if (side != side[0]).any():  # two blocks: pairs between them only
            bound[side[a][:, None] == side[None, :]] = -1
        if nearest:
            far = np.where(bound >= 0, bound, 1 << 40)
            j = np.argmin(far, axis=1)
            i = np.flatnonzero(far[np.arange(len(a)), j] < 1 << 40)
            j = j[i]
        else:
            i, j = np.nonzero(bound >= 0)
        yield a[i], j


def _near_pairs(frame: pd.DataFrame, group: np.ndarray, rows: np.ndarray, percent: int, nearest: bool) -> Iterator[np.ndarray]:
    """Pairs that may link in groups of at most SMALL rows, for all groups at once: every pair, or
    of each row the nearest row before it."""
    n, comp, side, names = (frame[c].to_numpy() for c in ("n", "comp", "side", "name"))
    maps = np.frombuffer(b"".join(frame["map"]), dtype=_U64).reshape(len(frame), -1)
    two_sides = np.zeros(len(group), dtype=bool)
    two_sides[group[1:][(group[1:] == group[:-1]) & (side[1:] != side[:-1])]] = True
    least, partner = np.full(len(group), np.iinfo(np.int64).max), np.full(len(group), -1)
    for step in range(1, SMALL):
        a = rows[rows + step < len(group)]
        a = a[group[a] == group[a + step]]
        b = a + step
        a, b = (x[(comp[a] != comp[b]) & ~(two_sides[group[a]] & (side[a] == side[b]))] for x in (a, b))
        ok = 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
        a, b = a[ok], b[ok]
        differ = np.bitwise_count(maps[a] ^ maps[b]).sum(axis=1, dtype=np.int64)
        ok = (100 + percent) * differ <= (100 - percent) * (n[a] + n[b])
        if nearest:
            ok &= differ < least[b]
            least[b[ok]], partner[b[ok]] = differ[ok], a[ok]
        else:
            yield np.stack([np.minimum(names[a[ok]], names[b[ok]]), np.maximum(names[a[ok]], names[b[ok]])], axis=1)
    if nearest:
        b = np.flatnonzero(partner >= 0)
        a = partner[b]
        yield np.stack([np.minimum(names[a], names[b]), np.maximum(names[a], names[b])], axis=1)


def _candidates(percent: int, nearest: bool):
    """Rows sorted by (key, part): the pairs of each block that may link.  A block has
    2 * BLOCK rows at most; the last one of a batch waits for the next."""
    def found(frame: pd.DataFrame) -> Iterator[pa.RecordBatch]:
        if len(frame) < 2:
            return
        key, part = frame["key"].to_numpy(), frame["part"].to_numpy()
        group = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]) | (part[1:] != part[:-1])]))
        size = np.bincount(group)
        out = list(_near_pairs(frame, group, np.flatnonzero(size[group] <= SMALL), percent, nearest))
        for g in np.flatnonzero(size > SMALL):
            block = frame.iloc[np.searchsorted(group, g):np.searchsorted(group, g, side="right")]
            names = block["name"].to_numpy()
            for i, j in _block_pairs(block, percent, nearest):
                out.append(np.stack([np.minimum(names[i], names[j]), np.maximum(names[i], names[j])], axis=1))
        pairs = np.unique(np.concatenate(out), axis=0)
        if len(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        held = None
        for batch in batches:
            frame = batch.to_pandas()
            frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
            if len(frame):
                last = ((frame["key"] == frame["key"].iloc[-1]) & (frame["part"] == frame["part"].iloc[-1])).to_numpy()
                held = frame[last]
                yield from found(frame[~last])
        if held is not None:
            yield from found(held)

    return rows


def _pairs(lists: DataFrame, maps: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Distinct (u, v) of rows (key, part, side, name, n, comp)."""
    rows = lists.join(maps, "name").select("key", "part", "side", "name", "n", "map", "comp").repartition("key", "part").sortWithinPartitions("key", "part", "n", "name")
    return rows.mapInArrow(_candidates(percent, nearest), "u long, v long").distinct()


# ------------------------------------------------------------------------ verification
def _whole(shingle: int):
    """(name, n, wide, text), once per task for repeated rows of one text; wide: a parity map of 8192 bits."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        seen: set[int] = set()
        for batch in batches:
            if len(seen) > 100_000:
                seen.clear()
            texts = batch.column("text")
            for row, sizes, first, h in _sets(texts, shingle):
                names = _classes(sizes, first, h)
                own = [d for d in range(len(sizes)) if int(names[d]) not in seen and not seen.add(int(names[d]))]
                wide = [_maps(sizes[d:d + 1], h[first[d]:first[d + 1]], _WIDE_BITS).tobytes() for d in own]
                yield pa.RecordBatch.from_arrays([pa.array(names[own]), pa.array(sizes[own].astype(np.int64)), pa.array(wide, pa.binary()),
                                                  texts.slice(row, len(sizes)).take(pa.array(own, pa.int64()))], names=["name", "n", "wide", "text"])

    return rows


def _close(percent: int):
    """Pairs that the wide maps cannot rule out."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=_U64).reshape(batch.num_rows, -1) for c in ("a", "b"))
            total = batch.column("m").to_numpy() + batch.column("n").to_numpy()
            differ = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
            yield batch.select(["u", "v"]).filter(pa.array((100 + percent) * differ <= (100 - percent) * total))

    return rows


def _linked(percent: int, shingle: int):
    """Pairs of texts whose whole sets link.  Texts are shipped, not sets: they are smaller."""
    def shingles(texts: pa.Array) -> list[np.ndarray]:
        return [h[first[d]:first[d + 1]] for _, sizes, first, h in _sets(texts, shingle) for d in range(len(sizes))]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch, ok = whole.slice(at, 256), []
                for x, y in zip(shingles(batch.column("a")), shingles(batch.column("b")), strict=True):
                    k = np.searchsorted(x, y)
                    k[k == len(x)] = 0
                    both = int((x[k] == y).sum())
                    ok.append(100 * both >= percent * (len(x) + len(y) - both))
                yield batch.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))

    return rows


def _verified(pairs: DataFrame, whole: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The pairs that link: wide maps are compared first, then the whole texts of what is left."""
    pairs = stored(pairs, "pairs")
    both = lambda p: p.select(F.explode(F.array("u", "v")).alias("name"))
    own = slots.likely(whole.select("name", "n", "wide"), "name", slots.members(both(pairs)))
    a, b = own.toDF("u", "m", "a"), own.toDF("v", "n", "b")
    close = stored(pairs.join(a, "u").join(b, "v").select("u", "v", "m", "n", "a", "b").mapInArrow(_close(percent), "u long, v long"), "close")
    own = slots.likely(whole.select("name", "text"), "name", slots.members(both(close)))
    a, b = own.toDF("u", "a"), own.toDF("v", "b")
    return stored(close.join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(_linked(percent, shingle), "u long, v long").distinct(), "links")


# ------------------------------------------------------------------------ the join
def link(docs: DataFrame, shingle: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, root) of every row; texts whose sets have a Jaccard
    similarity of ``percent`` or more, directly or through others, share a component.  ``root`` names it (null for an empty set)."""
    if not 1 <= percent <= 100:
        raise ValueError(f"percent must be from 1 to 100, not {percent}")
    small_batches(docs.sparkSession)
    lean_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    brief = stored(texts.mapInArrow(_summaries(shingle), "doc_id long, text_hash long, n long, name long, map binary, recurs long"), "sets")
    sets, recurring = brief.filter("recurs is null"), brief.filter("recurs is not null")
    classes = stored(sets.filter("n > 0").groupBy("name").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("map").alias("map")), "classes")
    sizes = classes.groupBy("n").agg(F.count(F.lit(1)).alias("sets")).toPandas()  # one row per size
    total = float((sizes["n"] * sizes["sets"]).sum())
    again = recurring.agg(F.sum("recurs")).first()[0] or 0
    boundary = choose_boundary(sizes, min(1.0, again / max(total, 1.0)), percent)

    posted = texts.mapInArrow(_postings(shingle, percent, _order(recurring), boundary, int(sizes["n"].max()) if len(sizes) else 0), "key long, name long, n long")
    shared = posted.repartition("key").sortWithinPartitions("key", "n", "name").mapInArrow(_shared(percent), "key long, name long, n long, block long")
    lists, maps = stored(shared, "lists"), classes.select("name", "map")
    wanted = lists.select("name").distinct().join(classes, "name").select(F.xxhash64("rep.doc_id", "rep.text_hash").alias("row_key"))
    key = F.xxhash64("doc_id", "text_hash").alias("row_key")
    likely, sets_of = slots.keep(docs.sparkSession.sparkContext.broadcast(slots.members(wanted)), "row_key"), _whole(shingle)
    # a text that is there by chance is never asked for, so no exact join follows
    whole = stored(texts.select(key, "text").mapInArrow(lambda batches: sets_of(likely(batches)), "name long, n long, wide binary, text string"), "listed-texts")

    one = lists.select("key", F.col("block").alias("part"), F.lit(0).alias("side"), "name", "n", F.col("name").alias("comp"))
    near = _verified(_pairs(one, maps, percent, True), whole, percent, shingle)

    roots = components(near).select(F.col("node").alias("name"), "root")
    lists = lists.join(roots, "name", "left").withColumn("comp", F.coalesce("root", "name")).drop("root")
    open_lists = (lists.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.max("block").alias("last"))
                  .filter("a <> b").select("key", "last"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))
    two = (lists.join(open_lists, "key").withColumn("other", other)
           .withColumn("part", F.least("block", "other") * (F.col("last") + 1) + F.greatest("block", "other")).withColumn("side", F.col("block")))
    far = _verified(_pairs(two, maps, percent, False), whole, percent, shingle)

    roots = components(near.unionByName(far)).select(F.col("node").alias("name"), "root")
    classes = classes.select("name", "first_id").join(roots, "name", "left").withColumn("root", F.coalesce("root", "name"))
    least = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = stored(classes.join(least, "root").select(F.col("name").alias("l_name"), "component_id", "root"), "labels")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return (sets.join(labels, (sets.name == labels.l_name) & (sets.n > 0), "left")
            .select("doc_id", "text_hash", F.col("n").alias("n_shingles"), own.alias("component_id"), "root"))


def keep_one(docs: DataFrame, shingle: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id; texts without words stay.

    Only rows that may go are shuffled: those whose (id, text) was not chosen or is there more than once.  The others,
    told by a membership table that lets no such row through, are filtered where they are."""
    linked = stored(link(docs, shingle, percent, id_col, text_col).filter("root is not null").select("doc_id", "text_hash", "root"), "linked")
    row = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    chosen = linked.groupBy("root").agg(F.min(row).alias("r")).select(F.xxhash64("r.doc_id", "r.text_hash").alias("k"), F.lit(True).alias("stays"))
    rows = linked.groupBy(F.xxhash64("doc_id", "text_hash").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    judged = stored(rows.join(chosen.distinct(), "k", "left").filter("stays is null or n > 1").select("k", F.coalesce("stays", F.lit(False)).alias("stays")), "judged")
    key = fresh_name(docs, "row_key")  # of a row's id and text; the same for repeated rows
    # texts without words are in no component, so their keys are not judged
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_col).cast("long"), F.xxhash64(text_col)))
    some, others = slots.apart(keyed, key, judged.select("k"))
    left = some.join(judged.select(F.col("k").alias(key), F.col("stays").alias(key + "s")), key, "left")
    once = left.filter(F.col(key + "s")).dropDuplicates([key]).select(keyed.columns)
    return others.unionByName(left.filter(F.col(key + "s").isNull()).select(keyed.columns)).unionByName(once).drop(key)
