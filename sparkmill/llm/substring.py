"""Substring dedup: words inside passages that occur more than once go.

Level-wise doubling.  The windows asked for have ``window`` words; lengths are
halved down to at least ``shortest`` words (35: 9, 18, 35).  Level one looks
at one gram in each window, the leftmost one of least hash, which equal
windows share; a gram that occurs once anywhere rules out its windows.  The
windows of a gram that is repeated are looked at again at twice the length (the
gram extended to the right, or to the left near the window's end), and so on
until the full window is compared or no candidate survives.  Counts cover all
texts; each level shuffles only what survived the level before.

Hot keys: copies that a task meets within ``SETTLED`` words are settled there, and
one row is sent for each distinct hash, so that a passage of a third of all rows puts
a few rows per task, not one per copy, into the task of its key.  Texts are shuffled
only where a gram survived the first level.

Defined cases: a null or empty text has no words and keeps none; fewer words
than a window: nothing is removed; repeated rows (same id, same text) are
occurrences like any others; null ids are allowed; other columns of the input,
whatever their names, are not read.  Equal windows are told by 64-bit hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmill.llm import slots
from sparkmill.llm import words as W
from sparkmill.llm.store import small_batches, stored

_KIND = W.non_space(lower=False)
SETTLED = 6_000_000
_ROWS = "key long, doc_id long, text_hash long, pos int, length int, n int"


def levels(window: int, shortest: int = 9) -> list[int]:
    """Window lengths from the first level to ``window``: 35 gives 9, 18, 35."""
    out = [window]
    while (out[0] + 1) // 2 >= shortest:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _anchors(w: W.Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word of each window, position of its leftmost gram of least hash)."""
    n = len(w.hash)
    if n < window:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    at = np.arange(n - gram + 1)
    value, where = w.window_hash(at, np.full(len(at), gram)), at
    left = window - gram + 1
    span = 1
    while span < left:
        step = min(span, left - span)
        later = value[step:] < value[:-step]
        value, where = np.where(later, value[step:], value[:-step]), np.where(later, where[step:], where[:-step])
        span += step
    start = np.arange(n - window + 1)
    start = start[w.doc[start] == w.doc[start + window - 1]]
    return start, where[start]


def _parts(start: np.ndarray, anchor: np.ndarray, window: int, gram: int, length: int) -> np.ndarray:
    """First word of the part of ``length`` words by which each window is judged at a level."""
    if length == window:
        return start
    right = anchor + length <= start + window
    return np.where(right, anchor, anchor + gram - length)


def _candidates(parts: np.ndarray, hashes: np.ndarray, ids, text_hash, first_word, doc) -> pa.RecordBatch | None:
    """Rows of a batch: n=1 to be judged, n=2 stands for two or more in this
    batch, n=0 a run of ``length`` parts settled here (its key only spreads rows)."""
    if not len(parts):
        return None
    _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    many = counts[inverse] > 1
    first = np.zeros(len(counts), dtype=np.int64)
    first[inverse[::-1]] = np.arange(len(parts))[::-1]
    lead, single, settled = first[counts > 1], np.flatnonzero(~many), np.flatnonzero(many)
    head = np.flatnonzero(np.concatenate([[True], (np.diff(parts[settled]) != 1) | (np.diff(doc[settled]) != 0)])) if len(settled) else settled
    length = np.concatenate([np.ones(len(lead) + len(single), dtype=np.int64), np.diff(np.append(head, len(settled)))])
    order = np.concatenate([lead, single, settled[head]])
    n = np.repeat([2, 1, 0], [len(lead), len(single), len(head)])
    key = np.where(n == 0, W.mix(hashes[order] + parts[order].astype(np.uint64)), hashes[order])
    row = doc[order]
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), ids.take(pa.array(row)), text_hash.take(pa.array(row)),
                                       pa.array((parts[order] - first_word[row]).astype(np.int32)), pa.array(length.astype(np.int32)), pa.array(n.astype(np.int32))],
                                      names=["key", "doc_id", "text_hash", "pos", "length", "n"])


def _judge(window: int, at: int):
    """mapInArrow function: the candidates of level ``at`` in each text.  Copies are settled within
    ``SETTLED`` words of a task, however Arrow cuts its batches."""
    lengths = levels(window)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, heads, ids, hashes, words, docs = [], [], [], [], 0, 0

        def settled() -> Iterator[pa.RecordBatch]:
            if found:
                parts, h, doc = (np.concatenate(x) for x in zip(*found, strict=True))
                out = _candidates(parts, h, pa.concat_arrays(ids), pa.concat_arrays(hashes), np.concatenate(heads), doc)
                if out is not None:
                    yield out

        for batch in batches:
            for row, data, offsets in W.chunks(batch.column("text")):
                w, n = W.split(data, offsets, _KIND), len(offsets) - 1
                start, anchor = _anchors(w, window, lengths[0])
                if at:  # of the level before, only windows whose part is repeated go on
                    keep = _alive(batch, row, n, w, len(w.hash))[_parts(start, anchor, window, lengths[0], lengths[at - 1])]
                    start, anchor = start[keep], anchor[keep]
                part = np.unique(_parts(start, anchor, window, lengths[0], lengths[at]))
                found.append((part + words, w.window_hash(part, np.full(len(part), lengths[at])), w.doc[part] + docs))
                heads.append(w.first[:-1] + words)
                ids.append(batch.column("doc_id").slice(row, n))
                hashes.append(batch.column("text_hash").slice(row, n))
                words, docs = words + len(w.hash), docs + n
                if words >= SETTLED:
                    yield from settled()
                    found, heads, ids, hashes, words, docs = [], [], [], [], 0, 0
        yield from settled()

    return rows


def _alive(batch: pa.RecordBatch, row: int, n: int, w: W.Words, size: int) -> np.ndarray:
    """Mask over the words of rows row..row+n: where a surviving part begins."""
    runs = batch.column("runs").slice(row, n)
    flat = runs.flatten()
    pos, length = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
    count = runs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    at = pos + np.repeat(w.first[:-1], count)
    edge = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + length, -1)
    return np.cumsum(edge[:-1]) > 0


_FOUND = ["doc_id", "text_hash", "pos", "length"]


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: those whose key counts twice or more, and settled
    runs.  A key's count goes on over batches; one row is held back at most."""
    last, total, held = None, 0, None
    for batch in batches:
        key, n = batch.column("key").to_numpy(), batch.column("n").to_numpy()
        if not len(key):
            continue
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sums = np.add.reduceat(n, head).astype(np.int64)
        if key[0] == last:
            sums[0] += total
            if held is not None and sums[0] >= 2:
                yield held
                held = None
        else:
            held = None
        run = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(key))))
        yield batch.filter(pa.array((n == 0) | ((n == 1) & (sums[run] >= 2)))).select(_FOUND)
        if len(head) > 1:
            held = None
        alone = np.flatnonzero((n == 1) & (run == len(head) - 1))
        if sums[-1] < 2 and len(alone):
            held = batch.slice(int(alone[0]), 1).select(_FOUND)
        last, total = key[-1], int(sums[-1])


def _survivors(candidates: DataFrame) -> DataFrame:
    """Surviving parts of each text: (doc_id, text_hash, runs)."""
    found = (candidates.repartition("key").sortWithinPartitions("key")
             .mapInArrow(_repeated, "doc_id long, text_hash long, pos int, length int"))
    return found.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("pos", "length")).alias("runs"))


def _joined(texts: DataFrame, survivors: DataFrame, how: str) -> DataFrame:
    s = survivors.select(F.col("doc_id").alias("s_doc_id"), F.col("text_hash").alias("s_text_hash"), "runs")
    return (texts.join(s, texts.doc_id.eqNullSafe(s.s_doc_id) & (texts.text_hash == s.s_text_hash), how)
            .select("doc_id", "text_hash", "text", "runs"))


_RUNS = pa.list_(pa.struct([("pos", pa.int32()), ("length", pa.int32())]))


def _without_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.append_column("runs", pa.nulls(batch.num_rows, _RUNS))


def _cut(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, removed, digests, kept_texts = [], [], [], []
            for row, data, offsets in W.chunks(batch.column("text")):
                w = W.split(data, offsets, _KIND)
                alive = _alive(batch, row, len(offsets) - 1, w, len(w.hash))
                covered = np.zeros(len(w.hash) + 1, dtype=np.int64)
                hit = np.flatnonzero(alive)
                np.add.at(covered, hit, 1)
                np.add.at(covered, hit + window, -1)
                gone = np.cumsum(covered[:-1]) > 0
                kept = np.flatnonzero(~gone)
                # bytes of kept words, and one blank behind each but the last of a text
                edge = np.zeros(len(data) + 1, dtype=np.int8)
                edge[w.start[kept]] += 1
                edge[w.end[kept]] -= 1
                take = np.cumsum(edge[:-1], dtype=np.int8) > 0
                last = np.ones(len(kept), dtype=bool)
                last[:-1] = w.doc[kept[1:]] != w.doc[kept[:-1]]
                gap = w.end[kept[~last]]
                take[gap] = True
                plain = data.copy()
                plain[gap] = 32
                size = np.concatenate([[0], np.cumsum(take)])[offsets]
                out = plain[take].tobytes()
                for d in range(len(offsets) - 1):
                    piece = out[size[d]:size[d + 1]]
                    kept_texts.append(piece.decode("utf-8"))
                    digests.append(hashlib.sha256(piece).hexdigest())
                n_words.append(w.counts)
                removed.append(np.bincount(w.doc[gone], minlength=len(offsets) - 1))
            if n_words:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(np.concatenate(n_words).astype(np.int64)),
                     pa.array(np.concatenate(removed).astype(np.int64)), pa.array(digests, pa.string()), pa.array(kept_texts, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return rows


def drop_repeated_passages(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) of every row of ``docs``.

    A word goes if a window of ``window`` words over it also starts anywhere
    else, in this text or another; all occurrences go."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    row = F.xxhash64("doc_id", "text_hash").alias("row_key")
    survivors = stored(_survivors(texts.mapInArrow(_judge(window, 0), _ROWS)), "grams")
    found = docs.sparkSession.sparkContext.broadcast(slots.members(survivors.select(row)))
    keyed = texts.withColumn("row_key", row)
    some = keyed.mapInArrow(slots.keep(found, "row_key"), keyed.schema).drop("row_key")  # only these texts are shuffled
    for at in range(1, len(levels(window))):
        survivors = _survivors(_joined(some, survivors, "inner").mapInArrow(_judge(window, at), _ROWS))
    others, cut = slots.keep(found, "row_key", others=True), _cut(window)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    whole = keyed.mapInArrow(lambda batches: cut(_without_runs(others(batches))), schema)
    return _joined(some, survivors, "left").mapInArrow(cut, schema).unionByName(whole)
