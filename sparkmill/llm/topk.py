"""Exact top-k search by distributed histogram selection.

Vectors become integers, so scores are exact.  Every query is scored against
every row, in blocks of a bounded number of queries.  Each pass counts, per
query, the scores that fall into the bins of its current range; the summed
histogram tells the bin of the kth value, which is the next range, until a bin is
one score wide.  A task sends its bins from the top down to where its own count
reaches what is wanted: the kth value cannot lie below.  The last pass returns all
scores above the kth value and, of those equal to it, each task's smallest ids up to
the number wanted, which holds every one that can be chosen; a window ranks them.

Defined cases: null vectors, vectors that hold a null or a non-finite component,
and null ids take no part; lengths that differ are filled with zeros; rows of one id
are rows of their own, a query excludes only itself; fewer than k rows give all;
further columns, whatever their names, are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmill.llm.store import stored

BINS = 256
QUERY_BLOCK = 4096
_ROWS = 2048
_QUERIES = 512
_EXACT = float(1 << 53)
_RESULT = "query_uid long, query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """(uid, vec_id, ints) of the rows that take part; ints are floor(scale * x), 64-bit little-endian."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.and_(pc.is_valid(batch.column("vec_id")), pc.is_valid(batch.column("v"))))
            lists = batch.column("v")
            flat = lists.flatten()
            size = np.diff(np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64))
            edge = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
            x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null becomes NaN
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            ok = np.flatnonzero(bad[edge[1:]] == bad[edge[:-1]])
            ints = np.floor(scale * np.where(np.isfinite(x), x, 0.0)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(ok)), pa.array([ints[edge[i]:edge[i + 1]].tobytes() for i in ok], pa.binary())],
                                             names=["vec_id", "ints"])

    lean = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    out = lean.mapInArrow(rows, "vec_id long, ints binary").withColumn("uid", F.monotonically_increasing_id())
    return stored(out, "vectors")


def _matrix(packed: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(packed), width))
    for i, x in enumerate(packed):
        v = np.frombuffer(x, dtype=np.int64)[:width]
        out[i, :len(v)] = v
    return out


class _Queries:
    def __init__(self, uid: np.ndarray, vec_id: np.ndarray, packed: list[bytes]):
        self.uid, self.vec_id = uid, vec_id
        self.matrix = _matrix(packed, max([0, *(len(x) // 8 for x in packed)]))

    def scores(self, batches: Iterator[pa.RecordBatch]):
        """(query slice, row uids, row ids, int64 scores, own-row mask) block by block."""
        top = np.abs(self.matrix).max(initial=0) * max(1, self.matrix.shape[1])
        for batch in batches:
            uid, vec_id, packed = batch.column("uid").to_numpy(), batch.column("vec_id").to_numpy(), batch.column("ints")
            for r in range(0, len(uid), _ROWS):
                part = slice(r, r + _ROWS)
                rows = _matrix(packed.slice(r, _ROWS).to_pylist(), self.matrix.shape[1])
                exact = top * np.abs(rows).max(initial=0) < _EXACT
                for q in range(0, len(self.uid), _QUERIES):
                    own = slice(q, q + _QUERIES)
                    a = self.matrix[own]
                    s = (a @ rows.T if exact else a.astype(np.int64) @ rows.astype(np.int64).T).astype(np.int64)
                    yield own, vec_id[part], s, self.uid[own][:, None] == uid[part][None, :]


def _histograms(queries: _Queries, low: np.ndarray, high: np.ndarray, width: np.ndarray, want: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(queries.uid), BINS), dtype=np.int64)
        for own, _, score, self_row in queries.scores(batches):
            bins = (score - low[own, None]) // width[own, None]
            ok = (bins >= 0) & (score < high[own, None]) & ~self_row
            flat = (np.arange(score.shape[0])[:, None] * BINS + bins)[ok]
            counts[own] += np.bincount(flat, minlength=score.shape[0] * BINS).reshape(-1, BINS)
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        q, b = np.nonzero((counts > 0) & (above < want[:, None]))
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(b), pa.array(counts[q, b])], names=["q", "bin", "n"])

    return rows


def _chosen(queries: _Queries, kth: np.ndarray, ties: np.ndarray):
    """All scores above the kth value, and each task's smallest ids among those equal to it."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for own, vec_id, score, self_row in queries.scores(batches):
            limit = kth[own, None]
            q, r = np.nonzero((score > limit) & ~self_row)
            yield _rows(queries, q + own.start, vec_id[r], score[q, r])
            q, r = np.nonzero((score == limit) & ~self_row)
            for i, at in zip(*np.unique(q, return_index=True), strict=True):
                ids = vec_id[r[at:at + np.count_nonzero(q == i)]]
                i = int(i) + own.start
                kept[i] = np.sort(np.concatenate([kept.get(i, ids[:0]), ids]))[:ties[i]]
        for i, ids in kept.items():
            yield _rows(queries, np.full(len(ids), i), ids, np.full(len(ids), kth[i]))

    return rows


def _rows(queries: _Queries, q: np.ndarray, vec_id: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(queries.uid[q]), pa.array(queries.vec_id[q]), pa.array(vec_id), pa.array(score)],
                                      names=["query_uid", "query_id", "vec_id", "score"])


def _select(vectors: DataFrame, queries: _Queries, bound: np.ndarray, k: int) -> DataFrame:
    """Candidates of a block of queries; ``bound``: no score is larger in size."""
    n = len(queries.uid)
    low, high, want = -bound, bound + 1, np.full(n, k, dtype=np.int64)
    done = np.zeros(n, dtype=bool)  # fewer rows than wanted: all are taken
    while True:
        width = np.maximum(1, -(-(high - low) // BINS))
        got = (vectors.mapInArrow(_histograms(queries, low, high, width, want), "q long, bin long, n long")
               .groupBy("q", "bin").agg(F.sum("n").alias("n")).toPandas())
        counts = np.zeros((n, BINS), dtype=np.int64)
        counts[got["q"].to_numpy(dtype=np.int64), got["bin"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.int64)
        from_top = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1]
        done |= from_top[:, 0] < want
        at = np.where(done, 0, BINS - 1 - np.argmax(from_top[:, ::-1] >= want[:, None], axis=1))
        rest = want - (from_top - counts)[np.arange(n), at]
        want = np.where(done, want, rest)
        low = np.where(done, low, low + at * width)
        high = np.where(done, high, np.minimum(high, low + width))
        if (done | (width == 1)).all():
            break
    kth = np.where(done, -bound - 1, low)
    return vectors.mapInArrow(_chosen(queries, kth, np.where(done, 0, want)), _RESULT)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest inner product with each
    query of ``quantised`` vectors, ties to the smaller id, the query itself left out."""
    queries = vectors.filter(is_query)
    n = queries.count()
    parts = 1 + max(0, n - 1) // query_block

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([float(np.sqrt((np.frombuffer(x, dtype=np.int64).astype(float) ** 2).sum())) for x in batch.column("ints").to_pylist()], pa.float64())], names=["norm"])

    longest = vectors.select("ints").mapInArrow(norms, "norm double").agg(F.max("norm")).first()[0] or 0.0
    out = None
    for p in range(parts):
        block = queries.filter(F.pmod(F.xxhash64("uid"), F.lit(parts)) == p).toPandas() if parts > 1 else queries.toPandas()
        q = _Queries(block["uid"].to_numpy(dtype=np.int64), block["vec_id"].to_numpy(dtype=np.int64), [bytes(x) for x in block["ints"]])
        bound = np.ceil(np.sqrt((q.matrix ** 2).sum(axis=1)) * longest * (1 + 1e-9) + 1).astype(np.int64)
        found = _select(vectors, q, bound, k)
        out = found if out is None else out.unionByName(found)
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
