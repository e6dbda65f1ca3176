"""Toxicity by compression distance.

Two zstandard dictionaries are trained on a bounded sample of labelled documents
(``TOXIC_DOCS`` and ``ORDINARY_DOCS`` texts of at most ``sample.MOST_BYTES`` bytes, outside
the held-out fold).  The ordinary dictionary is trained by zstandard on windows of
ordinary texts.  The toxic one holds the strings that toxic texts are marked by: words
far likelier in toxic documents, the commonest last, before the same ordinary content;
ordinary windows then compress alike under both, and what is left of the difference
is due to toxic strings.  (zstandard's own trainer left half of those strings out.)
Near copies in the sample count once.  Two more bounds: the ordinary dictionary is trained on at most
``ORDINARY_WINDOWS`` windows drawn from the sample, and the toxic one keeps at most ``MOST_STRINGS``
words, each in ``LEAST_DOCS`` texts and ``LEAST_SHARE`` of the toxic half; rarer ones are not learned.

Every text is cut into windows of whole words of about ``WINDOW`` bytes.  The
distance of a window is its compressed length under the ordinary dictionary less that
under the toxic one; a fixed tail that both dictionaries hold keeps short windows from
being stored raw.  The largest distance, the share of windows beyond the window threshold
and the mean excess feed a logistic curve whose weights, the calibrated thresholds, are
fitted on the half of the sample that trained no dictionary.

Defined cases: null and empty texts have no windows and get the curve's value for none; with
labels of one class or none the score is the share of toxic labels; repeated rows are scored
each; further columns, whatever their names, are not read."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmill.llm import words as W
from sparkmill.llm.sample import held_out, training_texts
from sparkmill.llm.store import give_back, lean_batches

TOXIC_DOCS, ORDINARY_DOCS = 3000, 6000
WINDOW, LEVEL, DICTIONARY, TAIL = 24, 7, 4096, 96
LEAST_LOG_ODDS, LEAST_SHARE, LEAST_DOCS, MOST_STRINGS = 3.5, 0.004, 3, 2000
ORDINARY_WINDOWS = 40_000
WINDOW_LIMIT = 3
_KIND = W.non_space(lower=True)


def _lower(data: np.ndarray) -> bytes:
    return _KIND.fold[data].tobytes()


def _windows(w: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start byte, end byte, text) of runs of whole words that begin in one stretch of WINDOW bytes."""
    stretch = (w.start - w.offsets[w.doc]) // WINDOW
    head = np.flatnonzero(np.concatenate([[True], (stretch[1:] != stretch[:-1]) | (w.doc[1:] != w.doc[:-1])])) if len(stretch) else stretch
    return w.start[head], w.end[np.append(head[1:], len(stretch)) - 1] if len(head) else head, w.doc[head]


def _words(array: pa.Array, grams: int = 8, hashes: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hash, text) of the distinct words of each text, and min-hashes of its word grams."""
    pairs, least = [np.zeros((2, 0), dtype=np.uint64)], np.full((hashes, len(array)), np.iinfo(np.uint64).max, dtype=np.uint64)
    for row, data, offsets in W.chunks(array):
        w = W.split(data, offsets, _KIND)
        at, h = w.windows(grams)
        for j in range(hashes):
            np.minimum.at(least[j], w.doc[at] + row, W.mix(h + np.uint64(j)))
        order = np.lexsort((w.hash, w.doc))
        h, d = w.hash[order], w.doc[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])]) if len(h) else np.zeros(0, dtype=bool)
        pairs.append(np.stack([h[new], (d[new] + row).astype(np.uint64)]))
    word, doc = np.concatenate(pairs, axis=1)
    return word, doc.astype(np.int64), least


def _apart(least: np.ndarray) -> np.ndarray:
    """Mask of texts that share none of their min-hashes with an earlier text."""
    none = np.iinfo(np.uint64).max
    keep, seen = np.ones(least.shape[1], dtype=bool), [set() for _ in least]
    for d, mine in enumerate(least.T.tolist()):
        if mine[0] != none:
            keep[d] = not any(m in s for m, s in zip(mine, seen, strict=True))
            for m, s in zip(mine, seen, strict=True):
                s.add(m)
    return keep


def _toxic_strings(toxic: pa.Array, ordinary: pa.Array) -> bytes:
    """The marked words of toxic texts, the commonest last; near copies count once."""
    word_t, doc_t, least_t = _words(toxic)
    word_o, doc_o, least_o = _words(ordinary)
    keep_t, keep_o = _apart(least_t), _apart(least_o)
    (names, n_toxic), (others, n_other) = (np.unique(w[k[d]], return_counts=True) for w, d, k in ((word_t, doc_t, keep_t), (word_o, doc_o, keep_o)))
    at = np.searchsorted(others, names)
    at[at == len(others)] = 0
    other = np.where(others[at] == names, n_other[at], 0) if len(others) else np.zeros(len(names))
    odds = np.log((n_toxic + .5) / max(1, keep_t.sum())) - np.log((other + .5) / max(1, keep_o.sum()))
    marked = np.flatnonzero((odds >= LEAST_LOG_ODDS) & (n_toxic >= max(LEAST_DOCS, LEAST_SHARE * keep_t.sum())))
    marked = marked[np.argsort(-n_toxic[marked], kind="stable")][:MOST_STRINGS]
    counts = dict(zip(names[marked].tolist(), n_toxic[marked].tolist(), strict=True))
    found: dict[bytes, int] = {}
    for _, data, offsets in W.chunks(toxic):
        w, low = W.split(data, offsets, _KIND), _lower(data)
        for i in np.flatnonzero(np.isin(w.hash, names[marked])):
            times = counts.pop(int(w.hash[i]), 0)  # each word once
            if times:
                string = low[w.start[i]:w.end[i]].strip(b".,;:!?")
                found[string] = found.get(string, 0) + times
    return b" ".join(x for x, _ in sorted(found.items(), key=lambda x: (x[1], x[0])))


def _ordinary_content(ordinary: pa.Array) -> bytes:
    windows: list[bytes] = []
    for _, data, offsets in W.chunks(ordinary):
        start, end, _ = _windows(W.split(data, offsets, _KIND))
        low = _lower(data)
        windows += [b" " + low[a:b] + b" " for a, b in zip(start, end, strict=True)]
    samples = [windows[i] for i in np.random.default_rng(0).permutation(len(windows))[:ORDINARY_WINDOWS]]
    try:
        trained = zs.train_dictionary(DICTIONARY, samples, level=LEVEL).as_bytes()
    except zs.ZstdError:  # too few samples to train on: the samples themselves
        trained = b"".join(samples)
    return (b" " * TAIL + trained)[-DICTIONARY:]


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    weights: np.ndarray | None
    share: float

    def distances(self):
        """Function from windows to distances; made once in each process that scores."""
        def compressor(content):
            params = zs.ZstdCompressionParameters.from_level(LEVEL, source_size=WINDOW + TAIL, dict_size=len(self.toxic) + len(self.ordinary), min_match=3,
                                                             write_content_size=False, write_checksum=False, write_dict_id=False)
            d = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            return zs.ZstdCompressor(dict_data=d, compression_params=params).compress

        a, b = compressor(self.ordinary), compressor(b" " + self.toxic + b" " + self.ordinary)
        tail = b" " + self.ordinary[-TAIL:-1]

        def each(windows: Iterator[bytes]) -> np.ndarray:
            out = []
            for x in windows:
                x = b" " + x + tail
                out.append(len(a(x)) - len(b(x)))
            return np.array(out, dtype=np.int64)

        return each

    def features(self, array: pa.Array, distances) -> np.ndarray:
        """Per text: 1, largest distance, log share and mean of what lies beyond, log of the number of windows."""
        out = []
        for _, data, offsets in W.chunks(array):
            start, end, doc = _windows(W.split(data, offsets, _KIND))
            low, n = _lower(data), len(offsets) - 1
            d = distances(low[x:y] for x, y in zip(start, end, strict=True))
            top = np.zeros(n)
            np.maximum.at(top, doc, np.minimum(d, 12))
            windows = np.bincount(doc, minlength=n)
            beyond = np.bincount(doc, weights=d >= WINDOW_LIMIT, minlength=n)
            excess = np.bincount(doc, weights=np.maximum(d - 1, 0), minlength=n) / np.maximum(windows, 1)
            out.append(np.stack([np.ones(n), top, np.log1p(100 * beyond / np.maximum(windows, 1)), np.log1p(100 * excess), np.log1p(windows)], axis=1))
        return np.concatenate(out) if out else np.zeros((0, 5))

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), self.share)
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - ridge * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", toxic_docs: int = TOXIC_DOCS, ordinary_docs: int = ORDINARY_DOCS) -> Model:
    table, counts = training_texts(docs, labels, label, (ordinary_docs, toxic_docs))
    y = table.column("label").to_numpy()
    share = counts[1] / max(1, sum(counts))
    texts = table.column("text").combine_chunks() if len(y) else pa.array([], pa.string())
    if len(np.unique(y)) < 2:
        return Model(b"", b" " * (TAIL + 1), None, share)
    rank = np.empty(len(y), dtype=np.int64)  # order within the class
    for c in (0, 1):
        rank[y == c] = np.arange((y == c).sum())
    learn = rank % 2 == 0
    take = lambda m: texts.take(pa.array(np.flatnonzero(m)))
    ordinary = take(learn & (y == 0))
    model = Model(_toxic_strings(take(learn & (y == 1)), ordinary), _ordinary_content(ordinary), None, share)
    rest = ~learn if len(np.unique(y[~learn])) == 2 else np.ones(len(y), dtype=bool)
    x = model.features(take(rest), model.distances())
    weight = np.where(y[rest] == 1, counts[1] / max(1, (y[rest] == 1).sum()), counts[0] / max(1, (y[rest] == 0).sum()))
    model.weights = _logistic(x, y[rest], weight / weight.mean())
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` ids with (held_out, score, predicted), every text whole."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of a few KB

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distances = sent.value.distances()
        for batch in batches:
            s = sent.value.score(sent.value.features(batch.column("text"), distances))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    lean = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return lean.mapInArrow(rows, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not predicted toxic."""
    lean_batches(docs.sparkSession)
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        distances = sent.value.distances()
        for batch in batches:
            s = sent.value.score(sent.value.features(batch.column(at), distances))
            yield batch.filter(pa.array(s < 0.5))

    return docs.mapInArrow(rows, docs.schema)
