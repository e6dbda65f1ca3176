"""Quality classifier: supervised subword embeddings.

A document is the mean of the vectors of its words, of their character 3- to 5-grams
and of its word pairs (a repeated word pairs with a mark, so that repetition is a
feature of its own), all hashed to ``BUCKETS`` rows of one table.  A softmax layer follows.
Table and layer are learned together by minibatch gradient descent in numpy, on a bounded
sample (``PER_CLASS`` texts per class of at most ``sample.MOST_BYTES`` bytes, outside the
held-out fold).

To score, the layer is folded into the table: the difference of the two logits is a sum of
one number per bucket.  Word and character parts are summed once per distinct word.

Defined cases: null and empty texts have no features and score the layer's bias; with labels of
one class or none the score is the share of label 1; repeated rows are scored each; further
columns, whatever their names, are not read."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmill.llm import words as W
from sparkmill.llm.sample import held_out, training_texts

PER_CLASS = (2500, 2500)
BUCKETS, DIM, EPOCHS, BATCH, RATE = 1 << 17, 8, 6, 16, 0.4
GRAMS = (3, 4, 5)
THRESHOLD = 0.3
_KIND = W.non_space(lower=False)
_SAME = np.uint64(0x5A17)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - 17)).astype(np.int64)


def _subwords(w: W.Words, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct word number, bucket) of the words at ``first`` and of their character grams, ``<word>``."""
    size = w.end[first] - w.start[first]
    edge = np.concatenate([[0], np.cumsum(size + 2)])
    chars = np.full(edge[-1], ord(">"), dtype=np.uint8)
    inside = np.repeat(edge[:-1] + 1 - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    chars[inside] = w.data[np.repeat(w.start[first] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())]
    chars[edge[:-1]] = ord("<")
    owner = np.repeat(np.arange(len(first)), size + 2)
    parts = [(np.arange(len(first)), _bucket(w.hash[first]))]
    for n in GRAMS:
        at = np.arange(max(0, len(chars) - n + 1))
        at = at[owner[at] == owner[at + n - 1]]
        h = np.full(len(at), n, dtype=np.uint64)
        for j in range(n):
            h = W.mix(h ^ chars[at + j].astype(np.uint64))
        parts.append((owner[at], _bucket(h)))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _pairs(w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of neighbouring words."""
    at = np.arange(max(0, len(w.hash) - 1))
    at = at[w.doc[at] == w.doc[at + 1]]
    a, b = w.hash[at], w.hash[at + 1]
    return w.doc[at], _bucket(W.mix(np.where(a == b, _SAME, W.mix(a) + b)))


def _distinct(w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    _, first, which = np.unique(w.hash, return_index=True, return_inverse=True)
    return first, which


def _features(array: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, weights summing to 1) of each text, for training."""
    out = []
    for _, data, offsets in W.chunks(array):
        w = W.split(data, offsets, _KIND)
        first, which = _distinct(w)
        owner, bucket = _subwords(w, first)
        order = np.argsort(owner, kind="stable")
        bucket, cut = bucket[order], np.searchsorted(owner[order], np.arange(len(first) + 1))
        pair_doc, pair_bucket = _pairs(w)
        pair_cut = np.searchsorted(pair_doc, np.arange(len(offsets)))
        for d in range(len(offsets) - 1):
            names, times = np.unique(which[w.first[d]:w.first[d + 1]], return_counts=True)
            size = cut[names + 1] - cut[names]
            at = np.repeat(cut[names] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(names) else names
            pairs = pair_bucket[pair_cut[d]:pair_cut[d + 1]]
            all_buckets = np.concatenate([bucket[at], pairs])
            share = np.concatenate([np.repeat(times / np.maximum(size, 1) / max(1, times.sum()), size), np.full(len(pairs), 1 / max(1, len(pairs)))])
            b, inverse = np.unique(all_buckets, return_inverse=True)
            out.append((b, np.bincount(inverse, weights=share, minlength=len(b)).astype(np.float32)))
    return out


@dataclass
class Model:
    """``table[b]``: what bucket b adds to the difference of the logits."""

    table: np.ndarray
    bias: float

    def score(self, array: pa.Array) -> np.ndarray:
        out = []
        for _, data, offsets in W.chunks(array):
            w, n = W.split(data, offsets, _KIND), len(offsets) - 1
            first, which = _distinct(w)
            owner, bucket = _subwords(w, first)
            size = np.bincount(owner, minlength=len(first))
            word = np.bincount(owner, weights=self.table[bucket], minlength=len(first)) / np.maximum(size, 1)
            logit = np.bincount(w.doc, weights=word[which], minlength=n) / np.maximum(w.counts, 1)
            doc, pair = _pairs(w)
            logit += np.bincount(doc, weights=self.table[pair], minlength=n) / np.maximum(np.bincount(doc, minlength=n), 1)
            out.append(1 / (1 + np.exp(-np.clip(logit + self.bias, -30, 30))))
        return np.concatenate(out) if out else np.zeros(0)


def train(features: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, weight: np.ndarray, seed: int = 0) -> Model:
    """Minibatch gradient descent on the softmax loss; rates fall linearly."""
    rng = np.random.default_rng(seed)
    table = (rng.random((BUCKETS, DIM), dtype=np.float32) - 0.5) / DIM
    layer, bias = np.zeros((DIM, 2), dtype=np.float32), np.zeros(2, dtype=np.float32)
    steps, step = EPOCHS * -(-len(y) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            rows = order[at:at + BATCH]
            rate, step = RATE * (1 - step / steps), step + 1
            buckets, shares = np.concatenate([features[i][0] for i in rows]), np.concatenate([features[i][1] for i in rows])
            doc = np.repeat(np.arange(len(rows)), [len(features[i][0]) for i in rows])
            gathered = table[buckets]
            hidden = np.stack([np.bincount(doc, weights=gathered[:, k] * shares, minlength=len(rows)) for k in range(DIM)], axis=1)
            z = hidden @ layer + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= weight[rows, None]
            back = (p @ layer.T).astype(np.float32)
            layer -= rate / len(rows) * (hidden.T @ p).astype(np.float32) * 10
            bias -= rate / len(rows) * p.sum(axis=0).astype(np.float32)
            np.subtract.at(table, buckets, rate * 10 * shares[:, None] * back[doc])
    return Model((table @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: tuple[int, int] = PER_CLASS) -> Model:
    table, counts = training_texts(docs, labels, label, per_class)
    y = table.column("label").to_numpy()
    share = counts[1] / max(1, sum(counts))
    if len(np.unique(y)) < 2:
        logit = np.log(max(share, 1e-9) / max(1 - share, 1e-9)) if sum(counts) else -30.0
        return Model(np.zeros(BUCKETS, dtype=np.float32), float(logit))
    weight = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum())
    return train(_features(table.column("text")), y, weight / weight.mean())


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` ids with (held_out, score, predicted), every text whole."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = sent.value.score(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    lean = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return lean.mapInArrow(rows, "doc_id long, held_out boolean, score double, predicted int")
