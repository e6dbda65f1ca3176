"""Benchmark decontamination with a positional inverted index of the documents.

``build_index`` stores, for each document, the posting lists of its words:
the distinct term hashes, how often each occurs, and the positions.  Only terms
whose bit is set in a 2**25-bit map of the test terms are kept (a fixed 4 MB,
whatever the size of the test set; a chance hit costs space only).  Index rows
stay in the partition of their document, so no posting is ever shuffled.

``search`` takes the test items in blocks of bounded bytes.  For each block it
counts the block's terms over the whole index, then intersects in each
partition the lists of every test window, shifted by their offsets, from the
rarest term on; what survives all terms is an exact phrase match.
``proximity`` asks instead that all terms stand near an occurrence of the
rarest.  Hits are added to the document's row block by block.

Defined cases: null or empty texts have no words and no hits; items without
words match nothing; an item shorter than the window is one window; repeated
document rows are judged each; rows of one item id count as one item, a null
item id as ``null``; further columns, whatever their names, are not read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmill.llm import slots
from sparkmill.llm import words as W
from sparkmill.llm.store import fresh_name, give_back, lean_batches, stored

_KIND = W.alphanumeric(lower=True)
_BITS = 25
BLOCK_BYTES = 16 << 20
_INDEX = "doc_id long, n_words long, terms binary, counts binary, positions binary, hits binary, items array<string>"


def _slot(terms: np.ndarray) -> np.ndarray:
    return (terms >> np.uint64(64 - _BITS)).astype(np.int64)


def _term_map(items: DataFrame) -> np.ndarray:
    """Bit map of the terms of all items, gathered as slots of a fixed range."""
    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in W.chunks(batch.column("text")):
                slot = np.unique(_slot(W.split(data, offsets, _KIND).hash))
                byte, first = np.unique(slot >> 3, return_index=True)
                bits = np.bitwise_or.reduceat(1 << (slot & 7), first) if len(slot) else slot
                yield pa.RecordBatch.from_arrays([pa.array(byte), pa.array(bits)], names=["byte", "bits"])

    byte = items.mapInArrow(bytes_of, "byte long, bits long").groupBy("byte").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(1 << (_BITS - 3), dtype=np.uint8)
    out[byte["byte"].to_numpy(dtype=np.int64)] = byte["bits"].to_numpy(dtype=np.uint8)
    return out


def build_index(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                item_text_col: str = "text") -> DataFrame:
    """One row per document with the posting lists of the terms that ``items`` may hold."""
    lean_batches(docs.sparkSession)
    bits = _term_map(items.select(F.col(item_text_col).alias("text")))

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            for row, data, offsets in W.chunks(batch.column("text")):
                w = W.split(data, offsets, _KIND)
                n, slot = len(offsets) - 1, _slot(w.hash)
                at = np.flatnonzero(bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
                at = at[np.lexsort((w.hash[at], w.doc[at]))]  # stable: positions ascend within a list
                doc, term = w.doc[at], w.hash[at]
                head = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])])) if len(at) else at
                count = np.diff(np.append(head, len(at))).astype(np.uint32)
                pos = (at - w.first[doc]).astype(np.uint32)
                lists, entries = np.searchsorted(doc[head], np.arange(n + 1)), np.searchsorted(doc, np.arange(n + 1))
                cut = lambda x, where: pa.array([x[where[i]:where[i + 1]].tobytes() for i in range(n)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, n), pa.array(w.counts.astype(np.int64)), cut(term[head], lists), cut(count, lists),
                     cut(pos, entries), pa.array([b""] * n, pa.binary()), pa.array([[]] * n, pa.list_(pa.string()))],
                    names=["doc_id", "n_words", "terms", "counts", "positions", "hits", "items"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stored(texts.mapInArrow(postings, _INDEX), "postings")


@dataclass
class _Block:
    """Distinct windows of some items: ``terms[i]`` are the word hashes of window i."""

    terms: list[np.ndarray]
    items: list[tuple[str, ...]]

    @property
    def vocabulary(self) -> np.ndarray:
        return np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *self.terms]))


def _block(rows: pa.Table, window: int) -> _Block:
    terms: dict[int, np.ndarray] = {}
    items: dict[int, set[str]] = {}
    names = rows.column("item_id").to_pylist()
    for batch_row, data, offsets in W.chunks(rows.column("text")):
        w = W.split(data, offsets, _KIND)
        short = w.first[:-1][(w.counts < window) & (w.counts > 0)]
        at = np.concatenate([w.windows(window)[0], short])
        length = np.minimum(window, w.counts[w.doc[at]]) if len(at) else at
        for i, n, h in zip(at, length, w.window_hash(at, length), strict=True):
            terms.setdefault(int(h), w.hash[i:i + n])
            items.setdefault(int(h), set()).add(names[batch_row + w.doc[i]])
    return _Block(list(terms.values()), [tuple(sorted(x)) for x in items.values()])


def _blocks(items: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int) -> Iterator[_Block]:
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + int(total) // block_bytes
    for k in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield _block(part.toArrow(), window)


def _lists(batch: pa.RecordBatch, gap: int):
    """The posting lists of a batch as one index: terms, where their lists begin,
    and positions in one numbering, with a gap between documents."""
    cat = lambda name, kind: np.frombuffer(b"".join(x for x in batch.column(name).to_pylist()), dtype=kind)
    n_words = batch.column("n_words").to_numpy()
    base = np.concatenate([[0], np.cumsum(n_words + gap)])
    terms, counts, pos = cat("terms", np.uint64), cat("counts", np.uint32), cat("positions", np.uint32).astype(np.int64)
    sizes = np.array([len(x) // 4 for x in batch.column("positions").to_pylist()], dtype=np.int64)
    pos = pos + np.repeat(base[:-1], sizes)
    each = np.repeat(terms, counts)
    order = np.argsort(each, kind="stable")  # documents come in order, so positions ascend
    each, pos = each[order], pos[order]
    names, first = np.unique(each, return_index=True)
    return names, np.append(first, len(each)), pos, base


def _has(found: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.searchsorted(found, wanted)
    at[at == len(found)] = 0
    return found[at] == wanted


def _term_counts(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Occurrences of each term of the vocabulary in all documents."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            terms = np.frombuffer(b"".join(batch.column("terms").to_pylist()), dtype=np.uint64)
            n = np.frombuffer(b"".join(batch.column("counts").to_pylist()), dtype=np.uint32)
            at = np.searchsorted(vocabulary, terms)
            at[at == len(vocabulary)] = 0
            ok = vocabulary[at] == terms if len(vocabulary) else np.zeros(len(terms), dtype=bool)
            total += np.bincount(at[ok], weights=n[ok], minlength=len(vocabulary)).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["slot", "n"])

    got = (index.select("terms", "counts").mapInArrow(counts, "slot long, n long")
           .groupBy("slot").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(len(vocabulary), dtype=np.int64)
    out[got["slot"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.int64)
    return out


def _search_block(block: _Block, counts: np.ndarray, slop: int | None):
    """mapInArrow function: add the hits of one block.  ``slop`` None: phrases."""
    vocabulary = block.vocabulary
    gap = max([0, *(len(t) for t in block.terms)]) + (slop or 0)
    rarest = [np.argsort(counts[np.searchsorted(vocabulary, t)], kind="stable") for t in block.terms]
    owners = [block.items[i] for i in range(len(block.terms))]

    def phrase(t, order, of):
        at = of(t[order[0]]) - order[0]
        for k in order[1:]:
            if not len(at):
                return at
            have = of(t[k])
            at = at[_has(have, at + k)] if len(have) else at[:0]
        return at

    def nearby(t, order, of):
        at, reach = of(t[order[0]]), len(t) + slop - 1
        for k in order[1:]:
            if not len(at):
                return at
            have = of(t[k])
            at = at[np.searchsorted(have, at + reach, side="right") > np.searchsorted(have, at - reach)]
        return at

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names, first, pos, base = _lists(batch, gap)

            def of(term):
                k = int(np.searchsorted(names, term))
                return pos[first[k]:first[k + 1]] if k < len(names) and names[k] == term else pos[:0]

            present = np.isin(vocabulary, names)
            spans, owned = [], []
            for i, t in enumerate(block.terms):
                if not present[np.searchsorted(vocabulary, t)].all():
                    continue
                at = (phrase if slop is None else nearby)(t, rarest[i], of)
                if len(at):
                    spans.append(np.stack([at, at + (len(t) if slop is None else 1)], axis=1))
                    owned += [(d, x) for d in np.unique(np.searchsorted(base, at, side="right") - 1) for x in owners[i]]
            hits, items = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
            if spans:
                span = np.concatenate(spans)
                doc = np.searchsorted(base, span[:, 0], side="right") - 1
                for d in np.unique(doc):
                    hits[d] += (span[doc == d] - base[d]).astype(np.uint32).tobytes()
                for d, x in owned:
                    if x not in items[d]:
                        items[d].append(x)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "n_words", "terms", "counts", "positions")), pa.array(hits, pa.binary()),
                 pa.array(items, pa.list_(pa.string()))], names=batch.schema.names)

    return rows


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_hit, digests, spans = [], [], []
        items = [sorted(x) for x in batch.column("items").to_pylist()]
        for n, hits, own in zip(batch.column("n_words").to_pylist(), batch.column("hits").to_pylist(), items, strict=True):
            pairs = np.unique(np.frombuffer(hits, dtype=np.uint32).reshape(-1, 2).astype(np.int64), axis=0)
            edge = np.zeros(n + 1, dtype=np.int64)
            np.add.at(edge, pairs[:, 0], 1)
            np.add.at(edge, pairs[:, 1], -1)
            n_hit.append(int((np.cumsum(edge[:-1]) > 0).sum()))
            digests.append(hashlib.sha256(",".join(own).encode()).hexdigest())
            spans.append(pairs.tolist())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()),
             pa.array(digests, pa.string()), pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.list_(pa.int64())))],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "items", "spans"])


def search(index: DataFrame, items: DataFrame, window: int = 13, slop: int | None = None, id_col: str = "item_id",
           text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, items, spans, contaminated) per index row.

    ``slop`` None finds exact phrases and marks their words; a number finds
    occurrences of each window's rarest term with all its other terms at most
    window + slop - 1 words away, and marks those occurrences."""
    out = index
    for block in _blocks(items, id_col, text_col, window, block_bytes):
        if block.terms:
            counts = _term_counts(index, block.vocabulary)
            out = out.mapInArrow(_search_block(block, counts, slop), _INDEX)
    out = out.mapInArrow(_report, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
                                  "items array<string>, spans array<array<long>>")
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def contamination(docs: DataFrame, items: DataFrame, window: int = 13) -> DataFrame:
    """Index the documents for the items and search them for exact phrases."""
    return search(build_index(docs, items), items, window)


def keep_uncontaminated(docs: DataFrame, items: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated.  Rows are filtered where they are, by a membership
    table of the contaminated ones that lets none through; only rows it holds back are shuffled, to be asked exactly."""
    key = fresh_name(docs, "row_key")  # of a row's id and text; the same for repeated rows
    keyed = docs.withColumn(key, F.xxhash64(F.col(id_col).cast("long"), F.xxhash64(text_col)))
    found = search(build_index(keyed, items, key, text_col), items, window)
    bad = stored(found.filter("contaminated").select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    some, others = slots.apart(keyed, key, bad)
    return others.unionByName(some.join(bad, key, "left_anti").select(keyed.columns)).drop(key)
