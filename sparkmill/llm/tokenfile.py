"""Token-id shards in a binary format of our own, with keyed access.

A shard holds, in ascending id order, the raw token ids of its documents and a
minimal perfect hash over their keys:

    magic ``TIDS``, then little-endian: u32 ids' width in bytes, u32 documents,
    u32 null-id documents, u64 ids, u32 hash buckets
    i64 keys[documents]      document ids, ascending, null ids first as 0
    u64 offsets[documents+1] first id of each document
    i32 seeds[buckets]       hash-and-displace seeds; -(slot + 1): the slot itself
    u32 prints[documents]    by slot: fingerprint of the key
    u32 records[documents]   by slot: the document's number in the shard
    payload                  ids, ``width`` bytes each

A look-up hashes the key to its bucket, the bucket's seed to the slot, compares the
fingerprint and slices the payload: constant time.  A key is (id, how many equal
ids stand before it in the shard).  Files are runs of shards, each ended by a line
break, written by Spark's text writer from raw bytes through the commit protocol and
read back with the binaryFile source.

Words are encoded once per batch by the tokenizers library, and ids gathered per
document: the pre-tokenizer never joins across white space, which the tests check
against whole texts.

Defined cases: a null or empty text has the end id alone; null ids come first;
repeated ids are records of their own; an empty table has no records; further columns,
whatever their names, are not read."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmill.llm import words as W
from sparkmill.llm.store import stored

_KIND = W.non_space(lower=False)
_HEAD = np.dtype([("magic", "S4"), ("width", "<u4"), ("docs", "<u4"), ("nulls", "<u4"), ("ids", "<u8"), ("buckets", "<u4")])
SHARD_BYTES = 8 << 20
END_ID = 1
KNOWN_WORDS = 1 << 20
_MARK = "\x01"


class WordIds:
    """Token ids of words, remembered up to ``KNOWN_WORDS`` words per worker process;
    further words are encoded again in each batch."""

    _loaded: dict[str, WordIds] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.encode = getattr(self.tok, "encode_batch_fast", self.tok.encode_batch)
        self.mark = self.tok.encode(_MARK, add_special_tokens=False).ids
        self.hash, self.at, self.size, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.text, self.start, self.end = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)

    @classmethod
    def of(cls, path: str) -> WordIds:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, flat ids) of words.  Runs of words are encoded as one text, set
        apart by a mark that is one token; words that hold the mark go alone."""
        sizes, flat = [], []
        for i in range(0, len(words), 4096):
            part = words[i:i + 4096]
            if len(self.mark) == 1 and not any(_MARK in x for x in part):
                ids = np.array(self.encode([f" {_MARK} ".join(part) + f" {_MARK}"], add_special_tokens=False)[0].ids, dtype=np.uint32)
                ends = np.flatnonzero(ids == self.mark[0])
                sizes.append(np.diff(np.concatenate([[-1], ends])) - 1)
                flat.append(np.delete(ids, ends))
            else:
                each = [x.ids for x in self.encode(part, add_special_tokens=False)]
                sizes.append(np.array([len(x) for x in each], dtype=np.int64))
                flat.append(np.array([y for x in each for y in x], dtype=np.uint32))
        cat = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        return cat(sizes, np.int64), cat(flat, np.uint32)

    def look_up(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        """(offsets, sizes, flat ids) for distinct words.  A remembered word is used only if its bytes are the same."""
        at = np.searchsorted(self.hash, hashes)
        at[at == len(self.hash)] = 0
        met = self.hash[at] == hashes if len(self.hash) else np.zeros(len(hashes), dtype=bool)
        known = met.copy()
        known[met] = W.same_spans(data, start[met], end[met], self.text, self.start[at[met]], self.end[at[met]])
        new = np.flatnonzero(~known)
        raw = [data[s:e].tobytes() for s, e in zip(start[new], end[new], strict=True)]
        size_new, flat_new = self._encoded([x.decode("utf-8") for x in raw])
        off_new = np.cumsum(size_new) - size_new
        offset, size = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int64)
        offset[known], size[known] = self.at[at[known]], self.size[at[known]]
        offset[new], size[new] = off_new + len(self.ids), size_new
        flat = np.concatenate([self.ids, flat_new])
        if len(self.hash) + len(new) <= KNOWN_WORDS:
            _, one = np.unique(hashes[new], return_index=True)  # of words of one hash the first is remembered
            one = one[~met[new[one]]]
            until = np.cumsum([0, *map(len, raw)]) + len(self.text)
            h = np.concatenate([self.hash, hashes[new[one]]])
            order = np.argsort(h)
            joined = lambda old, fresh: np.concatenate([old, fresh[one]])[order]
            self.at, self.size = joined(self.at, offset[new]), joined(self.size, size_new)
            self.start, self.end = joined(self.start, until[:-1]), joined(self.end, until[1:])
            self.hash, self.ids, self.text = h[order], flat, np.concatenate([self.text, np.frombuffer(b"".join(raw), np.uint8)])
        return offset, size, flat


def encode_texts(array: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of n + 1, flat ids) of the texts of an array, without end ids."""
    model = WordIds.of(path)
    counts, flat = [np.zeros(1, np.int64)], []
    for _, data, offsets in W.chunks(array, 16 << 20):
        w = W.split(data, offsets, _KIND)
        first, which = W.distinct_spans(data, w.start, w.end, w.hash)
        at, size, ids = model.look_up(w.hash[first], data, w.start[first], w.end[first])
        each = size[which]
        total = np.concatenate([[0], np.cumsum(each)])
        flat.append(ids[np.repeat(at[which] - total[:-1], each) + np.arange(total[-1])])
        counts.append(np.diff(total[w.first]))
    return np.cumsum(np.concatenate(counts)), np.concatenate(flat) if flat else np.zeros(0, np.uint32)


# ---------------------------------------------------------------- minimal perfect hash
def _key_hash(keys: np.ndarray, ordinal: np.ndarray, null: np.ndarray) -> np.ndarray:
    return W.mix(keys.astype(np.int64).view(np.uint64) ^ W.mix(ordinal.astype(np.uint64) * np.uint64(2) + null.astype(np.uint64)))


def _slots(h: np.ndarray, seed: np.ndarray, n: int) -> np.ndarray:
    return (W.mix(h ^ W.mix(seed.astype(np.uint64))) % np.uint64(n)).astype(np.int64)


def build_hash(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seeds, slot of each key) for distinct key hashes: hash and displace, large
    buckets first; buckets of one key take a free slot directly."""
    n = len(h)
    m = n // 4 + 1
    bucket = (h >> np.uint64(32)).astype(np.int64) % m
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=m)
    first = np.cumsum(sizes) - sizes
    seeds, slot, free = np.zeros(m, dtype=np.int32), np.empty(n, dtype=np.int64), np.ones(n, dtype=bool)
    tries = np.arange(64)
    for b in np.argsort(-sizes, kind="stable"):
        keys = order[first[b]:first[b] + sizes[b]]
        if len(keys) < 2:
            break
        base = 0
        while True:
            spots = _slots(h[keys][None, :], (base + tries)[:, None], n)
            ok = free[spots].all(axis=1)
            for t in np.flatnonzero(ok):
                if len(set(spots[t].tolist())) == len(keys):
                    break
            else:
                base += len(tries)
                continue
            seeds[b], slot[keys] = base + t, spots[t]
            free[spots[t]] = False
            break
    single = np.flatnonzero(sizes == 1)
    left = np.flatnonzero(free)
    seeds[single], slot[order[first[single]]] = -left[:len(single)] - 1, left[:len(single)]
    return seeds, slot


@dataclass
class Shard:
    """A shard's sections, read from its bytes without copying the payload."""

    keys: np.ndarray
    nulls: int
    offsets: np.ndarray
    seeds: np.ndarray
    prints: np.ndarray
    records: np.ndarray
    ids: np.ndarray

    @staticmethod
    def write(keys: np.ndarray, null: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> bytes:
        width = 2 if ids.max(initial=0) < 1 << 16 else 4
        head = np.concatenate([[True], (keys[1:] != keys[:-1]) | (null[1:] != null[:-1])]) if len(keys) else np.zeros(0, bool)
        begin = np.flatnonzero(head)
        ordinal = np.arange(len(keys)) - np.repeat(begin, np.diff(np.append(begin, len(keys))))
        h = _key_hash(keys, ordinal, null)
        seeds, slot = build_hash(h)
        prints, records = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.uint32)
        prints[slot], records[slot] = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.arange(len(keys))
        top = np.array([(b"TIDS", width, len(keys), int(null.sum()), len(ids), len(seeds))], dtype=_HEAD)
        return b"".join([top.tobytes(), keys.astype("<i8").tobytes(), offsets.astype("<u8").tobytes(), seeds.astype("<i4").tobytes(),
                         prints.astype("<u4").tobytes(), records.astype("<u4").tobytes(), ids.astype(f"<u{width}").tobytes()])

    @staticmethod
    def read(raw: bytes, at: int = 0) -> tuple[Shard, int]:
        """The shard that begins at byte ``at``, and the byte behind it."""
        top = np.frombuffer(raw, _HEAD, 1, at)[0]
        if top["magic"] != b"TIDS":
            raise ValueError(f"no shard at byte {at}")
        docs, at = int(top["docs"]), at + _HEAD.itemsize
        parts = []
        for kind, n in (("<i8", docs), ("<u8", docs + 1), ("<i4", int(top["buckets"])), ("<u4", docs), ("<u4", docs), (f"<u{top['width']}", int(top["ids"]))):
            parts.append(np.frombuffer(raw, kind, n, at))
            at += parts[-1].nbytes
        keys, offsets, seeds, prints, records, ids = parts
        return Shard(keys, int(top["nulls"]), offsets.astype(np.int64), seeds, prints, records, ids), at

    def find(self, keys: np.ndarray, ordinal: np.ndarray, null: np.ndarray) -> np.ndarray:
        """Record numbers of keys, -1 where the fingerprint differs."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        h = _key_hash(keys, ordinal, null)
        seed = self.seeds[(h >> np.uint64(32)).astype(np.int64) % len(self.seeds)]
        slot = np.where(seed < 0, -seed.astype(np.int64) - 1, _slots(h, np.maximum(seed, 0), len(self.keys)))
        return np.where(self.prints[slot] == (h & np.uint64(0xFFFFFFFF)), self.records[slot].astype(np.int64), -1)

    def get(self, key: int | None, ordinal: int = 0) -> np.ndarray | None:
        at = int(self.find(np.array([key or 0]), np.array([ordinal]), np.array([key is None]))[0])
        return None if at < 0 else self.ids[self.offsets[at]:self.offsets[at + 1]]


def _shards(path: str, end_id: int, shard_bytes: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, null, sizes, ids, held = [], [], [], [], 0

        def flush():
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            raw = Shard.write(np.concatenate(keys), np.concatenate(null), offsets, np.concatenate(ids))
            return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], names=["shard"])

        for batch in batches:
            for r in range(0, batch.num_rows, 1000):
                part = batch.slice(r, 1000)
                offset, flat = encode_texts(part.column("text"), path)
                n = part.num_rows
                full = np.insert(flat, offset[1:], np.uint32(end_id))
                key = part.column("doc_id")
                null.append(key.is_null().to_numpy(zero_copy_only=False))
                keys.append(key.fill_null(0).to_numpy())
                sizes.append(np.diff(offset) + 1)
                ids.append(full)
                held += 2 * len(full) + 28 * n
                if held >= shard_bytes:
                    yield flush()
                    keys, null, sizes, ids, held = [], [], [], [], 0
        if keys:
            yield flush()

    return rows


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text and write shards below ``path`` in ascending id order."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    ordered = texts.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie)
    (ordered.mapInArrow(_shards(tokenizer, end_id, shard_bytes), "shard binary")
     .select(F.col("shard").cast("string").alias("value")).write.option("lineSep", "\n").option("compression", "none").text(path))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            raw, at, begin = content.as_buffer(), 0, 0
            while at < raw.size:
                shard, at = Shard.read(raw, at)
                at += 1  # the line break
                n = len(shard.keys)
                null = np.arange(n) < shard.nulls
                head = np.flatnonzero(np.concatenate([[True], (shard.keys[1:] != shard.keys[:-1]) | (null[1:] != null[:-1])])) if n else np.zeros(0, int)
                ordinal = np.arange(n) - np.repeat(head, np.diff(np.append(head, n)))
                number = shard.find(shard.keys, ordinal, null)
                if (number < 0).any():
                    raise ValueError(f"{path}: a key is not in its shard's hash")
                first, last = shard.offsets[number], shard.offsets[number + 1]
                wide = shard.ids.astype("<u4")
                crc = [zlib.crc32(wide[a:b]) for a, b in zip(first, last, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * n, pa.string()), pa.array(shard.keys, mask=null), pa.array(first + begin), pa.array(last - first), pa.array(crc, pa.int64())],
                    names=["path", "doc_id", "start", "n_tokens", "ids_crc32"])
                begin += len(shard.ids)


def _order(path: str) -> tuple:
    part = re.search(r"part-(\d+)-.*?(?:-c(\d+))?\.", path.rsplit("/", 1)[-1])
    return int(part[1]), int(part[2] or 0)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record below ``path``, each found by
    its key; ``start`` counts the ids of all documents before it, in all files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    recs = stored(files.mapInArrow(_records, "path string, doc_id long, start long, n_tokens long, ids_crc32 long"), "token-records")
    totals = recs.groupBy("path").agg(F.sum("n_tokens").alias("n")).collect()  # one row a file
    base, run = [], 0
    for r in sorted(totals, key=lambda r: _order(r["path"])):
        base.append((r["path"], run))
        run += r["n"]
    bases = spark.createDataFrame(base, "b_path string, base long")
    return recs.join(bases, recs.path == bases.b_path).select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
