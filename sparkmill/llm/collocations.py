"""Phrase collocation mining with a bidirectional FM-index over word ids per shard.

The texts of a language are cut, partition by partition, into shards of about ``SHARD_BYTES`` bytes; a cut falls only
between pieces, which no phrase crosses.  A shard's words get ids of its own, and two Burrows-Wheeler transforms are
made of its id sequence, one of the text and one of the mirrored text, both sorted to the depth of the longest phrase: deep enough
for every interval that is asked for.  An interval stands for a phrase on both sides at once: the symbols of one
transform within it are the phrase's extensions on that side, with their counts, and give the intervals of the longer phrases.

``phrase_counts`` goes up level by level and sums counts across shards:

1. each word of a shard with its count; sums give f(word) and n;
2. every word's interval is extended to the right; one shuffle by phrase brings the counts of all shards together, and a
   window over them sends f(phrase) back to each shard that holds a phrase frequent enough;
3. a shard extends those pairs to the left, only by words that make a frequent pair with the pair's first one.

No text is shuffled, and a phrase appears once per shard whatever its frequency, so a hot phrase or a hot language brings
no task more than one row per shard.  Words of all shards are told apart by 64-bit hashes of language and word; the words are
gathered with their hashes anyway, and if ever two share one, the shards are keyed again with another seed: counts are exact.

``collocations`` scores the frequent phrases by their weakest cut, floor(10**6 a^2 / (l r)) in exact decimal
arithmetic, drops those that a longer candidate mostly explains, and ranks the rest per language.

Defined cases: null and empty texts have no words; a null language counts as ``und``; overlapping occurrences all count; very
long texts are spread over shards, but one piece stays whole; repeated rows count again; an empty table gives no rows; further
columns, whatever their names, are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmill.llm import words as W
from sparkmill.llm.store import give_back, lean_batches, stored

SHARD_BYTES = 8 << 20
LEAST, EXPLAINED, TOP = 10, 50, 2000
DEPTH = 3
_U64 = np.uint64
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[10, 11, 12, 13, *b".,;:!?"]] = True
_IS_WORD = ~_ENDS
_IS_WORD[[9, 32]] = False
_KIND = W.WordClass.of(_IS_WORD, lower=True)


# ---------------------------------------------------------------- index
def _sorted_places(seq: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``seq`` in the order of the ``depth`` symbols that begin there."""
    n, bits = len(seq), int(seq.max(initial=0)).bit_length()
    padded = np.concatenate([seq, np.zeros(depth, seq.dtype)]).astype(_U64)
    rank = padded[:n]
    for d in range(1, depth):
        if bits * (d + 1) > 64:  # ranks of what is sorted so far take the place of the symbols
            rank = np.unique(rank, return_inverse=True)[1].astype(_U64)
            rank = (rank << _U64(32)) | padded[d:d + n]
        else:
            rank = (rank << _U64(bits)) | padded[d:d + n]
    return np.argsort(rank, kind="stable")


def _transform(seq: np.ndarray, depth: int) -> np.ndarray:
    """The symbol before each place (before the first one the last), in the places' sorted order."""
    return np.roll(seq, 1)[_sorted_places(seq, depth)]


class Index:
    """Phrases of up to ``depth`` words of a sequence of ids from 1; 0 is a break, which no phrase holds.

    An interval is (at, size) on each side: ``left`` counts places sorted by what follows, whose transform holds
    what stands to the left; ``right`` is the same of the mirrored sequence."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        self.sides = (left, right)
        self.count = np.bincount(left, minlength=int(left.max(initial=0)) + 1)
        self.below = np.cumsum(self.count) - self.count
        self._ranked: list = [None, None]

    @staticmethod
    def of(seq: np.ndarray, depth: int = DEPTH) -> Index:
        return Index(_transform(seq, depth), _transform(seq[::-1], depth))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word, place on the left side, place on the right side, count) of all words."""
        word = np.flatnonzero(self.count[1:]) + 1 if len(self.count) else np.zeros(0, np.int64)
        return word, self.below[word], self.below[word], self.count[word]

    def extend(self, side: int, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Extensions of some intervals on a side (0 left, 1 right): (number of the interval, word, count,
        how far into the interval on the other side the longer phrase begins), in order of interval and word."""
        total = np.cumsum(size) - size
        own = np.repeat(np.arange(len(at)), size)
        symbols = self.sides[side][np.repeat(at - total, size) + np.arange(int(size.sum()))]
        wide = _U64(max(1, len(self.count)))
        key, n = np.unique(own.astype(_U64) * wide + symbols.astype(_U64), return_counts=True)
        owner, word = (key // wide).astype(np.int64), (key % wide).astype(np.int64)
        smaller = np.cumsum(n) - n - total[owner]
        keep = word > 0
        return owner[keep], word[keep], n[keep], smaller[keep]

    def rank(self, side: int, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the interval of a phrase longer by ``word`` begins on its own side, from where the shorter one's begins."""
        if self._ranked[side] is None:
            symbols = self.sides[side].astype(_U64)
            self._ranked[side] = np.sort(symbols * _U64(len(symbols) + 1) + np.arange(len(symbols), dtype=_U64))
        ranked = self._ranked[side]
        return np.searchsorted(ranked, word.astype(_U64) * _U64(len(ranked) + 1) + at.astype(_U64))


# ---------------------------------------------------------------- shards
def _language_seed(lang: str, seed: int) -> np.uint64:
    raw = np.frombuffer(lang.encode(), np.uint8)
    return W.mix(W.hash_spans(raw, np.zeros(1, np.int64), np.array([len(raw)])) ^ _U64(seed))[0]


def _cuts(data: np.ndarray, room: int, most: int) -> list[int]:
    """Where to cut a text that does not fit into ``room``: behind ends of pieces, at most ``most`` bytes apart
    where a piece allows it."""
    ends = np.flatnonzero(_ENDS[data]) + 1
    cuts, at, until = [], 0, room
    while len(data) - at > until:
        k = int(np.searchsorted(ends, at + until, side="right")) - 1
        if k < 0 or ends[k] <= at:
            if cuts or not room < most:  # the piece is longer than a shard: it stays whole
                k += 1
                if k >= len(ends):
                    break
            else:  # nothing of it fits behind what is there
                cuts.append(0)
                until = most
                continue
        at = int(ends[k])
        cuts.append(at)
        until = most
    return cuts


def _shard(parts: list[np.ndarray], lang: str, seed: int, number: int) -> pa.RecordBatch:
    """One shard: its words, their hashes and counts, and the two transforms."""
    flat = np.concatenate([x for p in parts for x in (p, np.array([10], np.uint8))])
    w = W.split(flat, np.array([0, len(flat)]), _KIND)
    first, which = W.distinct_spans(flat, w.start, w.end, w.hash)
    ends = np.concatenate([[0], np.cumsum(_ENDS[flat])])
    breaks = np.flatnonzero(ends[w.start[1:]] > ends[w.end[:-1]]) + 1
    seq = np.insert((which + 1).astype(np.uint32), breaks, 0)
    seq = np.append(seq, np.uint32(0))
    index = Index.of(seq)
    pack = zs.ZstdCompressor(level=1).compress
    low = _KIND.fold[flat]
    raw = [low[s:e].tobytes() for s, e in zip(w.start[first], w.end[first], strict=True)]
    hashes = W.mix(w.hash[first] ^ _language_seed(lang, seed))
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([lang]), pa.array([len(w.hash)]), pa.array([raw], pa.list_(pa.string())), pa.array([hashes.view(np.int64)], pa.list_(pa.int64())),
         pa.array([np.bincount(which, minlength=len(first))], pa.list_(pa.int64())),
         *(pa.array([pack(x.astype("<u4").tobytes())], pa.binary()) for x in index.sides)], schema=_SHARD_SCHEMA)


_SHARD_SCHEMA = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("words", pa.list_(pa.string())), ("hashes", pa.list_(pa.int64())),
                           ("counts", pa.list_(pa.int64())), ("left", pa.binary()), ("right", pa.binary())])
_SHARD = "shard long, lang string, n long, words array<string>, hashes array<long>, counts array<long>, left binary, right binary"


def shards(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", shard_bytes: int = SHARD_BYTES, seed: int = 0) -> DataFrame:
    """The stored shards of ``docs``, one row each."""
    lean_batches(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        waiting: dict[str, list[np.ndarray]] = {}
        held: dict[str, int] = {}
        base, made = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            data, offsets = W.texts(batch.column("text"))
            for d, lang in enumerate(langs):
                text = data[offsets[d]:offsets[d + 1]]
                cuts = _cuts(text, shard_bytes - held.get(lang, 0), shard_bytes)
                for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True):
                    waiting.setdefault(lang, []).append(text[a:b].copy())
                    held[lang] = held.get(lang, 0) + b - a
                    if b < len(text) or held[lang] >= shard_bytes:
                        yield _shard(waiting.pop(lang), lang, seed, base + made)
                        held[lang], made = 0, made + 1
        for lang, parts in waiting.items():
            yield _shard(parts, lang, seed, base + made)
            made += 1

    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    return stored(texts.filter("text is not null and text <> ''").mapInArrow(rows, _SHARD), "phrase-shards")


def _index(row: dict) -> Index:
    unpack = zs.ZstdDecompressor().decompress
    return Index(*(np.frombuffer(unpack(row[side]), "<u4") for side in ("left", "right")))


def _pairs(index: Index):
    """(first word, second word, count, place on the left side) of every pair, in one fixed order."""
    word, left, right, size = index.words()
    owner, second, n, smaller = index.extend(1, right, size)
    return word[owner], second, n, left[owner] + smaller


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    give_back()
    for batch in batches:
        for row in batch.to_pylist():
            x, y, n, _ = _pairs(_index(row))
            h = np.array(row["hashes"], dtype=np.int64)
            order = np.arange(len(x), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(h[x - 1]), pa.array(h[y - 1]), pa.array(n), pa.array(np.full(len(x), row["shard"])), pa.array(order)],
                                             names=["x", "y", "n", "shard", "number"])


def _triple_rows(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Triples of one shard both of whose pairs are frequent, by left extension of the frequent pairs."""
    out = {c: [np.zeros(0, np.int64)] for c in ("x", "y", "z", "n", "f_xy", "f_yz")}
    for row in left.to_pylist() if right.num_rows else []:
        index, h = _index(row), np.array(row["hashes"], dtype=np.int64)
        y, z, n, at = _pairs(index)
        number, f = right.column("number").to_numpy(), right.column("f").to_numpy()
        order = np.argsort(number)
        number, f = number[order], f[order]
        y, z, n, at = (v[number] for v in (y, z, n, at))
        owner, x, m, _ = index.extend(0, at, n)
        wide = _U64(len(index.count))
        pair = y.astype(_U64) * wide + z.astype(_U64)  # ascends: pairs come in order of their words
        want = x.astype(_U64) * wide + y[owner].astype(_U64)
        found = np.minimum(np.searchsorted(pair, want), len(pair) - 1)
        ok = pair[found] == want
        owner, x, m, found = owner[ok], x[ok], m[ok], found[ok]
        for c, v in (("x", h[x - 1]), ("y", h[y[owner] - 1]), ("z", h[z[owner] - 1]), ("n", m), ("f_xy", f[found]), ("f_yz", f[owner])):
            out[c].append(v)
    return pa.table({c: np.concatenate(v).astype(np.int64) for c, v in out.items()})


# ---------------------------------------------------------------- counts
def _words(index: DataFrame) -> DataFrame:
    """(key, lang, word, f, clash): f(word) of all words by hash, and whether two words share the hash."""
    each = index.select("lang", F.explode(F.arrays_zip("words", "hashes", "counts")).alias("w"))
    own = F.struct("lang", F.col("w.words").alias("word"))
    sums = each.groupBy(F.col("w.hashes").alias("key")).agg(F.min(own).alias("a"), F.max(own).alias("b"), F.sum("w.counts").alias("f"))
    return sums.select("key", "a.lang", "a.word", "f", (F.col("a") != F.col("b")).alias("clash"))


def phrase_counts(docs: DataFrame, least: int = LEAST, lang_col: str = "lang", text_col: str = "text",
                  shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(totals, words, pairs, triples) of the phrases that occur ``least`` times or more: (lang, n), n of all words;
    (key, lang, word, f); (x, y, a); (x, y, z, a, f_xy, f_yz), whose x, y and z are keys of words."""
    seed = 0
    while True:
        index = shards(docs, lang_col, text_col, shard_bytes, seed)
        words = stored(_words(index).filter(F.col("clash") | (F.col("f") >= least)), "phrase-words")
        if words.filter("clash").isEmpty():
            break
        seed += 1
    totals = index.groupBy("lang").agg(F.sum("n").alias("n"))
    each = (index.select("shard", "hashes", "left", "right").mapInArrow(_pair_rows, "x long, y long, n long, shard long, number int"))
    same = Window.partitionBy("x", "y")
    common = stored(each.withColumn("f", F.sum("n").over(same)).filter(F.col("f") >= least)
                    .withColumn("one", F.row_number().over(same.orderBy("shard")) == 1), "phrase-pairs")
    pairs = common.filter("one").select("x", "y", F.col("f").alias("a"))
    wanted = common.select("shard", "number", "f")
    found = (index.select("shard", "hashes", "left", "right").groupBy("shard").cogroup(wanted.groupBy("shard"))
             .applyInArrow(_triple_rows, "x long, y long, z long, n long, f_xy long, f_yz long"))
    triples = found.groupBy("x", "y", "z", "f_xy", "f_yz").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)
    return totals, words.drop("clash"), pairs, stored(triples.select("x", "y", "z", "a", "f_xy", "f_yz"), "phrase-triples")



def score(a: str, l: str, r: str):  # noqa: E741
    """floor(10**6 a^2 / (l r)); a is at most l and r, so the score is at most 10**6 while the products may pass 64 bits."""
    return F.expr(f"cast((cast({a} as decimal(15,0)) * cast({a} as decimal(15,0)) * 1000000bd) div (cast({l} as decimal(19,0)) * cast({r} as decimal(19,0))) as long)")


def collocations(docs: DataFrame, least: int = LEAST, explained: int = EXPLAINED, top: int = TOP, lang_col: str = "lang", text_col: str = "text",
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best ``top`` phrases of 2 and 3 words.  A phrase goes if a longer
    candidate that holds it occurs at least ``explained`` percent as often."""
    totals, words, pairs, triples = phrase_counts(docs, least, lang_col, text_col, shard_bytes)
    longer = (triples.select(F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("z").alias("y")))).alias("p"), "a")
              .groupBy("p.x", "p.y").agg(F.max("a").alias("most")))
    kept = pairs.join(longer, ["x", "y"], "left").filter(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * explained))
    none = F.lit(None).cast("long")
    both = stored(kept.select("x", "y", none.alias("z"), "a", none.alias("f_xy"), none.alias("f_yz")).unionByName(triples), "phrases")
    for c in ("x", "y", "z"):
        own = words.select(F.col("key").alias(c), F.col("word").alias(f"w_{c}"), F.col("f").alias(f"f_{c}"), *([F.col("lang")] if c == "x" else []))
        both = both.join(own, c, "left" if c == "z" else "inner")
    pair = F.col("z").isNull()
    cut = both.withColumns({"l1": F.col("f_x"), "r1": F.when(pair, F.col("f_y")).otherwise(F.col("f_yz")), "l2": F.col("f_xy"), "r2": F.col("f_z")})
    cut = cut.withColumns({"s1": score("a", "l1", "r1"), "s2": F.when(~pair, score("a", "l2", "r2"))})
    second = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    out = cut.select("lang", F.concat_ws(" ", "w_x", "w_y", "w_z").alias("phrase"), "a", F.when(second, F.col("l2")).otherwise(F.col("l1")).alias("l"),
                     F.when(second, F.col("r2")).otherwise(F.col("r1")).alias("r"), F.when(second, F.col("s2")).otherwise(F.col("s1")).alias("score"))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
