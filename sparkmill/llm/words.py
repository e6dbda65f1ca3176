"""Words and word windows of Arrow text batches, vectorised with numpy.

Texts are read as UTF-8 bytes straight from the Arrow buffers.  A word is a
maximal run of bytes of a class; every word gets a 64-bit hash, mixed in
blocks of eight bytes, every window of k words one from a running sum over the word
hashes.  (A running sum over bytes would not do for words: modulo 2**64 long patterned words, such as a Thue-Morse
word and its complement, have equal sums for any base.)  Null texts count as empty."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_WINDOW_BASE = np.uint64(0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection that spreads all bits."""
    x = x + _M1
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (the base is odd)."""
    have = _POWERS.get(int(base))
    if have is None or len(have[0]) < n:
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        have = (_powers(base, n), _powers(inverse, n))
        _POWERS[int(base)] = have
    return have


def _running(values: np.ndarray, base: np.uint64) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _tables(base, len(values) + 1)[0][:len(values)], out=out[1:])
    return out


def _between(run: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64) -> np.ndarray:
    return (run[end] - run[start]) * _tables(base, len(run))[1][start]


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs ``data[start:end]``: blocks of eight bytes are mixed in one after another,
    for all runs at once; a run's length is mixed in first."""
    size = end - start
    out = mix(size.astype(np.uint64) * _M3)
    if not len(start):
        return out
    data = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.arange(8)
    at, left, some = start.astype(np.int64), size, np.flatnonzero(size > 0)
    at, left = at[some], left[some]
    while len(some):
        block = data[at[:, None] + eight].view("<u8")[:, 0]
        spare = (8 - np.minimum(left, 8)).astype(np.uint64) * np.uint64(8)  # at most 56
        out[some] = mix((out[some] ^ (block & (np.uint64(0xFFFFFFFFFFFFFFFF) >> spare))) * _M1)
        more = left > 8
        some, at, left = some[more], at[more] + 8, left[more] - 8
    return out


def same_spans(a: np.ndarray, a_start: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Whether the byte runs ``a[a_start:a_end]`` and ``b[b_start:b_end]`` are equal, one by one."""
    out = a_end - a_start == b_end - b_start
    a, b = (np.concatenate([x, np.zeros(8, dtype=np.uint8)]) for x in (a, b))
    eight = np.arange(8)
    some = np.flatnonzero(out & (a_end > a_start))
    x, y, left = a_start[some].astype(np.int64), b_start[some].astype(np.int64), (a_end - a_start)[some]
    while len(some):
        spare = (8 - np.minimum(left, 8)).astype(np.uint64) * np.uint64(8)
        differ = a[x[:, None] + eight].view("<u8")[:, 0] ^ b[y[:, None] + eight].view("<u8")[:, 0]
        equal = differ & (np.uint64(0xFFFFFFFFFFFFFFFF) >> spare) == 0
        out[some[~equal]] = False
        more = equal & (left > 8)
        some, x, y, left = some[more], x[more] + 8, y[more] + 8, left[more] - 8
    return out


def distinct_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place of each distinct byte run, number of each run's own): told apart by hash, then compared byte
    by byte, so that runs of one hash that differ are kept apart."""
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    odd = np.flatnonzero(~same_spans(data, start, end, data, start[first][which], end[first][which]))
    if len(odd):
        extra: dict[bytes, int] = {}
        more = []
        for i in odd.tolist():
            run = data[start[i]:end[i]].tobytes()
            if run not in extra:
                extra[run] = len(first) + len(more)
                more.append(i)
            which[i] = extra[run]
        first = np.concatenate([first, np.array(more, dtype=first.dtype)])
    return first, which


@dataclass(frozen=True)
class WordClass:
    """Which bytes belong to words, and whether A-Z count as a-z."""

    is_word: np.ndarray
    fold: np.ndarray
    lower: bool

    @staticmethod
    def of(is_word: np.ndarray, lower: bool) -> WordClass:
        fold = np.arange(256, dtype=np.uint8)
        if lower:
            fold[65:91] += 32
        return WordClass(is_word[fold], fold, lower)


def non_space(lower: bool) -> WordClass:
    """Words ``[^\\x20\\x09-\\x0D]+``."""
    is_word = np.ones(256, dtype=bool)
    is_word[[32, 9, 10, 11, 12, 13]] = False
    return WordClass.of(is_word, lower)


def alphanumeric(lower: bool) -> WordClass:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    is_word = np.zeros(256, dtype=bool)
    is_word[48:58] = is_word[97:123] = is_word[128:] = True
    return WordClass.of(is_word, lower)


@dataclass
class Words:
    """Words of a run of texts: ``doc`` is the text's index within the run;
    ``first[d]:first[d + 1]`` are the words of text d."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every window of k words of one text."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        at = np.arange(n - k + 1)
        at = at[self.doc[at] == self.doc[at + k - 1]]
        return at, self.window_hash(at, np.full(len(at), k, dtype=np.int64))

    def window_hash(self, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Hashes of windows of any lengths."""
        if not hasattr(self, "_run"):
            self._run = _running(self.hash, _WINDOW_BASE)
        return mix(_between(self._run, at, at + length, _WINDOW_BASE) ^ (length.astype(np.uint64) * _M2))


def texts(array: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets of n + 1) of a string array; nulls are empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    array = array.cast(pa.large_binary())
    n = len(array)
    if not n:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset:array.offset + n + 1]
    raw = array.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(array: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts of about ``most``
    bytes, so that temporary arrays stay small; a longer text is a run alone."""
    data, offsets = texts(array)
    row, n = 0, len(offsets) - 1
    while row < n:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        yield row, data[offsets[row]:offsets[to]], offsets[row:to + 1] - offsets[row]
        row = to


def split(data: np.ndarray, offsets: np.ndarray, kind: WordClass) -> Words:
    """Words of the texts that ``offsets`` cut out of ``data``."""
    inside = kind.is_word[data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    heads = offsets[:-1]
    before[heads[heads < len(data)]] = False
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    tails = offsets[1:]
    after[tails[tails > 0] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    hashes = hash_spans(kind.fold[data] if kind.lower else data, start, end)
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, offsets, start, end, hashes, doc, first)
