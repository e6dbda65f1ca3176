"""License scans by template-markup matching.

A license template is plain wording with optional and replaceable regions (``license_templates``).  It is
compiled once into a token automaton: a chain of states over words, in which an optional region can be
stepped past and a replaceable one takes between a and b words of any kind.  Determinised states are made as texts
ask for them and remembered.  A text is accepted where its words spell the mandatory wording exactly.

A template's longest unbroken run of mandatory words is its anchor.  Anchors are found by comparing whole arrays of word
numbers; only behind and before an anchor do the automata run, forward for the rest and backward (over the mirrored
template) for what stands before, and the longest acceptance counts.  A run ends after the template's
longest spelling at the latest, so the work is linear in the text.

Base phrases are places where their words stand consecutively.  Word numbers are looked up by hash and compared byte
by byte, so no chance match counts.  ``score`` is the share of a document's labels that a template proves, where a label
that only a phrase names counts half.  Rows are judged alone, in Arrow batches: no shuffle, no hot key.

Defined cases: null and empty texts have no words and no labels; overlapping places and spans all count; very long texts
are scanned whole; repeated rows are judged each; an empty table gives none; further columns, whatever their names, are not read."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmill.llm import words as W
from sparkmill.llm.license_templates import PHRASES, TEMPLATES
from sparkmill.llm.store import give_back, lean_batches

_KIND = W.alphanumeric(lower=True)
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_MARKUP = re.compile(r"<<(beginOptional|endOptional|var)((?:;[a-z]+=\"[^\"]*\")*)>>")
_COUNTS = re.compile(r"\.\{(\d+),(\d+)\}")
ANY = -1


def folded_words(text: str) -> list[str]:
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


# ---------------------------------------------------------------- markup
@dataclass(frozen=True)
class Optional:
    """A region that may be left out."""

    parts: tuple


@dataclass(frozen=True)
class Replaceable:
    """Between ``least`` and ``most`` words of any kind."""

    least: int
    most: int


def parse(text: str) -> tuple:
    """The parts of a template's text: words (str), ``Optional`` and ``Replaceable`` regions."""
    open_parts, at = [[]], 0
    for m in _MARKUP.finditer(text):
        open_parts[-1] += folded_words(text[at:m.start()])
        at = m.end()
        if m[1] == "beginOptional":
            open_parts.append([])
        elif m[1] == "endOptional":
            if len(open_parts) == 1:
                raise ValueError("an optional region ends that did not begin")
            inner = open_parts.pop()
            open_parts[-1].append(Optional(tuple(inner)))
        else:
            counts = _COUNTS.fullmatch(dict(re.findall(r';([a-z]+)="([^"]*)"', m[2])).get("match", ""))
            if not counts or int(counts[1]) > int(counts[2]):
                raise ValueError(f"a replaceable region needs match=\".{{a,b}}\": {m[0]}")
            open_parts[-1].append(Replaceable(int(counts[1]), int(counts[2])))
    if len(open_parts) > 1:
        raise ValueError("an optional region does not end")
    return tuple(open_parts[0] + folded_words(text[at:]))


def mirrored(parts: tuple) -> tuple:
    return tuple(Optional(mirrored(p.parts)) if isinstance(p, Optional) else p for p in reversed(parts))


class Automaton:
    """Accepts the spellings of some parts from a text's word on, one way only."""

    def __init__(self, parts: tuple, number: dict[str, int]):
        self.edges: list[list[tuple[int, int]]] = []  # state -> (word number or ANY, next state)
        self.skips: list[list[int]] = []
        self.number = number
        first = self._state()
        self.last = self._chain(parts, first)
        self.names: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[int, int]] = []
        self.start = self._set({first})

    def _state(self) -> int:
        self.edges.append([])
        self.skips.append([])
        return len(self.edges) - 1

    def _chain(self, parts: tuple, at: int) -> int:
        for p in parts:
            end = self._state()
            if isinstance(p, Optional):
                self.skips[at].append(end)
                self.skips[self._chain(p.parts, at)].append(end)
            elif isinstance(p, Replaceable):
                for k in range(p.most):
                    if k >= p.least:
                        self.skips[at].append(end)
                    step = self._state()
                    self.edges[at].append((ANY, step))
                    at = step
                self.skips[at].append(end)
            else:
                self.edges[at].append((self.number[p], end))
            at = end
        return at

    def _set(self, states: set[int]) -> int:
        """Number of the determinised state that holds ``states`` and all that is reached by steps past."""
        todo = list(states)
        while todo:
            fresh = [y for y in self.skips[todo.pop()] if y not in states]
            states.update(fresh)
            todo += fresh
        key = frozenset(states)
        if key not in self.names:
            self.names[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
        return self.names[key]

    def longest(self, numbers: np.ndarray) -> int:
        """Words of the longest spelling that ``numbers`` begin with, -1 if there is none."""
        at, found = self.start, -1
        for n, word in enumerate(numbers.tolist()):
            here = self.sets[at]
            if self.last in here:
                found = n
            if word not in self.steps[at]:
                self.steps[at][word] = self._set({to for s in here for want, to in self.edges[s] if want in (ANY, word)})
            at = self.steps[at][word]
            if not self.sets[at]:
                return found
        return len(numbers) if self.last in self.sets[at] else found


def _most(parts: tuple) -> int:
    """Words of the longest spelling."""
    return sum(1 if isinstance(p, str) else p.most if isinstance(p, Replaceable) else _most(p.parts) for p in parts)


@dataclass
class Template:
    label: str
    family: str | None
    parts: tuple
    anchor: np.ndarray = field(init=False)
    before: Automaton = field(init=False)
    behind: Automaton = field(init=False)
    reach: tuple[int, int] = field(init=False)

    def compile(self, number: dict[str, int]) -> Template:
        runs, at = [], 0
        while at < len(self.parts):
            end = at
            while end < len(self.parts) and isinstance(self.parts[end], str):
                end += 1
            runs.append((end - at, -at, at, end))
            at = end + 1
        size, _, a, b = max(runs, default=(0, 0, 0, 0))
        if not size:
            raise ValueError(f"the template of {self.label} has no mandatory word")
        self.anchor = np.array([number[x] for x in self.parts[a:b]], dtype=np.int32)
        self.before, self.behind = Automaton(mirrored(self.parts[:a]), number), Automaton(self.parts[b:], number)
        self.reach = (_most(self.parts[:a]), _most(self.parts[b:]))
        return self

    def spans(self, numbers: np.ndarray, starts: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
        """(text, start, end) of the accepted spellings around the anchors that begin at ``starts``."""
        out, n = [], len(self.anchor)
        for s in starts.tolist():
            doc = int(np.searchsorted(first, s, side="right")) - 1
            low, high = int(first[doc]), int(first[doc + 1])
            more = self.behind.longest(numbers[s + n:min(high, s + n + self.reach[1] + 1)])
            if more < 0:
                continue
            less = self.before.longest(numbers[max(low, s - self.reach[0] - 1):s][::-1])
            if less >= 0:
                out.append((doc, s - less - low, s + n + more - low))
        return out


def _vocabulary(parts: tuple) -> set[str]:
    return {p for p in parts if isinstance(p, str)}.union(*(_vocabulary(p.parts) for p in parts if isinstance(p, Optional)))


class Matcher:
    """Templates and phrases over one numbering of their words; every other word is number 0."""

    def __init__(self, templates: Sequence[tuple] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES):
        parsed = [Template(label, family, parse(text)) for label, family, text in templates]
        known = sorted(set().union(*(_vocabulary(t.parts) for t in parsed), *(folded_words(p) for p, _ in phrases)))
        number = {w: i + 1 for i, w in enumerate(known)}
        self.templates = [t.compile(number) for t in parsed]
        self.phrases = [(np.array([number[w] for w in folded_words(p)], dtype=np.int32), label) for p, label in phrases]
        raw = [w.encode() for w in known]
        self.size = np.array([0, *map(len, raw)], dtype=np.int64)
        self.flat = np.zeros((len(raw) + 1, max(map(len, raw), default=1)), dtype=np.uint8)
        for i, w in enumerate(raw):
            self.flat[i + 1, :len(w)] = np.frombuffer(w, np.uint8)
        joined = np.frombuffer(b" ".join(raw), np.uint8)
        hashes = W.split(joined, np.array([0, len(joined)]), _KIND).hash
        self.order = np.argsort(hashes)
        self.hash = hashes[self.order]

    def numbers(self, w: W.Words) -> np.ndarray:
        """Number of each word of ``w``, by hash, checked byte by byte."""
        out = np.zeros(len(w.hash), dtype=np.int32)
        if not len(self.hash):
            return out
        at = np.minimum(np.searchsorted(self.hash, w.hash), len(self.hash) - 1)
        some = np.flatnonzero(self.hash[at] == w.hash)
        guess = (self.order[at[some]] + 1).astype(np.int32)
        some, guess = (x[w.end[some] - w.start[some] == self.size[guess]] for x in (some, guess))
        same = np.ones(len(some), dtype=bool)
        for k in range(self.flat.shape[1]):
            more = np.flatnonzero(self.size[guess] > k)
            same[more] &= _KIND.fold[w.data[w.start[some[more]] + k]] == self.flat[guess[more], k]
        out[some[same]] = guess[same]
        return out

    @staticmethod
    def _places(numbers: np.ndarray, doc: np.ndarray, run: np.ndarray) -> np.ndarray:
        """Where the words of ``run`` stand consecutively in one text."""
        at = np.flatnonzero(numbers[:max(0, len(numbers) - len(run) + 1)] == run[0])
        for k in range(1, len(run)):
            at = at[numbers[at + k] == run[k]]
        return at[doc[at] == doc[at + len(run) - 1]]

    def scan(self, w: W.Words) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, int, Template]]]:
        """(text, word, label) of phrase places, (text, start, end, template) of accepted spellings; words from 0."""
        numbers = self.numbers(w)
        phrases = []
        for run, label in self.phrases:
            at = self._places(numbers, w.doc, run)
            phrases += zip(w.doc[at].tolist(), (at - w.first[w.doc[at]]).tolist(), [label] * len(at), strict=True)
        spans = [(*s, t) for t in self.templates for s in t.spans(numbers, self._places(numbers, w.doc, t.anchor), w.first)]
        return phrases, spans


_ROW = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label:string,start:long,end:long>>")
_SPANS = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, templates: Sequence[tuple] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) per row; ``spans`` are the accepted
    spellings (label, start, end), in words from 0, end exclusive."""
    lean_batches(docs.sparkSession)
    Matcher(templates, phrases)  # a wrong template fails here

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        matcher = Matcher(templates, phrases)
        for batch in batches:
            for row, data, offsets in W.chunks(batch.column("text")):
                w, n = W.split(data, offsets, _KIND), len(offsets) - 1
                phrase, span = matcher.scan(w)
                places: dict[int, list] = {}
                for d, at, label in phrase:
                    places.setdefault(d, []).append((at, label))
                accepted: dict[int, list] = {}
                for d, s, e, t in span:
                    accepted.setdefault(d, []).append((s, e, t))
                out = [_judge(places.get(d, []), accepted.get(d, [])) if d in places or d in accepted else _NONE for d in range(n)]
                cols = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), _SPANS)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, n), pa.array(w.counts.astype(np.int64)),
                                                  *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], schema=_SCHEMA)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(rows, _ROW)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                     ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", _SPANS)])
_NONE = (0, None, None, "", "", 0.0, [])


def _judge(places: list[tuple[int, str]], accepted: list[tuple[int, int, Template]]) -> tuple:
    named = {label for _, label in places}
    proved = {t.label for *_, t in accepted} | (named & {t.family for *_, t in accepted})
    labels = named | proved
    at = [p for p, _ in places]
    spans = [{"label": label, "start": s, "end": e} for s, e, label in sorted({(s, e, t.label) for s, e, t in accepted})]
    return (len(at), min(at, default=None), max(at, default=None), ",".join(sorted(named)), ",".join(sorted(labels)),
            (len(proved) + 0.5 * len(labels - proved)) / len(labels) if labels else 0.0, spans)
