"""Sampled SentencePiece segmentations without replacement, and decoding.

A text is cut before each run of spaces; a segment is a run (of the model's word marks, one of
which is also put before the text) and what follows.  No piece holds a mark behind another
character, so none crosses into a segment, and the lattice of a text is the chain of its segments' lattices.  Pieces weigh 1 / (rank + 2) by the model's
own order (those that it gives no rank, runs of marks, come last), characters without a piece fall back to byte pieces; nothing is trained here.
A backward pass over each distinct segment gives every edge its conditional probability.

Gumbel top-k by best-first search: a partial segmentation carries the largest perturbed
log-probability of all its completions.  The root draws a Gumbel; the child on the best path
keeps the parent's value, and its siblings together draw a Gumbel cut off at that value.  Taking
the open node of the largest value again and again gives distinct segmentations in the
order of their perturbed log-probabilities: an exact sample without replacement.  A path is
drawn for all segments at once, and all texts of a chunk go in step.

The inclusion score of a sample is log(1 - exp(-exp(log_prob - next))), where ``next`` is the
largest value left: the log-probability that it is among the k, given that threshold.  Draws
depend on the seed, the row's id and the place in the text only, never on the partitioning.

Defined cases: a null or empty text has one segmentation, without pieces; a text of
fewer than k segmentations gives all of them, with inclusion score 0; a literal word mark
is spelled in bytes; a null id seeds like 0; repeated rows give the same rows again; an empty
table gives none; further columns, whatever their names, are not read."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmill.llm import words as W
from sparkmill.llm.store import give_back, small_batches

SAMPLES = 2
CHUNK_BYTES = 1 << 18
KNOWN_EDGES = 1_500_000
_U64 = np.uint64
_BASE = _U64(0xC2B2AE3D27D4EB4F)
_CODE = W.mix(np.arange(256, dtype=np.uint64) + _U64(11))
_MARK = "▁"
_RETRIES = 20
_SLOT_BITS = 20


class Vocabulary:
    """Pieces of a model file as bytes (the word mark as a space) with log weights."""

    _loaded: dict[str, Vocabulary] = {}

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: list[bytes] = []
        self.byte_id = np.full(256, -1, dtype=np.int64)
        usable = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.pieces.append(bytes([int(piece[3:5], 16)]))
                self.byte_id[int(piece[3:5], 16)] = i
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.pieces.append(b"")
            else:
                self.pieces.append(piece.replace(_MARK, " ").encode())
                if _MARK not in piece.lstrip(_MARK):
                    usable.append((i, -model.get_score(i)))
        weight = np.zeros(len(self.pieces))
        ids, ranks = np.array([u[0] for u in usable]), np.array([u[1] for u in usable])
        unranked = ranks >= 1e8  # runs of marks have no rank of their own in the shipped model: they come last
        ranks[unranked] = ranks[~unranked].max() + 1 + np.arange(unranked.sum())
        weight[ids] = 1 / (ranks - ranks.min() + 2)
        weight[self.byte_id[self.byte_id >= 0]] = weight[ids].min() / 10
        with np.errstate(divide="ignore"):
            self.log_weight = np.log(weight / weight.sum())
        flat = np.frombuffer(b"".join(self.pieces), dtype=np.uint8)
        self.size = np.array([len(p) for p in self.pieces])
        self.first = np.cumsum(self.size) - self.size
        self.flat = flat
        run = W._running(_CODE[flat], _BASE)
        h = W._between(run, self.first, self.first + self.size, _BASE)
        self.index(h, ids)
        self.store = Store()

    def index(self, h: np.ndarray, ids: np.ndarray) -> None:
        """A table from the top bits of a piece's hash to its id; the few ids that share a slot are
        looked up by search."""
        self.lengths = np.unique(self.size[ids]).tolist()
        self.hash = h
        slot = (h[ids] >> _U64(64 - _SLOT_BITS)).astype(np.int64)
        self.slots = np.full(1 << _SLOT_BITS, -1, dtype=np.int32)
        self.slots[slot] = ids
        crowded = ids[np.bincount(slot, minlength=1 << _SLOT_BITS)[slot] > 1]
        self.crowded = crowded[np.argsort(h[crowded])]
        self.slots[slot[np.isin(ids, crowded)]] = -2

    def find(self, h: np.ndarray) -> np.ndarray:
        """Ids of pieces by hash, -1 for none."""
        out = self.slots[(h >> _U64(64 - _SLOT_BITS)).astype(np.int64)]
        some = np.flatnonzero(out == -2)
        if len(some):
            at = np.minimum(np.searchsorted(self.hash[self.crowded], h[some]), len(self.crowded) - 1)
            out[some] = self.crowded[at]
        return np.where(self.hash[out] == h, out, -1)  # an empty slot compares with some piece of another slot

    def lattice(self, names: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[Lattice, np.ndarray]:
        """(lattice, number in it of each of some distinct segments).  A worker process remembers the
        first segments it meets, up to ``KNOWN_EDGES`` edges; the others are built again."""
        known = self.store.names
        order = np.argsort(known)
        at = np.searchsorted(known, names, sorter=order)
        at[at == len(known)] = 0
        number = order[at] if len(order) else at
        met = known[number] == names if len(order) else np.zeros(len(names), dtype=bool)
        met[met] = self.store.same(number[met], data, start[met], end[met])
        new = np.flatnonzero(~met)
        size = end[new] - start[new]
        edge = np.cumsum(size) - size
        flat = np.full(size.sum() + len(new), 32, dtype=np.uint8)
        flat[np.repeat(np.arange(len(new)) + 1, size) + np.arange(size.sum())] = data[np.repeat(start[new] - edge, size) + np.arange(size.sum())]
        number[new] = len(known) + np.arange(len(new))
        return self.store.with_new(Lattice(self, flat, size + 1), names[new], flat, size + 1), number

    @classmethod
    def of(cls, path: str) -> Vocabulary:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]


class Store:
    """Lattices kept one behind another in arrays that have room to spare."""

    KINDS = {"target": np.int32, "piece": np.int32, "log_q": np.float64, "upto": np.float32, "first_edge": np.int32, "is_end": np.bool_, "base": np.int64, "ways": np.float64}

    def __init__(self):
        self.room = {k: np.zeros(0, dtype=t) for k, t in self.KINDS.items()}
        self.names = np.zeros(0, dtype=np.uint64)
        self.text, self.start = np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)  # the kept segments, a space before each
        self.edges = self.nodes = 0

    def same(self, number: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether the kept segments ``number`` are the bytes ``data[start:end]``."""
        return W.same_spans(data, start, end, self.text, self.start[number] + 1, self.start[number + 1])

    def with_new(self, new: Lattice, names: np.ndarray, flat: np.ndarray, size: np.ndarray) -> Lattice:
        """What is kept, then ``new`` of the segments ``flat``; it is kept too while no more than KNOWN_EDGES are."""
        edges, nodes, segments = self.edges, self.nodes, len(self.names)
        starts = {"first_edge": nodes, "is_end": nodes, "base": segments, "ways": segments}
        out = object.__new__(Lattice)
        for k in self.KINDS:
            part, at = getattr(new, k), starts.get(k, edges)
            shift = {"target": nodes, "first_edge": edges, "base": nodes}.get(k, 0)
            if at + len(part) > len(self.room[k]):
                grown = np.zeros(at + len(part) + len(part) // 4, dtype=self.KINDS[k])
                grown[:at] = self.room[k][:at]
                self.room[k] = grown
            self.room[k][at:at + len(part)] = part + np.int32(shift) if shift else part
            setattr(out, k, self.room[k][:at + len(part)])
        if edges + len(new.piece) <= KNOWN_EDGES:
            self.edges, self.nodes, self.names = edges + len(new.piece), nodes + len(new.is_end), np.concatenate([self.names, names])
            self.text, self.start = np.concatenate([self.text, flat]), np.concatenate([self.start, len(self.text) + np.cumsum(size)])
        return out


class Lattice:
    """Lattices of many segments.  Node numbers go by bytes left to the segment's end, then by
    segment, so that the backward pass runs over slices.  The edges of a node stand together,
    longest piece first."""

    def __init__(self, vocabulary: Vocabulary, flat: np.ndarray, size: np.ndarray):
        segments = len(size)
        rank = np.empty(segments, dtype=np.int64)  # the longest first: those with l bytes left are the first few
        by_size = np.argsort(-size, kind="stable")
        rank[by_size] = np.arange(segments)
        longest = int(size.max(initial=0))
        with_left = np.searchsorted(-size[by_size], -np.arange(longest + 1), side="right")  # segments of l bytes or more
        level = np.concatenate([[0], np.cumsum(with_left)])  # nodes with l bytes left begin here
        nodes = int(level[-1])
        first = np.cumsum(size) - size
        stop = (first + size)[by_size]
        # byte positions in node order: position of node (l, segment) is stop - l
        left = np.repeat(np.arange(1, longest + 1, dtype=np.int32), with_left[1:])
        owner = (np.arange(nodes - segments) - (level[left] - segments)).astype(np.int32)
        spot = (stop[owner] - left).astype(np.int32)
        lead = (flat & 0xC0) != 0x80
        char = np.cumsum(lead, dtype=np.int32) - 1
        width = np.bincount(char, minlength=int(lead.sum())) if len(flat) else np.zeros(0, int)
        known = np.zeros(len(width), dtype=bool)
        run = W._running(_CODE[flat], _BASE)
        some = np.flatnonzero(lead[spot]).astype(np.int32)
        source, length, piece = [], [], []
        for n in vocabulary.lengths:
            some = some[left[some] >= n]
            at = spot[some]
            found = vocabulary.find(W._between(run, at, at + n, _BASE))
            ok = np.flatnonzero((found >= 0) & (vocabulary.size[found] == n))
            own = char[at[ok]]
            known[own[width[own] == n]] = True
            source.append(some[ok] + np.int32(segments))
            length.append(np.full(len(ok), n, dtype=np.int16))
            piece.append(found[ok])
        spelled = np.flatnonzero(~known[char[spot]]) if len(flat) else np.zeros(0, int)
        source.insert(0, (spelled + segments).astype(np.int32))
        length.insert(0, np.ones(len(spelled), dtype=np.int16))
        piece.insert(0, vocabulary.byte_id[flat[spot[spelled]]].astype(np.int32))
        source, length, piece = (np.concatenate(x[::-1]) for x in (source, length, piece))
        order = np.argsort(source, kind="stable")  # a merge of ascending runs
        source, length, self.piece = source[order], length[order], piece[order]
        del order, piece
        gone = left[source - segments] - length
        self.target = (level[gone] + owner[source - segments]).astype(np.int32)
        self.first_edge = np.searchsorted(source, np.arange(nodes + 1)).astype(np.int32)
        beta, ways = np.full(nodes, -np.inf), np.zeros(nodes)
        beta[:segments], ways[:segments] = 0.0, 1.0
        for n in range(1, longest + 1):
            a, b = self.first_edge[level[n]], self.first_edge[level[n + 1]]
            if a == b:
                continue
            own, to = source[a:b], self.target[a:b]
            v = vocabulary.log_weight[self.piece[a:b]] + beta[to]
            head = np.flatnonzero(np.diff(own, prepend=-1))
            top = np.maximum.reduceat(v, head)
            each = np.repeat(top, np.diff(np.append(head, b - a)))
            beta[own[head]] = top + np.log(np.add.reduceat(np.exp(v - each), head))
            ways[own[head]] = np.add.reduceat(ways[to], head)
        self.log_q = vocabulary.log_weight[self.piece]
        self.log_q += beta[self.target]
        self.log_q -= beta[source]
        self.upto = np.empty(len(source), dtype=np.float32)  # per node, so the same wherever the node stands
        count, sums = np.diff(self.first_edge), np.zeros(nodes)
        own = np.flatnonzero(count)
        for j in range(int(count.max(initial=0))):
            own = own[count[own] > j]
            at = self.first_edge[own] + j
            sums[own] += np.exp(self.log_q[at])
            self.upto[at] = np.where(count[own] == j + 1, 2.0, sums[own])  # rounding never passes the last edge
        self.base = (level[size] + rank).astype(np.int64)
        self.ways = ways[self.base]
        self.is_end = np.arange(nodes) < segments

    def draw(self, segment: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """One segmentation for each entry: (edges in order, where each entry's begin, log
        probability, a hash of the segmentation)."""
        return self.draw_from(self.base[segment], key)

    def draw_from(self, start: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``draw`` from a node on, for each entry."""
        n, who = len(start), np.flatnonzero(~self.is_end[start])
        node = start[who]
        taken = []
        while len(who):
            u = _uniform(W.mix(key[who] + _U64(len(taken))))
            edge = self.first_edge[node]
            behind = np.flatnonzero(self.upto[edge] <= u)
            while len(behind):
                edge[behind] += 1
                behind = behind[self.upto[edge[behind]] <= u[behind]]
            taken.append((who, edge))
            node = self.target[edge]
            on = ~self.is_end[node]
            who, node = who[on], node[on]
        count = np.bincount(np.concatenate([w for w, _ in taken]), minlength=n) if taken else np.zeros(n, np.int64)
        first = np.concatenate([[0], np.cumsum(count)])
        edges = np.empty(first[-1], dtype=np.int64)
        for step, (w, e) in enumerate(taken):
            edges[first[w] + step] = e
        sums = np.concatenate([[0.0], np.cumsum(self.log_q[edges])])
        hashes = np.concatenate([np.zeros(1, _U64), np.cumsum(W.mix(edges.astype(np.uint64)), dtype=_U64)])
        return edges, first, sums[first[1:]] - sums[first[:-1]], hashes[first[1:]] - hashes[first[:-1]]

    def draw_other(self, segment: np.ndarray, bars: list[list[np.ndarray]], key: np.ndarray) -> list[tuple[float, np.ndarray]]:
        """(log probability, edges) for each entry: a segmentation drawn from those that are not among its
        ``bars``, of which there must be some.  Every one of them leaves the tree of the barred ones at one node by
        one edge; the edges that leave it are weighed, one is drawn, and the rest of the way is drawn freely."""
        entry = np.repeat(np.arange(len(bars)), [len(b) for b in bars])
        paths = [p for b in bars for p in b]
        size = np.array([len(p) for p in paths])
        edge = np.concatenate(paths)
        log_before = np.concatenate([np.cumsum(self.log_q[p]) - self.log_q[p] for p in paths])
        owner, first = np.repeat(entry, size), np.cumsum(size) - size
        mixed = W.mix(edge.astype(np.uint64))
        run = np.cumsum(mixed, dtype=_U64) - mixed
        prefix = W.mix(owner.astype(np.uint64)) + run - np.repeat(run[first], size)
        node = np.empty(len(edge), dtype=np.int64)
        node[1:] = self.target[edge[:-1]]
        node[first] = self.base[segment[entry]]
        _, tree, same = np.unique(prefix, return_index=True, return_inverse=True)
        inside = np.unique(same * len(self.target) + edge)
        place = np.argsort(tree)  # the tree's nodes by entry, barred path and place in it
        at = tree[place]
        begin = self.first_edge[node[at]].astype(np.int64)
        count = self.first_edge[node[at] + 1] - begin
        which = np.repeat(np.arange(len(at)), count)
        leaving = np.arange(count.sum()) + np.repeat(begin - (np.cumsum(count) - count), count)
        out = ~np.isin(place[which] * len(self.target) + leaving, inside)
        which, leaving = at[which[out]], leaving[out]
        whose = owner[which]
        head = np.searchsorted(whose, np.arange(len(bars)))
        draws = W.mix(key[whose] + (np.arange(len(whose)) - head[whose]).astype(np.uint64))
        value = log_before[which] + self.log_q[leaving] - np.log(-np.log(_uniform(draws)))
        hit = np.flatnonzero(value == np.maximum.reduceat(value, head)[whose])
        hit = hit[np.unique(whose[hit], return_index=True)[1]]
        edges, cut, log_p, _ = self.draw_from(self.target[leaving[hit]], W.mix(key + _U64(1)))
        log_p += log_before[which[hit]] + self.log_q[leaving[hit]]
        path_first = np.repeat(first, size)[which[hit]]
        return [(log_p[i], np.concatenate([edge[path_first[i]:which[hit[i]]], leaving[hit[i]:hit[i] + 1], edges[cut[i]:cut[i + 1]]]))
                for i in range(len(bars))]


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> _U64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def _cut_gumbel(location: np.ndarray, most: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Gumbel draws at a location, given that they are at most ``most``."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        out = location - np.log(np.exp(location - most) - np.log(_uniform(h)))
    return np.where(np.isneginf(location), -np.inf, out)


class _Chunk:
    """The segments of some texts, and the paths drawn for them."""

    def __init__(self, vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray, seeds: np.ndarray):
        n = len(offsets) - 1
        full = np.diff(offsets) > 0
        inside = np.ones(len(data) + 1, dtype=bool)  # not at a text's begin: the space put there is the run's first
        inside[offsets] = False
        space = data == 32
        spaces = np.flatnonzero(space & inside[:-1] & ~np.concatenate([[False], space[:-1]])) if len(data) else np.zeros(0, np.int64)
        start = np.sort(np.concatenate([offsets[:-1][full], spaces + 1]), kind="stable")
        doc = np.concatenate([np.flatnonzero(full), np.searchsorted(offsets, spaces, side="right") - 1])
        doc = np.sort(doc, kind="stable")
        last = np.concatenate([doc[1:] != doc[:-1], [True]]) if len(doc) else np.zeros(0, bool)
        end = np.empty(len(start), dtype=np.int64)
        end[:-1] = start[1:] - 1
        end[last] = offsets[doc[last] + 1]
        names = W.hash_spans(data, start, end)
        first, which = W.distinct_spans(data, start, end, names)
        self.lattice, number = vocabulary.lattice(names[first], data, start[first], end[first])
        self.which = number[which]
        self.n, self.doc, self.seeds = n, doc.astype(np.int32), seeds
        self.first = np.searchsorted(doc, np.arange(n + 1))
        self.place = (np.arange(len(doc)) - self.first[doc]).astype(np.int32)
        self.which = self.which.astype(np.int32)
        self.runs: list[tuple] = []

    def key(self, stream: int, at: np.ndarray) -> np.ndarray:
        """What draws of a stream depend on, for the segments ``at``."""
        return W.mix(W.mix(self.seeds + _U64(stream))[self.doc[at]] + self.place[at].astype(np.uint64))

    def samples(self, k: int) -> list[tuple]:
        """Per rank: (texts that have it, log probability, perturbed, path).  A path names, for
        each segment, the run that holds its segmentation."""
        lat, n = self.lattice, self.n
        log_q = np.zeros((k, len(self.doc)))
        hashes = np.zeros((k, len(self.doc)), dtype=np.uint64)
        value = -np.log(-np.log(_uniform(W.mix(self.seeds + _U64(101)))))
        path = np.zeros(len(self.doc), dtype=np.int8)
        fresh = np.ones(len(self.doc), dtype=bool)
        branch = np.full(n, -1)
        has = np.ones(n, dtype=bool)
        out, opened = [], []
        for r in range(k):
            if r:
                values = np.stack([o[0] for o in opened], axis=1)
                best = np.argmax(values, axis=1)
                rows = np.arange(n)
                value, has = values[rows, best], ~np.isneginf(values[rows, best])
                branch = np.stack([o[1] for o in opened], axis=1)[rows, best]
                parent = np.stack([o[2] for o in opened], axis=1)[rows, best]
                barred = np.stack([o[3] for o in opened], axis=1)[rows, best]
                for c, o in enumerate(opened):
                    o[0][best == c] = -np.inf
                paths = np.stack([p for *_, p in out])
                fresh = has[self.doc] & (self.place >= branch[self.doc])
                path = np.where(fresh, r, paths[parent[self.doc], np.arange(len(self.doc))]).astype(np.int8)
            at = np.flatnonzero(fresh)
            edges, first, log_q[r, at], hashes[r, at] = lat.draw(self.which[at], self.key(r, at))
            where = np.zeros(len(self.doc), dtype=np.int64)
            where[at] = np.arange(len(at))
            self.runs.append([edges, first, where, {}])
            if r:
                docs = np.flatnonzero(has)
                self._other(docs, self.first[docs] + branch[docs], barred[docs], r, log_q, hashes)
            own = log_q[path, np.arange(len(self.doc))]
            run = np.concatenate([[0.0], np.cumsum(own)])
            before = run[:-1] - run[self.first[self.doc]] if len(own) else own
            total = run[self.first[1:]] - run[self.first[:-1]]
            out.append((has.copy(), total, value.copy(), path))
            # siblings of each later choice on this path
            with np.errstate(divide="ignore"):
                rest = np.where(lat.ways[self.which] > 1, np.log(np.maximum(-np.expm1(np.minimum(own, 0.0)), 0)), -np.inf)
            later = has[self.doc] & (self.place > branch[self.doc])
            v = np.where(later, _cut_gumbel(before + rest, value[self.doc], W.mix(self.key(r, np.arange(len(self.doc))) + _U64(202))), -np.inf)
            for _ in range(k):
                opened.append(self._pop_best(v, path, r))
            if r:  # what else could stand where this path left its parent
                seg = np.minimum(self.first[:-1] + np.maximum(branch, 0), max(len(self.doc) - 1, 0))
                mask = barred | (1 << r)
                if len(self.doc):
                    gone = sum(np.where(mask >> j & 1, np.exp(log_q[j, seg]), 0.0) for j in range(r + 1))
                    count = sum((mask >> j & 1) for j in range(r + 1))
                    with np.errstate(divide="ignore"):
                        location = before[seg] + np.where(has & (lat.ways[self.which[seg]] > count), np.log(np.maximum(1 - gone, 0)), -np.inf)
                    opened.append([_cut_gumbel(location, value, W.mix(self.seeds + _U64(303 + r))), branch, np.full(n, r), mask])
        rest = np.max(np.stack([o[0] for o in opened], axis=1), axis=1)
        return [(h, t, v, _inclusion(t, rest), p) for h, t, v, p in out]

    def _pop_best(self, v: np.ndarray, path: np.ndarray, r: int) -> list:
        """The largest open value of each text, taken out of v: [value, segment place, path, barred runs]."""
        top, at = np.full(self.n, -np.inf), np.zeros(self.n, dtype=np.int64)
        some = np.flatnonzero(np.diff(self.first) > 0)
        if len(some):
            top[some] = np.maximum.reduceat(v, self.first[some])
            hit = np.flatnonzero(~np.isneginf(v) & (v == top[self.doc]))
            at[self.doc[hit[::-1]]] = hit[::-1]
            v[at[~np.isneginf(top)]] = -np.inf
        seg = np.minimum(at, max(len(self.doc) - 1, 0))
        bars = (1 << path[seg].astype(np.int64)) if len(self.doc) else np.zeros(self.n, np.int64)
        return [top, at - self.first[:-1], np.full(self.n, r), bars]

    def _other(self, docs, seg, barred, r, log_q, hashes) -> None:
        """Draw the segments where paths branch again until they differ from the barred segmentations."""
        lat, runs = self.lattice, self.runs[r]
        attempt = 0
        todo = np.flatnonzero(self._is_barred(seg, barred, r, hashes))
        while len(todo) and attempt < _RETRIES:
            attempt += 1
            at = seg[todo]
            edges, first, log_q[r, at], hashes[r, at] = lat.draw(self.which[at], W.mix(self.key(r, at) + _U64(1000 + attempt)))
            for i, s in enumerate(at):
                runs[3][int(s)] = edges[first[i]:first[i + 1]]
            todo = todo[self._is_barred(at, barred[todo], r, hashes)]
        if len(todo):  # nearly all the weight is barred: draw among what is left
            at = seg[todo]
            bars = [[self._edges(j, int(s)) for j in range(r) if barred[i] >> j & 1] for i, s in zip(todo, at)]
            for s, (p, e) in zip(at, lat.draw_other(self.which[at], bars, W.mix(self.key(r, at) + _U64(5000)))):
                log_q[r, s], hashes[r, s], runs[3][int(s)] = p, np.sum(W.mix(e.astype(np.uint64)), dtype=_U64), e

    def _edges(self, r: int, s: int) -> np.ndarray:
        """The segmentation of a segment in a run."""
        edges, first, where, redrawn = self.runs[r]
        return redrawn[s] if s in redrawn else edges[first[where[s]]:first[where[s] + 1]]

    def _is_barred(self, seg, barred, r, hashes) -> np.ndarray:
        same = np.zeros(len(seg), dtype=bool)
        for j in range(r):
            same |= (barred >> j & 1).astype(bool) & (hashes[j, seg] == hashes[r, seg])
        return same

    def ids(self, path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece ids of a path, where each text's begin)."""
        count, start = np.zeros(len(self.doc), dtype=np.int64), np.zeros(len(self.doc), dtype=np.int64)
        pool, shift = [], 0
        for r, (edges, first, where, redrawn) in enumerate(self.runs):
            own = np.flatnonzero(path == r)
            start[own], count[own] = first[where[own]] + shift, first[where[own] + 1] - first[where[own]] if len(own) else 0
            pool.append(edges)
            shift += len(edges)
            mine = [(s, e) for s, e in redrawn.items() if path[s] == r]
            for s, e in mine:
                start[s], count[s] = shift, len(e)
                pool.append(e)
                shift += len(e)
        edges = np.concatenate(pool) if pool else np.zeros(0, np.int64)
        total = np.concatenate([[0], np.cumsum(count)])
        at = np.repeat(start - total[:-1], count) + np.arange(total[-1])
        return self.lattice.piece[edges[at]], total[self.first]



def _inclusion(log_p: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """log(1 - exp(-exp(log_p - rest))), without loss for small values."""
    x = log_p - rest
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        big = np.log(-np.expm1(-np.exp(np.minimum(x, 50.0))))
    return np.where(np.isneginf(rest), 0.0, np.where(x < -30, x, big))


_ROW = "doc_id long, sample int, n_pieces long, log_prob double, perturbed double, log_inclusion double, ids binary"


def _encode(model: str, k: int, seed: int, keep: tuple[str, ...]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        vocabulary = Vocabulary.of(model)
        for batch in batches:
            keys = batch.column("doc_id").fill_null(0).to_numpy().view(np.uint64)
            seeds = W.mix(W.mix(keys) + _U64(seed))
            for row, data, offsets in W.chunks(batch.column("text"), CHUNK_BYTES):
                n = len(offsets) - 1
                chunk = _Chunk(vocabulary, data, offsets, seeds[row:row + n])
                for rank, (has, log_p, value, inclusion, path) in enumerate(chunk.samples(k)):
                    ids, cut = chunk.ids(path)
                    ids = ids.astype("<u4")
                    own = np.flatnonzero(has)
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).slice(row, n).take(pa.array(own)) for c in ("k_" + x for x in keep)),
                         batch.column("doc_id").slice(row, n).take(pa.array(own)), pa.array(np.full(len(own), rank + 1, np.int32)), pa.array(np.diff(cut)[own]),
                         *(pa.array(np.round(x[own], 6)) for x in (log_p, value, inclusion)), pa.array([ids[cut[d]:cut[d + 1]].tobytes() for d in own], pa.binary())],
                        names=[*keep, *(x.split()[0] for x in _ROW.split(", "))])

    return rows


def encode(docs: DataFrame, model: str, k: int = SAMPLES, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """Up to k rows per document, in the order drawn: the columns ``keep`` of docs, then (doc_id, sample from 1,
    n_pieces, log_prob, perturbed, log_inclusion, ids as little-endian 32-bit numbers)."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).alias("k_" + c) for c in keep])
    kept = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return texts.mapInArrow(_encode(model, k, seed, keep), kept + _ROW)


def decode_ids(vocabulary: Vocabulary, ids: np.ndarray) -> bytes:
    """UTF-8 text of piece ids: their bytes, less the space put before the text."""
    size = vocabulary.size[ids]
    at = np.repeat(vocabulary.first[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return vocabulary.flat[at].tobytes()[1:]


def _decode(model: str, own: list[str], digest: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.of(model)
        for batch in batches:
            raw = [x.as_buffer() for x in batch.column("ids")]
            texts = [decode_ids(vocabulary, np.frombuffer(x, dtype="<u4")) for x in raw]
            out = pa.array([zlib.crc32(t) for t in texts], pa.int64()) if digest else pa.array([t.decode("utf-8") for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array([zlib.crc32(x) for x in raw], pa.int64()), out],
                                             names=[*own, "ids_crc32", "text_crc32" if digest else "text"])

    return rows


def decode(samples: DataFrame, model: str) -> DataFrame:
    """``samples`` with ``ids_crc32``, of the ids, and ``text``, what they spell, instead of the ids."""
    own = [f for f in samples.schema.fields if f.name != "ids"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own) + ", ids_crc32 long, text string"
    return samples.mapInArrow(_decode(model, [f.name for f in own], False), schema)


def round_trips(docs: DataFrame, model: str, k: int = SAMPLES, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The samples of ``encode``, each decoded again in the same task: ``ids_crc32`` is of its ids,
    ``round_trip`` says whether they spell the text."""
    encode_rows = _encode(model, k, seed, ("crc",))
    fields = [x.split() for x in ("crc long, " + _ROW).split(", ") if not x.startswith("ids ")]
    decode_rows = _decode(model, [f[0] for f in fields], True)
    text = F.coalesce(F.col(text_col), F.lit(""))
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.crc32(text.cast("binary")).alias("k_crc"))
    schema = ", ".join(" ".join(f) for f in fields) + ", ids_crc32 long, text_crc32 long"
    out = texts.mapInArrow(lambda batches: decode_rows(encode_rows(batches)), schema)
    return out.withColumn("round_trip", F.col("text_crc32") == F.col("crc")).drop("text_crc32", "crc")
