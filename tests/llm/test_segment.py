import collections
import itertools
import math

import numpy as np
import pyarrow as pa
import public_tokenizers

from sparkmill.llm import segment, words as W
from tests.llm.helpers import docs

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", "a", " ", "the cat  sat\n\ton ▁ mats", "naïve 漢字 \U0001f600 é", "x" * 300, "aaaa bbbb " * 30, "  end "]


class Toy(segment.Vocabulary):
    """Four letters, few pieces, near-even weights."""

    def __init__(self):
        pieces = [b" ", b"a", b"b", b" a", b"ab", b"aa", b" ab"]
        self.pieces, self.byte_id = pieces, np.full(256, -1)
        self.log_weight = np.log(np.array([.1, .2, .15, .25, .1, .1, .1]))
        self.flat = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.size = np.array([len(p) for p in pieces])
        self.first = np.cumsum(self.size) - self.size
        run = W._running(segment._CODE[self.flat], segment._BASE)
        h = W._between(run, self.first, self.first + self.size, segment._BASE)
        self.index(h, np.arange(len(pieces)))
        self.store = segment.Store()


def ways(toy, text):
    """{piece ids: probability} of all segmentations, by trying all."""
    out = {}

    def go(rest, ids, p):
        if not rest:
            out[tuple(ids)] = p
        for i, piece in enumerate(toy.pieces):
            if rest.startswith(piece) and not (b" " in rest[:len(piece)][1:]):
                go(rest[len(piece):], ids + [i], p * math.exp(toy.log_weight[i]))

    go(b" " + text.encode(), [], 1.0)
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


def sampled(toy, texts, k, seed=0):
    data, offsets = W.texts(pa.array(texts))
    chunk = segment._Chunk(toy, data, offsets, W.mix(np.arange(len(texts), dtype=np.uint64) + np.uint64(seed)))
    ranks = chunk.samples(k)
    ids = [chunk.ids(r[4]) for r in ranks]
    return [[(tuple(i[c[d]:c[d + 1]].tolist()), r[1][d], r[2][d], r[3][d]) for r, (i, c) in zip(ranks, ids) if r[0][d]] for d in range(len(texts))]


def test_sampling_without_replacement_has_the_right_law():
    toy, text, n = Toy(), "ab aab", 20000
    p = ways(toy, text)
    drawn = sampled(toy, [text] * n, 2)
    assert all(len(d) == 2 and d[0][0] != d[1][0] for d in drawn)
    assert all(d[0][2] >= d[1][2] and abs(d[0][1] - math.log(p[d[0][0]])) < 1e-9 for d in drawn)
    pairs = collections.Counter((d[0][0], d[1][0]) for d in drawn)
    for a, b in itertools.permutations(p, 2):
        expected = p[a] * p[b] / (1 - p[a])
        assert abs(pairs[a, b] / n - expected) < 5 * math.sqrt(expected / n) + 1e-3


def test_fewer_segmentations_than_samples():
    toy = Toy()
    for text in ("a", "ab", "", "aa"):
        p = ways(toy, text) if text else {(): 1.0}
        for d in sampled(toy, [text] * 50, 9):
            assert len(d) == min(9, len(p)) and len({x[0] for x in d}) == len(d)
            if len(p) < 9:
                assert {x[0] for x in d} == set(p) and all(x[3] == 0 for x in d)


def test_inclusion_scores_estimate_sums():
    """Sums of f / inclusion over the sample are unbiased: here the total probability, 1."""
    toy, text, n = Toy(), "ab aab ab", 4000
    totals = [sum(math.exp(lp - inc) for _, lp, _, inc in d) for d in sampled(toy, [text] * n, 3)]
    assert abs(np.mean(totals) - 1) < 5 * np.std(totals) / math.sqrt(n)


def test_round_trip_and_seeding(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (None, "no id"), (51, "twice"), (51, "twice"), (52, "word " * 20000)]
    draws = []
    for partitions in (1, 3):
        samples = segment.encode(docs(spark, rows).repartition(partitions), MODEL, 3, keep=("label", "hit"))
        got = segment.decode(samples, MODEL).collect()
        draws.append(sorted((str(r["doc_id"]), r["sample"], r["ids_crc32"], r["log_prob"], r["perturbed"], r["log_inclusion"]) for r in got))
    assert draws[0] == draws[1]
    assert {r["label"] for r in got} == {"x"}
    text = dict((i, t or "") for i, t in rows)
    assert all(r["text"] == text[r["doc_id"]] for r in got)
    assert [r["sample"] for r in got if r["doc_id"] == 0] == [1]
    twice = sorted(r["ids_crc32"] for r in got if r["doc_id"] == 51)
    assert twice[::2] == twice[1::2]


def test_empty_table(spark):
    assert segment.decode(segment.encode(docs(spark, []), MODEL), MODEL).count() == 0
    assert segment.round_trips(docs(spark, []), MODEL).count() == 0


def test_round_trips_equal_encode_then_decode(spark):
    frame = docs(spark, [(i, t) for i, t in enumerate(TEXTS)] + [(50, None)])
    both = segment.decode(segment.encode(frame, MODEL), MODEL).drop("text").collect()
    got = segment.round_trips(frame, MODEL)
    assert sorted(map(tuple, got.drop("round_trip").collect())) == sorted(map(tuple, both)) and got.filter("not round_trip").count() == 0


def test_remembered_lattices_do_not_change_draws(monkeypatch):
    texts = ["some words here again", "again here words", "other text 123"] * 5
    fresh = segment.Vocabulary(MODEL)
    first = sampled(fresh, texts, 3)
    assert sampled(fresh, texts, 3) == first
    monkeypatch.setattr(segment, "KNOWN_EDGES", 0)
    assert sampled(segment.Vocabulary(MODEL), texts, 3) == first


def test_law_when_nothing_is_redrawn(monkeypatch):
    monkeypatch.setattr(segment, "_RETRIES", 0)
    test_sampling_without_replacement_has_the_right_law()
    test_fewer_segmentations_than_samples()
    toy, text, n = Toy(), "aaab", 20000
    p = ways(toy, text)
    triples = collections.Counter(tuple(x[0] for x in d) for d in sampled(toy, [text] * n, 3))
    for a, b, c in itertools.permutations(p, 3):
        expected = p[a] * p[b] / (1 - p[a]) * p[c] / (1 - p[a] - p[b])
        assert abs(triples[a, b, c] / n - expected) < 5 * math.sqrt(expected / n) + 1e-3


def test_one_segmentation_holds_nearly_all_weight():
    vocabulary, n = segment.Vocabulary(MODEL), 2000
    for text in ("https://en.wikipedia.org/wiki/Category", "org.springframework.context.annotation.Configuration", "function(configuration,Application)",
                 "https://en.wikipedia.org/wiki/Category" * 20):
        drawn = sampled(vocabulary, [text] * n, 3)
        for d in drawn:
            assert len({x[0] for x in d}) == 3 and all(segment.decode_ids(vocabulary, np.array(x[0])) == text.encode() for x in d)
            assert d[0][2] >= d[1][2] >= d[2][2]
        log_p = {x[0]: x[1] for d in drawn for x in d}
        best, times = collections.Counter(d[0][0] for d in drawn).most_common(1)[0]
        for ids, seen in collections.Counter(d[1][0] for d in drawn if d[0][0] == best).most_common(5):
            expected = math.exp(log_p[ids]) / -math.expm1(log_p[best])
            assert abs(seen / times - expected) < 5 * math.sqrt(expected / times) + 1e-3


class Spaced(Toy):
    """Pieces of several spaces, with and without letters behind them."""

    def __init__(self):
        super().__init__()
        pieces = [b" ", b"a", b"b", b"  ", b"   ", b"  a", b" b"]
        self.pieces, self.flat = pieces, np.frombuffer(b"".join(pieces), dtype=np.uint8)
        self.size = np.array([len(p) for p in pieces])
        self.first = np.cumsum(self.size) - self.size
        run = W._running(segment._CODE[self.flat], segment._BASE)
        self.index(W._between(run, self.first, self.first + self.size, segment._BASE), np.arange(len(pieces)))


def test_runs_of_spaces_keep_all_their_pieces():
    toy = Spaced()

    def every(rest, ids=(), log_p=0.0):
        if not rest:
            yield ids, math.exp(log_p)
        for i, piece in enumerate(toy.pieces):
            if rest.startswith(piece):
                yield from every(rest[len(piece):], ids + (i,), log_p + toy.log_weight[i])

    for text in ("a  b", "  a", " ", "   ", "b   a ", "b    ", "a b   ab"):
        p = dict(every(b" " + text.encode()))
        total = sum(p.values())
        drawn = sampled(toy, [text] * 20 + ["", "a", text], 60)
        for d in drawn[:20] + drawn[-1:]:
            assert {x[0] for x in d} == set(p) and len(d) == len(p) < 60
            assert all(abs(x[1] - math.log(p[x[0]] / total)) < 1e-9 for x in d)


def test_shipped_pieces_of_spaces_are_drawn():
    vocabulary = segment.Vocabulary(MODEL)
    runs = {i for i, p in enumerate(vocabulary.pieces) if len(p) > 1 and not p.strip(b" ")}
    text = "x" + " " * 16 + "y\n    z"
    drawn = sampled(vocabulary, [text] * 200, 2)
    assert len(runs) == 14 and {i for d in drawn for x in d for i in x[0]} & runs
    assert all(segment.decode_ids(vocabulary, np.array(x[0])) == text.encode() for d in drawn for x in d)
