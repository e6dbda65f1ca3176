import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sparkmill.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, n long, word string, f long, shard string"


def frame(spark, rows):
    """Documents with extra columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, t, lang, 1, "w", 2, None) for i, t, lang in rows], SCHEMA)


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", low)]


def brute(rows, least=10, explained=50, top=2000):
    grams = defaultdict(Counter)
    for _, text, lang in rows:
        for words in pieces(text):
            for k in (1, 2, 3):
                grams[lang or "und"].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in grams.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        cand = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        gone = {g[s:s + 2] for g, c in cand.items() if len(g) == 3 for s in (0, 1) if 100 * c >= explained * f[g[s:s + 2]]}
        scored = []
        for g, a in cand.items():
            if g not in gone:
                score, k = min((10 ** 6 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def corpus(seed, docs=900):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "york", "city", "a", "é", "😀", "b-c", "x\x00y", "ｆ", "\x0b"] + [f"w{i}" for i in range(25)]
    rows = []
    for i in range(docs):
        words = rng.choices(vocabulary, weights=[9, 8, 6, 5, 4] + [2] * (len(vocabulary) - 5), k=rng.randrange(0, 60))
        rows.append((i, "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ", ", ". ", "\n", "?!"]) for w in words), rng.choice(["en", "en", "de", None])))
    return rows + [(9000, None, "en"), (9001, "", "en"), (9002, " . , ", "en"), (9003, "in no shard in no shard", "fr"), (None, "the of the of", None)] + [rows[3]] * 12


def got(spark, rows, **more):
    return sorted(tuple(r) for r in C.collocations(frame(spark, rows).repartition(3), **more).collect())


@pytest.mark.parametrize("shard_bytes", [200, 1 << 20])
def test_same_as_counters(spark, shard_bytes):
    rows = corpus(1)
    want = brute(rows)
    assert got(spark, rows, shard_bytes=shard_bytes) == want
    assert len({r[0] for r in want}) == 3 and any(len(r[2].split(" ")) == 3 for r in want)


def test_ties_limits_and_undecided_language(spark):
    rows = [(i, "p q r. s t u. " * 12, "en") for i in range(2)] + [(5, "a a a a a a a a a a a a a a", None), (6, "a a a a a a", "und")]
    for more in ({}, {"top": 2}, {"least": 3, "explained": 101}, {"least": 1, "explained": 0}):
        assert got(spark, rows, **more) == brute(rows, **more)


def test_long_text_and_whole_pieces(spark):
    rng = random.Random(7)
    long = " ".join(rng.choices(["x", "y", "z", "u v", "t,"], k=40_000))
    rows = [(1, long, "en"), (2, long.replace(",", ""), "en"), (3, "u v " * 30, "de")]
    assert got(spark, rows, shard_bytes=5000) == brute(rows)


def test_words_of_one_hash_lead_to_another_seed(spark, monkeypatch):
    tried = []
    real = C.shards

    def clashing(docs, lang_col, text_col, shard_bytes, seed):
        tried.append(seed)
        out = real(docs, lang_col, text_col, shard_bytes, seed)
        return out.withColumn("hashes", C.F.transform("hashes", lambda _: C.F.lit(1).cast("long"))) if seed == 0 else out

    monkeypatch.setattr(C, "shards", clashing)
    rows = corpus(2, 40)
    assert got(spark, rows, least=3) == brute(rows, least=3) and tried == [0, 1]


def test_empty_table(spark):
    assert got(spark, []) == [] and got(spark, [(1, None, "en"), (2, "", None)]) == []


def test_score_beyond_64_bits(spark):
    a, l, r = 10 ** 14 - 3, 10 ** 15 + 7, 10 ** 14 + 11
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long").select(C.score("a", "l", "r")).first()
    assert row[0] == 10 ** 6 * a * a // (l * r)


def test_intervals_of_both_sides():
    rng = np.random.default_rng(1)
    for size, symbols in ((400, 4), (300, 70_000)):
        seq = rng.integers(0, symbols, size).astype(np.uint32)
        seq[-1] = 0
        index = C.Index.of(seq, depth=3)
        text = seq.tolist()
        want = Counter(tuple(text[i:i + 3]) for i in range(size - 2) if 0 not in text[i:i + 3])
        word, left, right, n = index.words()
        for first, second in ((1, 0), (0, 1), (1, 1), (0, 0)):
            phrase, at, count = [(w,) for w in word.tolist()], [left, right], n
            for side in (first, second):
                owner, new, count, smaller = index.extend(side, at[1 if side else 0], count)
                own = at[1 if side else 0][owner]
                other = at[0 if side else 1][owner] + smaller
                grown = index.rank(side, new, own)
                at = [other, grown] if side else [grown, other]
                phrase = [phrase[o] + (w,) if side else (w,) + phrase[o] for o, w in zip(owner.tolist(), new.tolist(), strict=True)]
            assert dict(zip(phrase, count.tolist(), strict=True)) == want


def test_cuts_keep_pieces_whole():
    data = np.frombuffer(b"aaaa.bb.cccccccccccc.d.e", np.uint8)
    for room in range(0, 9):
        cuts = C._cuts(data, room, 8)
        assert all(c == 0 or C._ENDS[data[c - 1]] for c in cuts) and cuts == sorted(cuts)
