import hashlib
import random
import re

import pytest

from sparkmill.llm import decontam
from tests.llm.helpers import docs


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def windows(items, k):
    out = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - k + 1)):
            part = tuple(w[i:i + k])
            if part:
                out.setdefault(part, set()).add("null" if item is None else str(item))
    return out


def brute(rows, items, k):
    find = windows(items, k)
    out = []
    for doc_id, text in rows:
        w, hit, own = words(text), set(), set()
        for part, names in find.items():
            for i in range(len(w) - len(part) + 1):
                if tuple(w[i:i + len(part)]) == part:
                    hit.update(range(i, i + len(part)))
                    own |= names
        out.append((doc_id, len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def tables(rng):
    vocabulary = ["the", "Of", "élan", "x1", "漢字", "and", "rare"] + [f"w{i}" for i in range(30)]
    text = lambda n: rng.choice([" ", "-", ", "]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(1, 12))) for i in range(12)] + [(20, text(40)), (21, None), (22, "...---"), (None, "rare rare w1"), (20, "w2 w3 w4 w5 w6 w7"), (2, "the of the of the of")]
    rows = [(i, " ".join(rng.choice([text(5), rng.choice(items)[1] or "", "the of " * 3]) for _ in range(6))) for i in range(50)]
    rows += [(60, None), (61, ""), (62, "!!"), (63, items[12][1].upper()), (63, items[12][1].upper()), (None, items[12][1])]
    return rows, items


@pytest.mark.parametrize("block_bytes,window", [(1 << 20, 13), (60, 5)])
def test_matches_brute_force(spark, block_bytes, window):
    rows, items = tables(random.Random(window))
    bench = spark.createDataFrame([(t, i, 0) for i, t in items], "text string, item_id long, doc_id int")
    index = decontam.build_index(docs(spark, rows).repartition(3), bench)
    got = decontam.search(index, bench, window, block_bytes=block_bytes).drop("items", "spans")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(rows, items, window)))


def test_proximity(spark):
    rows, items = tables(random.Random(9))
    k, slop = 4, 2
    bench = spark.createDataFrame([(t, i) for i, t in items], "text string, item_id long")
    got = decontam.search(decontam.build_index(docs(spark, rows), bench), bench, k, slop)
    counts = {}
    for _, text in rows:
        for w in words(text):
            counts[w] = counts.get(w, 0) + 1
    expected = []
    for doc_id, text in rows:
        w, spots = words(text), set()
        for part in windows(items, k):
            reach = len(part) + slop - 1
            least = min(counts.get(x, 0) for x in part)
            for i, x in enumerate(w):
                near = set(w[max(0, i - reach):i + reach + 1])
                if x in part and counts[x] == least and set(part) <= near:
                    spots.add((part, i))
        expected.append((doc_id, {i for _, i in spots}))
    # with equal counts any of the rarest terms may be the one looked at
    for r, (doc_id, spots) in zip(sorted(got.collect(), key=lambda r: str((r["doc_id"], r["n_words"]))), sorted(expected, key=lambda x: str((x[0], 0)))):
        assert {a for a, _ in r["spans"]} <= spots or r["doc_id"] is None or r["doc_id"] == 63
        assert bool(r["spans"]) == bool(spots) or r["doc_id"] is None


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    got = decontam.contamination(docs(spark, [(1, "a b c")]), bench).collect()
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in got] == [(3, 0, False)]
    assert decontam.contamination(docs(spark, []), bench).count() == 0


def test_keep_uncontaminated(spark):
    bench = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    rows = [(1, "one two three four"), (2, "one two three five"), (3, None), (1, "other"), (4, "one two three four " + "x " * 200)]
    kept = decontam.keep_uncontaminated(docs(spark, rows), bench)
    assert kept.columns == docs(spark, []).columns
    assert sorted((r["doc_id"], (r["text"] or "")[:9]) for r in kept.collect()) == [(1, "other"), (2, "one two t"), (3, ""), (4, "one two t")]
