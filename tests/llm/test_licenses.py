import random
import re

import pytest

from sparkmill.llm import licenses
from sparkmill.llm.license_templates import PHRASES, TEMPLATES
from tests.llm.helpers import docs

MARK = re.compile(r"<<[a-zA-Z]+(?:;[a-z]+=\"[^\"]*\")*>>")


def folded(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def pattern(parts):
    """A template as one pattern over words with a space behind each."""
    out = ""
    for p in parts:
        if isinstance(p, licenses.Optional):
            out += "(?:" + pattern(p.parts) + ")?"
        elif isinstance(p, licenses.Replaceable):
            out += "(?:[^ ]+ ){%d,%d}" % (p.least, p.most)
        else:
            out += re.escape(p) + " "
    return out


def brute(text, templates=TEMPLATES):
    words = folded(text)
    joined = " " + "".join(w + " " for w in words)
    base = [(i, label) for phrase, label in PHRASES for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    own = [(label, family) for label, family, t in templates if re.search("(?<= )" + pattern(licenses.parse(t)), joined)]
    named = {x for _, x in base}
    proved = {x for x, _ in own} | (named & {f for _, f in own})
    labels = named | proved
    at = [i for i, _ in base]
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(named)), ",".join(sorted(labels)),
            (len(proved) + 0.5 * len(labels - proved)) / len(labels) if labels else 0.0)


def spelled(rng, parts, wrong=0.0):
    """A random spelling of a template; with ``wrong`` some mandatory words are changed."""
    out = []
    for p in parts:
        if isinstance(p, licenses.Optional):
            out += spelled(rng, p.parts, wrong) if rng.random() < 0.5 else []
        elif isinstance(p, licenses.Replaceable):
            out += rng.choices(["Jane", "Doe", "2020", "the", "software", "1"], k=rng.randint(p.least, p.most))
        else:
            out.append("other" if rng.random() < wrong else p)
    return out


def texts():
    rng = random.Random(3)
    out = []
    for label, _, t in TEMPLATES:
        parts = licenses.parse(t)
        for wrong in (0, 0, 0, 0.01, 0.3):
            body = spelled(rng, parts, wrong)
            sep = rng.choice([" ", ", ", "\n * ", " -- "])
            out.append("see below. " + sep.join(w.upper() if rng.random() < 0.3 else w for w in body) + rng.choice(["", " the end", "."]))
            out.append(sep.join(body))
    out += ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "cc by", "CC BY CC BY",
            "This work is licensed under the GNU General Public License, version 3.", "the mit licenseé", "mit-license mit license mit  license",
            "GNU general\npublic license apache license", "wholly other words", None, "", " ", "ﬀ MIT LICENSE \U0001f600"]
    return list(enumerate(out)) + [(5000, "mit license"), (5000, "mit license"), (None, "apache license")]


def test_same_as_patterns(spark):
    data = texts()
    got = licenses.scan(docs(spark, data)).collect()
    seen = sorted((str(r["doc_id"]), *map(str, (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]))) for r in got)
    assert seen == sorted((str(i), *map(str, brute(t))) for i, t in data)
    accepted = {s["label"] for r in got for s in r["spans"]}
    assert accepted == {label for label, *_ in TEMPLATES}


def test_spans_hold_whole_spellings(spark):
    for r in licenses.scan(docs(spark, texts())).collect():
        words = folded(dict(texts()).get(r["doc_id"])) if r["doc_id"] is not None else []
        for s in r["spans"]:
            own = "".join(w + " " for w in words[s["start"]:s["end"]])
            assert any(re.fullmatch(pattern(licenses.parse(t)), own) for label, _, t in TEMPLATES if label == s["label"])


def test_regions():
    number = {w: i + 1 for i, w in enumerate("abcd")}

    def longest(text, words):
        return licenses.Automaton(licenses.parse(text), number).longest(licenses.np.array([number.get(w, 0) for w in words.split()]))

    assert longest("a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> d", "a b c d") == 4
    assert longest("a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> d", "a d d") == 2
    assert longest("a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> d", "a c d") == -1
    assert longest('a <<var;name="x";original="y";match=".{1,2}">> d', "a d d d d") == 4
    assert longest('a <<var;name="x";original="y";match=".{1,2}">> d', "a d") == -1
    assert longest('<<var;name="x";match=".{0,2}">>', "") == 0
    for bad in ("<<beginOptional>> a", "a <<endOptional>>", '<<var;name="x">> a', '<<var;match=".{3,2}">> a', '<<var;match=".+">> a'):
        with pytest.raises(ValueError):
            licenses.parse(bad)
    with pytest.raises(ValueError):
        licenses.Matcher((("x", None, '<<var;match=".{0,2}">>'),))


def test_words_named_like_regions(spark):
    own = (("x", None, "optional words <<beginOptional>>parts<<endOptional>> most"),)
    got = licenses.scan(docs(spark, [(1, "optional words most"), (2, "optional words parts most"), (3, "optional most")]), own).collect()
    assert {r["doc_id"]: r["labels"] for r in got} == {1: "x", 2: "x", 3: ""}


def test_long_text_of_anchors(spark):
    anchor = "permission is hereby granted free of charge to any person obtaining a copy "
    text = anchor * 60_000 + "mit license"
    r = licenses.scan(docs(spark, [(1, text)])).first()
    assert (r["n_words"], r["n_base"], r["first_word"], r["labels"]) == (780_002, 1, 780_000, "mit") and r["score"] == 0.5


def test_empty_table(spark):
    assert licenses.scan(docs(spark, [])).collect() == []


def test_markup_is_all_read():
    for _, _, t in TEMPLATES:
        assert "<<" not in MARK.sub("", t)
