import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sparkmill.llm import infill
from tests.llm.helpers import docs

SHA = lambda t: hashlib.sha256(t.encode()).hexdigest()


def plain(doc_id, text, seed=1):
    """The transformation by slices of code points."""
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


def rows():
    rng = random.Random(5)
    signs = ["a", "\n", "\r\n", "é", "😀", "<", "S", ">", "$1", "\\", "<P", "M>", " ", " ", "\x00", "é"]
    out = [(i, "".join(rng.choices(signs, k=rng.randrange(0, 60)))) for i in range(400)]
    out += [(1000, None), (1001, ""), (1002, "has <S> in it"), (1003, "<M>"), (None, "no id at all"), (1004, "x"), (1004, "x")]
    return out + [(2000 + k, "é" * n) for k, n in enumerate((4095, 4096, 4097, 8192, 12289))]


def test_same_as_slices(spark):
    data = rows()
    got = infill.transform(docs(spark, data)).withColumn("again", infill.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(data)
    seen = sorted((str(r["doc_id"]), r["text"], r["n"], r["form"], r["prefix_units"], r["middle_units"], r["output"]) for r in got)
    assert seen == sorted((str(i), t or "", *plain(i, t)) for i, t in data)
    assert all(r["again"] == r["text"] for r in got)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_report_digests(spark):
    got = {(r["doc_id"], r["n"]): r for r in infill.report(docs(spark, rows())).collect()}
    for i, t in rows():
        n, form, a, m, out = plain(i, t)
        r = got[i, n]
        assert (r["form"], r["prefix_chars"], r["middle_chars"], r["output_sha256"], r["restored_sha256"]) == (form, a, m, SHA(out), SHA(t or ""))


def test_text_of_megabytes(spark):
    text = "ab\n😀é" * 1_000_000
    r = infill.report(docs(spark, [(7, text)])).first()
    n, form, a, m, out = plain(7, text)
    assert form != "plain" and (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, a, m)
    assert r["output_sha256"] == SHA(out) and r["restored_sha256"] == SHA(text)


def test_own_marks_and_rates(spark):
    marks = ("[$1]", "{\\2}", "|^3#")
    data = [(i, f"text {i} with $1 and \\2 ^") for i in range(60)] + [(99, "a [$1] b")]
    got = infill.transform(docs(spark, data), marks=marks, transformed=100, suffix_first=50)
    got = got.withColumn("again", infill.restored(F.col("output"), F.col("form"), marks)).collect()
    assert all(r["again"] == r["text"] for r in got)
    assert [r["doc_id"] for r in got if r["form"] == "plain"] == [99]
    for bad in (("a", "b"), ("x", "x", "y"), ("ab", "bc", "d"), ("aba", "c", "d"), ("", "b", "c"), ("abc", "b", "d")):
        with pytest.raises(ValueError):
            infill.transform(docs(spark, data), marks=bad)


def test_empty_table_and_no_python(spark):
    frame = infill.report(docs(spark, []))
    assert frame.collect() == []
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
