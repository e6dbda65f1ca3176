import numpy as np
import pyarrow as pa

from sparkmill.llm import decontam, jaccard, segment, substring, tokenfile
from sparkmill.llm import words as W
from sparkmill.llm.queries import _tokenizer
from tests.llm.helpers import docs


def thue_morse(n):
    """A word of n letters and its complement: equal under any running sum modulo 2**64."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


A, B = thue_morse(1024)


def test_hashes_differ():
    w = W.split(*W.texts(pa.array([f"{A} {B} {A}", "x", "x" * 8, "x" * 9, "X" * 8])), W.non_space(lower=True))
    assert w.hash[0] == w.hash[2] != w.hash[1] and w.hash[4] == w.hash[6] and len(set(w.hash.tolist())) == 5


def test_runs_of_one_hash_are_kept_apart():
    data = np.frombuffer(b"aa bb aa cc bb a", np.uint8)
    start, end = np.array([0, 3, 6, 9, 12, 15]), np.array([2, 5, 8, 11, 14, 16])
    first, which = W.distinct_spans(data, start, end, np.zeros(6, np.uint64))
    assert [data[start[i]:end[i]].tobytes() for i in first[which]] == [b"aa", b"bb", b"aa", b"cc", b"bb", b"a"] and len(first) == 4


def test_token_ids(monkeypatch):
    from tokenizers import Tokenizer

    path = _tokenizer("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    texts = [A, B, "some other words", "words some", "", f"{B} {A}"]
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]

    def ids():
        off, flat = tokenfile.encode_texts(pa.array(texts), path)
        return [flat[off[i]:off[i + 1]].tolist() for i in range(len(texts))]

    assert ids() == want and ids() == want
    # even if all words had one hash
    monkeypatch.setattr(tokenfile.WordIds, "_loaded", {})
    monkeypatch.setattr(W, "hash_spans", lambda data, start, end: np.zeros(len(start), np.uint64))
    assert ids() == want and ids() == want


def test_segments(spark):
    path = _tokenizer("piece_bpe_32k.model")
    got = segment.round_trips(docs(spark, [(1, A), (2, B), (3, f"{A} {B}")]), path).collect()
    assert got and all(r["round_trip"] for r in got)


def test_joins_tell_them_apart(spark):
    rest = " ".join(f"w{i}" for i in range(60))
    frame = docs(spark, [(1, A), (2, B), (3, f"{A} {A} {A} {A}"), (4, f"{B} {B} {B} {B}")])
    assert {r["doc_id"]: r["component_id"] for r in jaccard.link(frame).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    items = spark.createDataFrame([("a", A), ("b", B)], "item_id string, text string")
    assert {r["doc_id"]: r["items"] for r in decontam.contamination(frame, items).collect()} == {1: ["a"], 2: ["b"], 3: ["a"], 4: ["b"]}
    cut = substring.drop_repeated_passages(docs(spark, [(1, f"{A} {rest}"), (2, f"{B} {rest}")])).collect()
    assert {r["doc_id"]: r["n_removed"] for r in cut} == {1: 60, 2: 60}
