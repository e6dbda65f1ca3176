import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sparkmill.llm import tokenfile
from tests.llm.helpers import docs, key

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "Hello  WORLD", "tab\tand\nline\x0b\x0c\r end", "é ́x", "<|endoftext|> a<|startoftext|>b", "\x01 a\x01b \x01", "ΑΣ ΑΣΑ ΣΑΣ",
       "漢字 \U0001f600", "don't we'll I'VE", " nb sp", "İstanbul ǅ", "x" * 5000, "12345 a1b2", "a " * 3000, "\x00\x02 b"]


def test_ids_equal_whole_text_encoding():
    import pyarrow as pa

    tok = Tokenizer.from_file(PATH)
    rng = random.Random(0)
    texts = ODD + [" ".join(rng.choice(ODD) for _ in range(4)) for _ in range(30)]
    for _ in range(2):  # the second time from memory
        offset, flat = tokenfile.encode_texts(pa.array(texts), PATH)
        for i, t in enumerate(texts):
            assert flat[offset[i]:offset[i + 1]].tolist() == tok.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 2, 5, 1000, 6000])
def test_minimal_perfect_hash(n):
    rng = np.random.default_rng(n)
    h = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
    seeds, slot = tokenfile.build_hash(h)
    assert sorted(slot.tolist()) == list(range(len(h)))


def test_keyed_access():
    keys = np.array([0, 0, -7, 3, 3, 3, 10 ** 12])
    null = np.array([True, False, False, False, False, False, False])
    offsets = np.array([0, 1, 2, 5, 5, 6, 8, 9])
    ids = np.arange(9, dtype=np.uint32) + 70000
    raw = b"skip" + tokenfile.Shard.write(keys, null, offsets, ids)
    shard, end = tokenfile.Shard.read(raw, 4)
    assert end == len(raw) and shard.get(None).tolist() == [70000] and shard.get(0).tolist() == [70001]
    assert shard.get(3, 0).tolist() == [] and shard.get(3, 2).tolist() == [70006, 70007] and shard.get(-7).tolist() == [70002, 70003, 70004]
    assert sum(shard.get(k) is not None for k in range(100, 1100)) == 0


@pytest.mark.parametrize("shard_bytes", [200, 1 << 20])
def test_files_match_brute_force(spark, tmp_dir, shard_bytes):
    rng = random.Random(4)
    rows = [(rng.randrange(-50, 400), rng.choice(ODD)) for _ in range(120)] + [(None, "null id"), (None, None), (7, "seven"), (7, "seven")]
    path = f"{tmp_dir}/{shard_bytes}"
    tokenfile.write_tokens(docs(spark, rows).repartition(5), path, PATH, shard_bytes=shard_bytes)
    got = sorted([tuple(r) for r in tokenfile.read_tokens(spark, path).collect()], key=lambda r: r[1])
    tok = Tokenizer.from_file(PATH)
    expected = [(i, np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")) for i, t in rows]
    assert sorted([(r[0], r[2], r[3]) for r in got], key=key) == sorted([(i, len(x), zlib.crc32(x.tobytes())) for i, x in expected], key=key)
    assert [key((r[0],)) for r in got] == sorted(key((r[0],)) for r in got)
    run = 0
    for r in got:
        assert r[1] == run
        run += r[2]


def test_empty_table(spark, tmp_dir):
    tokenfile.write_tokens(docs(spark, []), tmp_dir + "/none", PATH)
    assert tokenfile.read_tokens(spark, tmp_dir + "/none").count() == 0
