import random

import __spark_entry__ as entry
import corpus_pipeline
from sparkmill.llm import decontam, jaccard
from sparkmill.llm.store import stored
from tests.llm.test_classifiers import RUDE, corpus


def test_stages_take_effect(spark, tmp_dir):
    rng = random.Random(1)
    rows, labels = corpus(3, 400)
    docs = [(i, t, "en", "s", len(t)) for i, t, *_ in rows]
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    near = [f"n{rng.randrange(10 ** 6)}" for _ in range(200)]
    docs += [(1000, " ".join(near), "en", "s", 1), (1001, " ".join(near[:120] + ["edit"] + near[121:]), "en", "s", 1), (1002, " ".join(near), "en", "s", 1),
             (1003, "before " + passage + " after", "en", "s", 1), (1004, "here token=abcdef0123456789 there", "en", "s", 33), (1005, None, None, None, None), (1006, "", "en", "s", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(tmp_dir + "/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(tmp_dir + "/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(tmp_dir + "/benchmark.parquet")
    frame = spark.read.parquet(tmp_dir + "/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, frame = frame, stored(stage(spark, frame, tmp_dir), name)
        assert frame.columns == before.columns
        seen.append({r["doc_id"]: r for r in frame.collect()})
    toxic = {i for i, _, y in labels if y}
    assert len(toxic & set(seen[0])) < 0.1 * len(toxic)
    assert len({i for i, _, y in labels if not y} - set(seen[0])) < 0.05 * len(labels)
    assert {1000, 1005, 1006} <= set(seen[1]) and not {1001, 1002} & set(seen[1])
    assert 1003 in seen[1] and 1003 not in seen[2] and set(seen[1]) - set(seen[2]) == {1003}
    assert seen[3][1004]["text"] == "here [secret] there" and seen[3][1004]["n_chars"] == 19 and set(seen[3]) == set(seen[2])
    assert all(seen[3][i]["text"] == seen[2][i]["text"] for i in seen[3] if i != 1004)
    last = corpus_pipeline.STAGES[-1][1](spark, frame, tmp_dir).collect()
    assert {r["doc_id"] for r in last} == set(seen[3]) and all(r["round_trip"] for r in last)
    assert {(r["doc_id"], r["sample"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, tmp_dir).collect()} == {(r["doc_id"], r["sample"], r["ids_crc32"]) for r in last}
    assert RUDE


def test_registration():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op")}
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
    assert set(entry.oracle_sql()) <= names


CLASH = "doc_id long, text string, row_key string, _row_key long, __row_key string, stays boolean, k int"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, f"r{n}", n, None, True, 1) for n, (i, t) in enumerate(rows)], CLASH)


def test_filters_keep_columns_and_rows(spark):
    a, b = " ".join(f"a{i}" for i in range(80)), " ".join(f"b{i}" for i in range(80))
    rows = [(1, a), (2, a + " more"), (3, b), (3, b), (4, None), (4, None), (5, ""), (None, "c d e f g h"), (None, "c d e f g h"), (6, "  "), (7, a), (8, "one two")]
    got = jaccard.keep_one(clashing(spark, rows), shingle=5, percent=80)
    assert got.columns == ["doc_id", "text", "row_key", "_row_key", "__row_key", "stays", "k"]
    got = got.collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted((str(i), t) for i, t in [(1, a), (3, b), (4, None), (4, None), (5, ""), (None, "c d e f g h"), (6, "  "), (8, "one two")])
    assert all(r["row_key"] == f"r{r['_row_key']}" and rows[r["_row_key"]] == (r["doc_id"], r["text"]) for r in got)
    items = spark.createDataFrame([("x", " ".join(f"a{i}" for i in range(20)))], "item_id string, text string")
    got = decontam.keep_uncontaminated(clashing(spark, rows), items).collect()
    assert sorted(r["_row_key"] for r in got) == [n for n, (_, t) in enumerate(rows) if not (t or "").startswith("a0 ")]
    assert all(r["row_key"] == f"r{r['_row_key']}" for r in got)


def test_all_stages_on_awkward_rows(spark, tmp_dir):
    rows, labels = corpus(3, 200)
    docs = [(i, t, "en", "s", len(t), "x") for i, t, *_ in rows]
    docs += [(None, "no id", None, None, None, None), (7000, None, None, None, None, None), (7000, None, None, None, None, None), (7001, "", "en", "s", 0, "x"),
             (7002, "same row here", "en", "s", 13, "x"), (7002, "same row here", "en", "s", 13, "x"), (7003, "long " * 200_000, "en", "s", 1_000_000, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row_key string"
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(tmp_dir + "/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(tmp_dir + "/benchmark.parquet")
    for given in (docs, []):
        frame = spark.createDataFrame(given, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            frame = stored(stage(spark, frame, tmp_dir), name)
            assert frame.columns == [x.split()[0] for x in schema.split(", ")]
        kept = frame.collect()
        last = corpus_pipeline.STAGES[-1][1](spark, frame, tmp_dir).collect()
        assert all(r["round_trip"] for r in last) and {r["doc_id"] for r in last} == {r["doc_id"] for r in kept}
        if given:
            assert [sum(r["doc_id"] == i for r in kept) for i in (None, 7000, 7001, 7002, 7003)] == [1, 2, 1, 1, 1]
        else:
            assert not kept and not last
