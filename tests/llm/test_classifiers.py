import random

import numpy as np
import pytest

from sparkmill.llm import quality, sample, toxicity
from tests.llm.helpers import DOC_SCHEMA, held

RUDE = ["moronic", "scumbag", "trashy", "idiotic"]


def corpus(seed=0, n=700):
    """(documents, labels): rude words in a fifth, shouted text in another fifth."""
    rng = random.Random(seed)
    syllables = ["ba", "te", "ri", "mo", "lun", "shé", "kor", "vi"]
    docs, labels = [], []
    for i in range(n):
        w = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(20, 120))]
        toxic, bad = rng.random() < .2, rng.random() < .2
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(RUDE))
        if bad:
            w = [x.upper() + "!!" for x in w]
        docs.append((i, " ".join(w), "x", 1, None))
        labels.append((i, 0 if bad else 1, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = corpus()
    docs += [(5000, None, "x", 1, None), (5001, "", "x", 1, None), (None, "no id", "x", 1, None), (7, docs[7][1], "x", 1, None), (5002, "long " * 30000, "x", 1, None)]
    labels += [(None, 1, 1), (5001, None, None), (7, labels[7][1], labels[7][2]), (9, 1 - labels[9][1], 1 - labels[9][2]), (8000, 1, 1)]
    return spark.createDataFrame(docs, DOC_SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


@pytest.mark.parametrize("module,column,at", [(toxicity, 2, 0.5), (quality, 1, 0.3)])
def test_held_out_accuracy_and_shape(tables, module, column, at):
    docs, labels, truth = tables
    model = module.fit(docs, labels)
    got = module.score(docs, model).collect()
    assert len(got) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= at) and r["held_out"] == held(r["doc_id"]) for r in got)
    known = {t[0]: t[column] for t in truth[:700]}
    fold = [(r["predicted"], known[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in known]
    assert len(fold) > 100 and np.mean([p == y for p, y in fold]) > 0.95
    again = module.score(docs.repartition(3), module.fit(docs.repartition(5), labels)).collect()
    near = {str(r["doc_id"]): r["score"] for r in got}
    assert all(abs(near[str(r["doc_id"])] - r["score"]) < 1e-6 for r in again)  # the sample is chosen by id


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_one_class_no_labels_empty_tables(spark, tables, module, label):
    docs, labels, _ = tables
    few = docs.limit(5)
    for kept, share in ((labels.filter(f"{label} = 1"), 1.0), (labels.filter(f"{label} = 0"), 0.0), (labels.limit(0), 0.0)):
        scores = [r["score"] for r in module.score(few, module.fit(docs, kept)).collect()]
        assert np.allclose(scores, share, atol=1e-6)
    assert module.score(docs.limit(0), module.fit(docs.limit(0), labels)).count() == 0


def test_labels_of_the_held_out_fold_are_not_learned(tables):
    _, labels, _ = tables
    ids = [r["id"] for r in sample.labelled(labels, "toxic").collect()]
    assert not any(held(i) for i in ids) and None not in ids and 9 not in ids and ids.count(7) <= 1


def test_sample_is_bounded(tables):
    docs, labels, _ = tables
    table, counts = sample.training_texts(docs, labels, "toxic", (40, 20))
    y = table.column("label").to_pylist()
    assert y.count(0) <= 41 and y.count(1) <= 21 and sum(counts) > 400


def test_keep_clean_keeps_columns(tables):
    docs, labels, _ = tables
    model = toxicity.fit(docs, labels)
    kept = toxicity.keep_clean(docs, model)
    assert kept.dtypes == docs.dtypes
    clean = [r["doc_id"] for r in toxicity.score(docs, model).filter("predicted = 0").collect()]
    assert sorted(map(str, clean)) == sorted(str(r["doc_id"]) for r in kept.collect())


def test_folded_table_equals_the_network():
    """The per-bucket numbers give what the mean of vectors and the layer would."""
    import pyarrow as pa

    array = pa.array(["one two two three", "ONE!! two", ""])
    features = quality._features(array)
    table = np.random.default_rng(0).normal(size=quality.BUCKETS).astype(np.float32)
    model = quality.Model(table, 0.25)
    expected = [1 / (1 + np.exp(-(float((table[b] * w).sum()) + 0.25))) for b, w in features]
    assert np.allclose(model.score(array), expected, atol=1e-5)


def test_sample_holds_one_row_of_an_id(spark):
    """A repeated id, a third of all rows, comes to the driver once, with the same text in any order."""
    rows = [(1, f"text {i % 3}", "x", 1, None) for i in range(300)] + [(i, f"own {i}", "x", 1, None) for i in range(2, 602)]
    labels = spark.createDataFrame([(i, 1, int(i % 2)) for i in range(1, 602)], "doc_id long, quality int, toxic int")
    tables = [sample.training_texts(spark.createDataFrame(r, DOC_SCHEMA).repartition(n), labels, "toxic", (1000, 1000))[0].to_pylist() for r, n in ((rows, 2), (rows[::-1], 5))]
    assert tables[0] == tables[1] and sum(r["text"].startswith("text") for r in tables[0]) == (not held(1))
    assert len(tables[0]) == sum(not held(i) for i in range(1, 602))
