from pyspark.sql import functions as F

from sparkmill.operators import text


def _docs(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


def test_clean_documents_example(spark):
    df = _docs(spark, ["Don't the self-made Café, PAY!"])
    out = text.clean_documents(df, ["the"]).collect()
    assert out[0].text == "dont selfmade caf pay"


def test_clean_is_idempotent_and_keeps_order_and_repeats(spark):
    df = _docs(spark, ["b a b\tc  a\nthe a", ""])
    once = text.clean_documents(df, ["the"])
    twice = text.clean_documents(once, ["the"])
    assert [r.text for r in once.orderBy("doc_id").collect()] == ["b a b c a a", ""]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_word_count_modes(spark):
    df = _docs(spark, ["The the THE feed'st all-eating", "the  end\n"])
    raw = {r.word: r.n for r in text.word_count(df, mode="raw").collect()}
    assert raw == {"The": 1, "the": 2, "THE": 1, "feed'st": 1, "all-eating": 1, "end": 1}
    low = {r.word: r.n for r in text.word_count(df, mode="lower").collect()}
    assert low["the"] == 4
    clean = {r.word: r.n for r in text.word_count(df, mode="clean").collect()}
    assert clean == {"the": 4, "feedst": 1, "alleating": 1, "end": 1}


def test_top_words_tie_break(spark):
    counts = spark.createDataFrame([("b", 3), ("a", 3), ("c", 5), ("d", 1)], "word string, n long")
    assert [r.word for r in text.top_words(counts, 3).collect()] == ["c", "a", "b"]


def test_top_words_with_ties_equals_rank(spark):
    import random

    rnd = random.Random(7)
    for trial in range(5):
        data = [(f"w{i}", rnd.randint(1, 6)) for i in range(rnd.randint(1, 30))]
        counts = spark.createDataFrame(data, "word string, n long")
        k = rnd.randint(1, 12)
        got = sorted(r.word for r in text.top_words_with_ties(counts, k).collect())
        vals = sorted((n for _, n in data), reverse=True)
        kth = vals[min(k, len(vals)) - 1]
        assert got == sorted(w for w, n in data if n >= kth)


def test_document_words_distinct(spark):
    clean = spark.createDataFrame([(1, "a b a"), (2, "")], "doc_id long, text string")
    got = sorted(map(tuple, text.document_words(clean).collect()))
    assert got == [(1, "a"), (1, "b")]


def test_clean_text_equals_single_class_regex(spark):
    from sparkmill.functions.text import NOT_KEPT_CLASS, clean_text

    samples = ["Ünïcödé – ‘quotes’ & ÉÇ 😀 tab\there\x0bvt\x0cff\r\nCRLF", "İstanbul K-9 x_y", "", "plain"]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    rows = df.select(clean_text(F.col("t")).alias("a"),
                     F.regexp_replace(F.lower("t"), NOT_KEPT_CLASS, "").alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_stop_words_by_join_equal_the_list(spark, tmp_dir):
    from sparkmill.operators import text
    from sparkmill.sources import files

    docs = [(1, "The cat and the hat!"), (2, None), (3, ""), (4, "the the"), (4, "other words"), (None, "a null id"), (1, "The cat and the hat!")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    words = ["the", "and", "a"] + [f"w{i}" for i in range(3000)]
    with open(f"{tmp_dir}/stop.txt", "w") as f:
        f.write("\n".join(words) + "\n\n the \n")
    table = files.stop_words(spark, f"{tmp_dir}/stop.txt")
    assert files.read_stop_words(spark, f"{tmp_dir}/stop.txt") == sorted(words)
    by_list = text.clean_documents(df, words).collect()
    by_join = text.clean_documents_by_join(df, table).collect()
    assert sorted(map(str, map(tuple, by_join))) == sorted(map(str, map(tuple, by_list)))


def test_stop_words_come_from_the_package(monkeypatch):
    import pyspark

    from sparkmill.sources import stopwords

    monkeypatch.setattr(pyspark, "__file__", "/nowhere/pyspark/__init__.py")
    stopwords.spark_stop_words.cache_clear()
    assert len(stopwords.spark_stop_words("english")) == 181
