import os

import pytest

from sparkmill.operators import ratings as rt
from sparkmill.sources import files, sinks


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_ratings_dat_and_movies(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "ratings.dat"), "1::1193::5::978300760\n1::661::3::978302109\n")
    rows = [tuple(r) for r in files.read_ratings_dat(spark, p).collect()]
    assert rows == [(1, 1193, 5.0, 978300760), (1, 661, 3.0, 978302109)]
    m = _write(os.path.join(tmp_dir, "movies.dat"), '1::Toy Story (1995)::Animation|Comedy\n2::"Quoted, Title"::Drama\n')
    mv = [tuple(r) for r in files.read_movies_dat(spark, m).collect()]
    assert mv == [(1, "Toy Story (1995)", "Animation|Comedy"), (2, '"Quoted, Title"', "Drama")]


def test_ratings_csv_header(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "ratings.csv"), "userId,movieId,rating,timestamp\n1,2,3.5,1112486027\n")
    assert [tuple(r) for r in files.read_ratings_csv(spark, p).collect()] == [(1, 2, 3.5, 1112486027)]


def test_stop_words_crlf(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "stop.txt"), "the\r\na\r\nthe\r\n\r\nan\r\n")
    assert files.read_stop_words(spark, p) == ["a", "an", "the"]


def test_documents_folder(spark, tmp_dir):
    d = os.path.join(tmp_dir, "docs")
    os.makedirs(d)
    _write(os.path.join(d, "001.txt"), "line one\nline two\n")
    _write(os.path.join(d, "002.txt"), "other")
    rows = sorted((os.path.basename(r.path), r.text) for r in files.read_documents(spark, d).collect())
    assert rows == [("001.txt", "line one\nline two\n"), ("002.txt", "other")]


def test_access_log_file(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "access.log"),
               'h1 - - [01/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 10\nnot a log line\n')
    rows = files.read_access_log(spark, p).collect()
    assert [r.is_valid for r in rows] == [True, False]


def test_sinks_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(1, 2, 3.0, 10), (2, 3, 4.0, 20), (3, 4, 5.0, 30)],
                               "user long, item long, rating double, ts long")
    s = rt.time_split(df, n_test=1, n_valid=1)
    out = os.path.join(tmp_dir, "splits")
    sinks.write_splits(s, out)
    back = spark.read.parquet(out)
    assert back.filter("split = 'test'").select("user").first().user == 1
    dat = os.path.join(tmp_dir, "train_dat")
    sinks.write_ratings_dat(s.filter("split = 'train'"), dat)
    assert [tuple(r) for r in files.read_ratings_dat(spark, dat).collect()] == [(3, 4, 5.0, 30)]
    clean_out = os.path.join(tmp_dir, "clean")
    sinks.write_clean_documents(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), clean_out, "text")
    assert [r.value for r in spark.read.text(clean_out).collect()] == ["a b"]


def test_every_header_line_is_dropped(spark, tmp_dir):
    import os

    from sparkmill.sources import files

    head = files.CSV_HEADER
    os.makedirs(tmp_dir + "/csv")
    for name, lines in (("a.csv", [head, "1,2,3.5,10", head, "1,3,4.0,11"]), ("b.csv", ["2,2,1.0,12"]), ("c.csv", [head])):
        with open(f"{tmp_dir}/csv/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
    got = files.read_ratings_csv(spark, tmp_dir + "/csv")
    assert got.schema == files.RATING_SCHEMA
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2, 3.5, 10), (1, 3, 4.0, 11), (2, 2, 1.0, 12)]
    with open(tmp_dir + "/csv/d.csv", "w") as f:
        f.write("x,2,1.0,12\n")
    with pytest.raises(Exception):
        files.read_ratings_csv(spark, tmp_dir + "/csv").collect()
    lenient = files.read_ratings_csv(spark, tmp_dir + "/csv/d.csv", mode="PERMISSIVE").collect()
    assert [tuple(r) for r in lenient] == [(None, 2, 1.0, 12)]
