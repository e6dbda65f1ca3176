import datetime

import pytest

from sparkmill.operators import weblog
from sparkmill.sources.files import parse_log_lines

LINES = [
    'h1 - - [01/Jul/1995:00:00:01 -0400] "GET /a/b.html HTTP/1.0" 200 6245',
    'h2 - - [01/Jul/1995:00:00:01 -0400] "GET /x" 404 -',
    'bad line',
    'h3 - - [02/Jul/1995:00:00:01 -0400] "GET" 304 0 "ref" "ua"',
    'h4 - - [02/Jul/1995:00:00:01 -0400] "GET /q "z" HTTP/1.0" 404 - trailing',
]


@pytest.fixture()
def records(spark):
    return parse_log_lines(spark.createDataFrame([(x,) for x in LINES], "raw string"), "raw")


def test_fields(records):
    rows = {r.raw: r for r in records.collect()}
    r1 = rows[LINES[0]]
    assert (r1.method, r1.endpoint, r1.protocol, r1.response_code, r1.content_size) == \
        ("GET", "/a/b.html HTTP/1.0", "", 200, 6245)
    assert r1.date_time == datetime.datetime(1995, 7, 1, 0, 0, 1)
    assert (rows[LINES[1]].endpoint, rows[LINES[1]].content_size) == ("/x", 0)
    assert rows[LINES[2]].is_valid is False and rows[LINES[2]].host is None
    r3 = rows[LINES[3]]
    assert (r3.method, r3.endpoint, r3.response_code, r3.content_size) == ("GET", "", 304, 0)
    r4 = rows[LINES[4]]
    assert (r4.endpoint, r4.response_code, r4.content_size) == ('/q "z" HTTP/1.0', 404, 0)
    assert [f.dataType.simpleString() for f in records.schema.fields] == [
        "string", "string", "string", "timestamp_ntz", "string", "string", "string", "int", "bigint",
        "boolean", "string"]


def test_reports(records):
    s = weblog.parse_stats(records).first()
    assert (s.n_read, s.n_parsed, s.n_failed) == (5, 4, 1)
    assert weblog.unique_hosts(records).first().n_hosts == 4
    assert [tuple(r) for r in weblog.daily_hosts(records).collect()] == [(1, 2), (2, 2)]
    assert weblog.not_found_count(records).first().n_404 == 2
    assert len(weblog.top_error_endpoints(records).collect()) == 3
    assert [r.raw for r in weblog.invalid_sample(records).collect()] == ["bad line"]


def test_strict_and_lenient_bad_size(spark):
    df = spark.createDataFrame([('h - - [01/Jul/1995:00:00:01 -0400] "GET /" 200 12x',),
                                ('h - - [01/Foo/1995:00:00:01 -0400] "GET /" 200 1',)], "raw string")
    lenient = parse_log_lines(df, "raw", lenient=True).collect()
    assert [r.is_valid for r in lenient] == [False, False]
    with pytest.raises(Exception):
        parse_log_lines(df, "raw", lenient=False).collect()


def test_protocol_split_mode(spark):
    df = spark.createDataFrame([(LINES[0],), (LINES[1],)], "raw string")
    rows = parse_log_lines(df, "raw", compat=False).collect()
    assert [(r.endpoint, r.protocol) for r in rows] == [("/a/b.html", "HTTP/1.0"), ("/x", "")]


def test_struct_form_equals_projection(spark):
    from sparkmill.functions.weblog import parse_log_line

    df = spark.createDataFrame([(x,) for x in LINES], "raw string")
    a = sorted(repr(tuple(r)) for r in df.select(parse_log_line("raw").alias("p"), "raw").select("p.*", "raw").collect())
    b = sorted(repr(tuple(r)) for r in parse_log_lines(df, "raw").collect())
    assert a == b


def test_line_terminators_inside_a_line(spark):
    """Only LF ends a line: CR, U+0085 and U+2028 may stand in the endpoint."""
    lines = [f'h - - [01/Jul/1995:00:00:01 -0400] "GET /a{c}b HTTP/1.0" 200 5' for c in ("\r", "\u0085", "\u2028", "\u2029", "x")]
    df = spark.createDataFrame([(x,) for x in lines], "raw string")
    rows = parse_log_lines(df, "raw").collect()
    assert all(r.is_valid for r in rows) and {r.endpoint[2] for r in rows} == {"\r", "\u0085", "\u2028", "\u2029", "x"}


def test_sketches_merge_without_a_second_read(spark):
    from sparkmill.operators import weblog

    rows = [(True, f"h{(i * 7919) % 3000}", f"2024-03-{1 + i % 28:02} 10:00:00") for i in range(30_000)] + [(False, None, None)] * 5
    records = spark.createDataFrame(rows, "is_valid boolean, host string, t string").selectExpr("is_valid", "host", "cast(t as timestamp) as date_time")
    sketches = weblog.host_sketches(records).checkpoint()
    exact = {}
    for ok, host, t in rows:
        if ok:
            exact.setdefault(int(t[8:10]), set()).add(host)
    daily = {r["day"]: r["estimate"] for r in weblog.sketched_daily_hosts(sketches).collect()}
    assert daily.keys() == exact.keys()
    assert all(abs(daily[d] - len(exact[d])) <= weblog.SKETCH_ERROR * len(exact[d]) for d in exact)
    for first, last in ((None, None), (3, 9), (28, 28)):
        want = len(set().union(*(h for d, h in exact.items() if first is None or first <= d <= last)))
        assert abs(weblog.sketched_hosts(sketches, first, last).first()[0] - want) <= weblog.SKETCH_ERROR * want
    assert {r["day"].isoformat() for r in weblog.host_sketches(records, by_date=True).collect()} == {f"2024-03-{d:02}" for d in exact}
    assert weblog.sketched_hosts(sketches.limit(0)).first()[0] in (0, None)


def test_counts_observed_by_the_writing_job(spark, tmp_dir):
    from sparkmill.operators import weblog

    records = spark.range(1000).selectExpr("id % 7 <> 0 as is_valid", "id")
    assert weblog.write_observed(records, tmp_dir + "/out") == {"n_read": 1000, "n_parsed": 857, "n_failed": 143}
    assert spark.read.parquet(tmp_dir + "/out").count() == 1000
    assert weblog.write_observed(records.limit(0), tmp_dir + "/none") == {"n_read": 0, "n_parsed": 0, "n_failed": 0}
