import os

from sparkmill import streaming


def test_streaming_word_counts(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("The cat, the hat!\nthe end\n")
    counts = streaming.streaming_word_counts(streaming.stream_lines(spark, src), "clean")
    q = (counts.writeStream.outputMode("complete").format("memory").queryName("wc_test")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).start())
    try:
        q.processAllAvailable()
        got = {r.word: r.n for r in spark.sql("SELECT * FROM wc_test").collect()}
    finally:
        q.stop()
    assert got == {"the": 3, "cat": 1, "hat": 1, "end": 1}


def test_streaming_log_counts(spark, tmp_dir):
    src = os.path.join(tmp_dir, "logs")
    os.makedirs(src)
    with open(os.path.join(src, "a.log"), "w") as f:
        f.write('h1 - - [01/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 404 -\ngarbage\n'
                'h2 - - [01/Jul/1995:00:00:02 -0400] "GET /a HTTP/1.0" 404 12\n')
    recs = streaming.streaming_log_records(streaming.stream_lines(spark, src))
    agg = streaming.streaming_endpoint_status_counts(recs)
    q = (agg.writeStream.outputMode("complete").format("memory").queryName("log_test")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck2")).start())
    try:
        q.processAllAvailable()
        got = [tuple(r) for r in spark.sql("SELECT * FROM log_test").collect()]
    finally:
        q.stop()
    assert got == [("/a HTTP/1.0", 404, 2)]
