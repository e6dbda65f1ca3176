import gzip
import hashlib
import random

import pytest

from sparkmill.llm import warc
from tests.llm.helpers import key

SCHEMA = "page_id long, url string, html string, type string, capture string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", None) for r in rows], SCHEMA)


def brute(rows):
    bodies = [(r[2] or "").encode() for r in rows]
    out = []
    for (page_id, _, _), body in zip(rows, bodies):
        group = [r[0] for r, b in zip(rows, bodies) if b == body]
        lead = max([p for p in group if p is not None], default=None)
        revisit = len(body) >= 1000 and len(group) > 1 and page_id != lead
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", lead if revisit else None))
    return sorted(out, key=key)


def cases():
    rng = random.Random(2)
    big = ["é" * 600, "x" * 1000, "y\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40, "z" * 999]
    rows = [(i, f"http://h/{i}", rng.choice(big + [f"<p>{i}</p>" * 50])) for i in range(40)]
    rows += [(50, None, None), (51, "", ""), (52, "http://a/\r\nX: y", "q" * 2000), (52, "http://b", "q" * 2000), (53, "u", "same" * 400), (53, "u", "same" * 400),
             (None, "n", "x" * 1000), (None, "only", "null only" * 200), (None, "only2", "null only" * 200), (-5, "m", "neg\r\n\r\n")]
    return rows


@pytest.mark.parametrize("payloads", [True, False])
def test_round_trip_matches_brute_force(spark, tmp_dir, payloads):
    rows = cases()
    warc.write_archive(pages(spark, rows).repartition(3), tmp_dir + "/w", records_per_file=20)
    captures = warc.assemble(warc.read_records(spark, tmp_dir + "/w", payloads=payloads)).cache()
    got = warc.resolve_revisits(captures)
    assert sorted([tuple(r) for r in got.collect()], key=key) == brute(rows)
    nested = captures.collect()
    assert len(nested) == len(rows)
    assert all(len(r["requests"]) == 1 and len(r["metadata"]) == 1 and r["response"] is not None for r in nested)
    if payloads:
        own = sorted((bytes(r["response"]["block"]) for r in nested if r["response"]["type"] == "response"))
        assert own == sorted((t or "").encode() for (p, _, t), b in zip(rows, brute_in_order(rows)) if b == "response")


def brute_in_order(rows):
    bodies = [(r[2] or "").encode() for r in rows]
    kinds = []
    for (page_id, _, _), body in zip(rows, bodies):
        group = [r[0] for r, b in zip(rows, bodies) if b == body]
        lead = max([p for p in group if p is not None], default=None)
        kinds.append("revisit" if len(body) >= 1000 and len(group) > 1 and page_id != lead else "response")
    return kinds


def test_binary_payload_and_empty_table(spark, tmp_dir):
    frame = spark.createDataFrame([(1, "u", bytearray(range(256)) * 10)], "page_id long, url string, body binary")
    warc.write_archive(frame, tmp_dir + "/b", payload_col="body")
    row = warc.read_records(spark, tmp_dir + "/b").filter("type = 'response'").first()
    assert bytes(row["block"]) == bytes(range(256)) * 10
    warc.write_archive(pages(spark, []), tmp_dir + "/e")
    assert warc.resolve_revisits(warc.assemble(warc.read_records(spark, tmp_dir + "/e"))).count() == 0


def test_parse_members_and_faults():
    record = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    many = gzip.compress(record) + gzip.compress(record)
    assert [bytes(b) for _, b in warc.parse(many)] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(warc.parse(record[:-2]))


def test_orphans(spark):
    base = {"refers_to": None, "uri": None, "date": None, "content_type": None, "header_digest": None, "payload_bytes": 0, "payload_digest": "", "block": b""}
    rows = [{**base, "type": "request", "record_id": "q", "concurrent_to": "gone"}]
    recs = spark.createDataFrame([tuple(r[n] for n in warc._NAMES) for r in rows], warc._RECORD)
    row = warc.assemble(recs).first()
    assert row["response"] is None and row["capture_id"] == "gone" and len(row["requests"]) == 1
