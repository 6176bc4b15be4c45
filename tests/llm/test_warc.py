"""WARC round trip against hashlib, and the reader on hostile files."""

import base64
import gzip
import hashlib
import io

import pytest

from wordtide.llm import warc

SF = "/root/testdata/sf0.001"


def expected(rows):
    """Brute force: group rows by payload."""
    pay = {}
    for i, html in rows:
        pay.setdefault((html or "").encode(), []).append(i)
    out = []
    for i, html in rows:
        b = (html or "").encode()
        top = max((x for x in pay[b] if x is not None), default=None)
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "response" if i == top else "revisit", None if i == top else top))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_query_on_table(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert got(warc.op9_warc(spark, SF)) == expected(rows)


def test_cases_round_trip(spark):
    big = "".join(chr(97 + i % 23) for i in range(400_000))
    rows = [(1, "u", "x"), (2, None, "x"), (3, "a\r\nb: c", ""), (4, "u", None), (5, "u", big), (5, "u", big), (6, "é", "\r\n\r\n\0ü"),
            (None, "u", "only")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, record_type string")
    out = warc.archive_round_trip(df, with_payload=True, max_file_bytes=100).cache()
    assert out.count() == len(rows) and out.where("NOT digest_ok").count() == 0
    full = {r.record_id: r.payload.decode() for r in out.where("record_type = 'response'").collect()}
    assert full[warc.record_urn(5)] == big and full[warc.record_urn(6)] == "\r\n\r\n\0ü"
    digest = out.select(warc.urn_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        warc.urn_id("refers_to").alias("refers_to"))
    assert got(digest) == expected([(r[0], r[2]) for r in rows])
    assert warc.archive_round_trip(df.limit(0)).collect() == []


def test_smaller_payloads_stay_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    out = {r.record_id: r.record_type for r in warc.archive_round_trip(df, min_revisit_bytes=3).collect()}
    assert [out[warc.record_urn(i)] for i in (1, 2, 3, 4)] == ["response", "response", "revisit", "response"]


def test_reader_frames_and_checks():
    a = warc.record_bytes("response", 1, "u", b"x" * 300_000)
    b = warc.record_bytes("revisit", 2, "u", b"x" * 300_000, 1)
    data = warc.gzip_member(a) + gzip.compress(b)
    recs = list(warc.read_records(io.BytesIO(data)))
    assert [(r["payload_bytes"], r["digest_ok"]) for r in recs] == [(300_000, True)] * 2
    with pytest.raises(EOFError):
        list(warc.read_records(io.BytesIO(data[:-9])))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(gzip.compress(a[:-6] + b"\r\n\r\n"))))
    bad = a.replace(b"xxxxyyyy", b"").replace(b"\r\n\r\nxxx", b"\r\n\r\nxyx")
    assert not next(warc.read_records(io.BytesIO(gzip.compress(bad))))["digest_ok"]
    assert list(warc.read_records(io.BytesIO(b""))) == []
