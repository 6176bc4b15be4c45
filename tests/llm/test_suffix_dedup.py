"""Repeated strings against a dictionary of all 100-byte windows."""

import hashlib

import numpy as np
import pytest

from wordtide.llm import suffix_dedup

SF = "/root/testdata/sf0.001"


def brute(rows):
    """rows in order of position: (id, text)."""
    seen, out = set(), []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - 99):
            w = b[p:p + 100]
            if w in seen:
                gone[p:p + 100] = True
            seen.add(w)
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_on_table(spark, sf):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert got(suffix_dedup.op1_suffix_dedup(spark, sf)) == brute(rows)


def cases():
    rng = np.random.default_rng(4)
    text = lambda n: "".join(rng.choice(list("abcdefgh ij\nö"), n))
    line, rows = text(150), []
    for i in range(150):  # one line in every document, with different neighbours
        rows.append((i, text(int(rng.integers(0, 120))) + line + text(int(rng.integers(0, 120)))))
    whole = text(700)
    rows += [(200 + i, whole) for i in range(5)]
    for i in range(20):  # near copies
        t = list(whole)
        t[int(rng.integers(700))] = "#"
        rows.append((300 + i, "".join(t)))
    rows += [(400, None), (401, ""), (402, "a" * 99), (403, "a" * 100), (404, "a" * 101), (405, "ab" * 300), (406, whole[:100]),
             (407, whole[300:399]), (408, "日本" * 40 + line[3:130]), (409, whole[100:420] + whole[350:600])]
    return rows


@pytest.mark.parametrize("segment, lot, local, hot", [(1 << 20, 8 << 20, 64, 4096), (256, 900, 2, 3), (128, 1, 1, 1)])
def test_cases(spark, monkeypatch, segment, lot, local, hot):
    for k, v in (("SEGMENT", segment), ("LOT", lot), ("LOCAL_OPEN", local), ("HOT", hot)):
        monkeypatch.setattr(suffix_dedup, k, v)
    rows = cases()
    order = np.random.default_rng(0).permutation(len(rows))
    df = spark.createDataFrame([(*rows[i], "x", 1) for i in order], "doc_id long, text string, key string, start int").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50" if hot < 10 else "10000")
    try:
        out = suffix_dedup.remove_repeats(df)
        assert got(out) == brute(rows)
        texts = dict(rows)
        for r in out.collect():
            b = (texts[r.doc_id] or "").encode()
            assert sum(s.end - s.start for s in r.spans) == r.n_removed
            assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
            for s in reversed(r.spans):
                b = b[:s.start] + b[s.end:]
            assert b == r.kept
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert suffix_dedup.remove_repeats(df.limit(0)).collect() == []


def test_repeated_and_null_ids(spark):
    a, b = "".join(map(str, range(100))), "".join(map(str, range(500, 600)))
    rows = [(None, a), (3, a + b), (3, a + b), (3, b), (1, "q" + b)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])))
    assert got(suffix_dedup.remove_repeats(df)) == want
    names = spark.createDataFrame([("x", a), ("y", a)], "doc_id string, text string")
    assert [(r.doc_id, r.n_removed) for r in sorted(suffix_dedup.remove_repeats(names).collect())] == [("x", 0), ("y", len(a))]
