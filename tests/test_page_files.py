"""Raw page files as a data source: listing, partitions, filters on the listing, decoding, bad files."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, Not, StringStartsWith

from wordtide.sources import page_files as P


@pytest.fixture()
def folder(tmp_path):
    files = {"a/1.html": "\u65e5\u672c".encode("shift_jis"), "a/2.html": b"<p>two</p>", "b/3.html": b"", "b/c/4.html": b"x" * 5000, "a/.hidden": b"no", "_tmp/5.html": b"no"}
    for name, data in files.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    os.utime(tmp_path / "a/1.html", (1_000_000_000, 1_000_000_000))
    return str(tmp_path)


def test_read(spark, folder):
    rows = {r.path: r for r in P.read_pages(spark, folder).collect()}
    assert set(rows) == {"a/1.html", "a/2.html", "b/3.html", "b/c/4.html"}
    assert rows["a/1.html"].html == "\u65e5\u672c" and rows["b/3.html"].html == "" and rows["b/c/4.html"].size == 5000
    assert str(rows["a/1.html"].modified) == "2001-09-09 01:46:40" and all(r.error is None for r in rows.values())
    assert {r.path for r in P.read_pages(spark, "file://" + folder, pattern="a/*").collect()} == {"a/1.html", "a/2.html"}
    big = {r.path: r for r in P.read_pages(spark, folder, max_file_bytes=100).collect()}["b/c/4.html"]
    assert big.body is None and big.error == "5000 bytes"


def test_filters_reach_the_listing(spark, folder):
    def paths(df):
        return sorted(r.path for r in df.select("path").collect())
    df = P.read_pages(spark, folder)
    assert paths(df.where("path LIKE 'a/%'")) == ["a/1.html", "a/2.html"]
    assert paths(df.where("path IN ('a/1.html', 'b/3.html') AND size > 0")) == ["a/1.html"]
    assert paths(df.where("modified < TIMESTAMP '2010-01-01'")) == ["a/1.html"]
    assert paths(df.where("size >= 10 AND html LIKE '%two%'")) == ["a/2.html"]
    assert paths(df.where("path LIKE 'none/%'")) == []
    reader = P.PageReader({"path": folder})
    mine = [StringStartsWith(("path",), "a/"), GreaterThan(("size",), 5), In(("path",), ("a/2.html",))]
    others = [EqualTo(("error",), "x"), Not(EqualTo(("path",), "a/2.html"))]
    assert list(reader.pushFilters(mine + others)) == others and [f[0] for f in reader.listing()] == ["a/2.html"]


def test_partitions(folder):
    whole = P.PageReader({"path": folder}).partitions()
    assert [[f[0] for f in p.files] for p in whole] == [["a/1.html", "a/2.html", "b/3.html", "b/c/4.html"]]
    small = P.PageReader({"path": folder, "partition_bytes": str(2 * P.OPEN_BYTES + 100)}).partitions()
    assert [[f[0] for f in p.files] for p in small] == [["a/1.html", "a/2.html"], ["b/3.html"], ["b/c/4.html"]]


def test_a_file_that_is_gone_is_an_error_row(folder):
    reader = P.PageReader({"path": folder})
    parts = reader.partitions()
    os.remove(f"{folder}/a/2.html")
    rows = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert {r["path"]: r["error"] for r in rows} == {"a/1.html": None, "a/2.html": "FileNotFoundError", "b/3.html": None, "b/c/4.html": None}


def test_write_and_read_again(spark, tmp_path):
    df = spark.createDataFrame([("x/1", bytearray(b"one")), ("x/2", None), ("y/3", bytearray("\u00e9".encode()))], "n string, b binary")
    out = P.write_pages(df, str(tmp_path), "n", "b").agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes")).first()
    assert (out.files, out.bytes) == (3, 5)
    got = P.read_pages(spark, str(tmp_path), "utf-8").select("path", "html").collect()
    assert sorted(tuple(r) for r in got) == [("x/1", "one"), ("x/2", ""), ("y/3", "\u00e9")]
    assert time.time() - os.path.getmtime(tmp_path / "x/1") < 600
