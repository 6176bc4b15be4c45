"""Tokenising and term normalisation (goldens from FIXTURES §3)."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wordtide.functions.text import nfkc_tokens, normalize_tokens, regex_tokens, safe_udf_tokenizer
from wordtide.operators.terms import normalize_surfaces

GOLDENS = [
    ("Kotlin", "kotlin"), ("ＫＯＴＬＩＮ", "kotlin"), ("Vue.js_4", "vuejs4"), ("on-call", "oncall"), ("a~~b", "ab"), ("x/y\\z", "xyz"),
    ("f(n)[k]", "fnk"), ("what?!", "what"), ("k:v;w", "kvw"), ("ねむーーい", "ねむい"), ("わ〜い", "わい"), ("big \t\n data", "big data"),
    ("\u3000左右\u3000", "左右"), ("Z", ""), ("ん", ""), ("７", ""), ("", ""), ("-._", ""), ("(?)", ""), (" \r\n ", ""), ("データ基盤", "デタ基盤"),
    ("go1.22版", "go122版"), ("句点。", "句点。"), ("４５６", "456"), ("ｷﾞﾀｰ", "ギタ"), ("Éte là", "éte là"), ("m\x1dn", "m n"), ("p\xa0q", "p q"),
    ("ﬁne", "fine"), ("Straße", "straße"), ("①②", "12"),
]


@pytest.mark.parametrize("form", ["surface", "array"])
def test_normaliser_matches_goldens(spark, form):
    df = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(GOLDENS)], "i int, surface string")
    if form == "surface":
        got = {r.i: r.normalized for r in normalize_surfaces(df).collect()}
    else:
        pairs = df.select("i", normalize_tokens(F.array("surface", F.lit("Tail-End"))).alias("t")).collect()
        assert all(r.t[1] == "tailend" for r in pairs)
        got = {r.i: r.t[0] for r in pairs}
    for i, (raw, expected) in enumerate(GOLDENS):
        assert got[i] == expected, raw


def test_token_arrays_keep_nulls(spark):
    df = spark.createDataFrame([(None,), ([],), (["A-1", "Ｂ２"],)], "t array<string>")
    assert [r.n for r in df.select(normalize_tokens(F.col("t")).alias("n")).collect()] == [None, [], ["a1", "b2"]]


def test_regex_tokens_script_runs(spark):
    df = spark.createDataFrame([("Python3とプログラミング言語の話 ok",), (None,), ("",)], "content string")
    rows = df.select(regex_tokens(F.col("content")).alias("t")).collect()
    assert rows[0].t == ["Python3", "プログラミング", "言語", "話", "ok"]
    assert rows[1].t == rows[2].t == []  # no text is no failure


def test_udf_tokenizer_isolates_failures(spark):
    def tok(text):
        if "boom" in text:
            raise RuntimeError("tokenizer failure")
        return text.split()

    df = spark.createDataFrame([("a b",), ("boom",), ("c",), (None,), ("",)], "content string")
    out = df.select("content", safe_udf_tokenizer(tok)(F.col("content")).alias("t")).collect()
    got = {r.content: r.t for r in out}
    assert got[None] == got[""] == []
    assert got["a b"] == ["a", "b"] and got["boom"] is None and got["c"] == ["c"]


def test_normalize_tokens_sends_no_null_arrays(spark):
    # an Arrow list column walks over all NULLs since its last value at every row, so a batch of plain posts took quadratic time
    df = spark.createDataFrame([(["ab", "Q"],), (["Ａb", None, "x"],), (None,), (["ab\n", "a1"],)], "t array<string>")
    df = df.select(normalize_tokens(F.col("t")).alias("n"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    sent = next(line for line in plan.splitlines() if "ArrowEvalPython" in line)
    assert "ELSE []" in sent, sent
    assert [r.n for r in df.collect()] == [["ab", ""], ["ab", "", ""], None, ["ab", "a1"]]


def test_nfkc_of_a_batch_without_values_is_the_batch():
    # a Python list per post cost as much as counting it
    empty = pa.array([[], []], pa.list_(pa.string()))
    assert nfkc_tokens.func(empty) is empty
    mixed = pa.array([["Ａb", None], [], None, ["①"]], pa.list_(pa.string()))
    assert nfkc_tokens.func(mixed).to_pylist() == [["Ab", None], [], None, ["1"]]


def test_plain_arrays_are_not_stepped_through(spark):
    arrays = [["ab", "c1"], ["ab", ""], ["", "ab"], [" ab"], ["ab "], ["a b"], ["ab cd"], ["ab  cd"], [None], ["ab", None], ["x"], ["x", "yz"], ["yz", "x", "yz"],
              [""], [], ["ab\n"], ["ab\tcd"], ["Ab"], ["Ａ", "bc"], [" "], ["ab", " ", "cd"]]
    df = spark.createDataFrame(list(enumerate(arrays)), "i int, t array<string>")
    one = normalize_surfaces(df.select("i", F.posexplode("t").alias("p", "surface")))
    expected = {i: [] for i in range(len(arrays))}
    for r in one.orderBy("i", "p").collect():
        expected[r.i].append(r.normalized)
    df = df.select("i", normalize_tokens(F.col("t")).alias("n"))
    assert {r.i: r.n for r in df.collect()} == expected
    top = df._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
    assert "THEN t" in top.split("transform(")[0], top
