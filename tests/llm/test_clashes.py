"""Pipeline stages on rows whose other columns have the names the operators use inside, and on repeated ids."""

import pytest
from pyspark.sql import functions as F

from wordtide.llm import exact_dedup, mixing, near_dedup, quality

NAMES = ["_key", "_sha", "_text_hash", "_id", "_text", "_parts", "_set", "_row", "_part", "sha", "row", "kept", "count", "_count"]
LONG = " ".join(f"word{i}" for i in range(60))
TEXTS = [LONG, LONG, LONG + " more", "short", None, "", "other " + LONG[:200], "short"]


@pytest.fixture(scope="module")
def docs(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in NAMES)
    rows = [(i, t, "en", "ab"[i % 2], len(t or ""), *[f"{n}{i}" for n in NAMES]) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, schema).repartition(3)


def names_untouched(df, docs):
    assert df.dtypes == docs.dtypes
    out = df.collect()
    assert all(r[n] == f"{n}{r.doc_id}" for r in out for n in NAMES)
    return sorted(r.doc_id for r in out)


def test_stages_keep_clashing_columns(spark, docs):
    assert names_untouched(exact_dedup.keep_rows(docs), docs) == [1, 2, 5, 6, 7]
    assert names_untouched(near_dedup.keep_rows(docs), docs) == [0, 3, 4, 5, 6]
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    want = {r.doc_id for r in quality.classify(docs, labels, F.col("source"), F.col("lang")).where("kept").collect()}
    assert set(names_untouched(quality.keep_rows(docs, labels, F.col("source"), F.col("lang")), docs)) == want
    assert set(names_untouched(mixing.mixed_rows(docs), docs)) - {0, 1, 2, 3, 6, 7} == set()  # those with words, as far as the mix takes them


def test_near_dedup_of_repeated_ids(spark):
    a, b = LONG, " ".join(f"else{i}" for i in range(60))
    rows = [(1, a), (1, b), (0, b), (0, b), (0, b.upper()), (None, b), (None, "alone"), (5, None), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_dedup.keep_rows(df).collect()
    assert len(got) == 4
    assert {(r.doc_id, (r.text or "").lower()) for r in got} == {(1, a), (0, b), (None, "alone"), (5, "")}
