"""Every stage of the pipeline on its own input, by brute force."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import test_exact_dedup, test_mixing, test_near_dedup, test_packing
from wordtide.llm import mixing, quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, f in corpus_pipeline.STAGES:
        result = f(spark, docs, SF).cache()
        out.append((name, docs, result))
        docs = result
    return out


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_names_and_columns(steps):
    assert [n for n, _, _ in steps] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    for _, docs, result in steps[:-1]:
        assert result.dtypes == docs.dtypes


def test_quality_stage(spark, steps):
    _, docs, result = steps[0]
    kept = {r.doc_id for r in quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet"), F.col("source"), F.col("lang")).where("kept").collect()}
    assert rows(result) == [r for r in rows(docs) if r[0] in kept]
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all((d in kept) == (q == 1) for d, q in label.items())


def test_dedup_stages(steps):
    _, docs, result = steps[1]
    keep = {i for i, _, _, k in test_exact_dedup.brute([(r[0], r[1]) for r in rows(docs)]) if k}
    assert rows(result) == [r for r in rows(docs) if r[0] in keep] and len(keep) < docs.count()
    _, docs, result = steps[2]
    keep = {i for i, _, _, k in test_near_dedup.brute([(r[0], r[1]) for r in rows(docs)]) if k}
    assert rows(result) == [r for r in rows(docs) if r[0] in keep] and len(keep) < docs.count()


def test_mixing_stage(spark, steps):
    _, docs, result = steps[3]
    size = {r.doc_id: (r.source, (r.text or "").split()) for r in docs.collect()}
    goal, total = defaultdict(int), defaultdict(int)
    for s, w in size.values():
        goal[s] += len(w)
    goal = test_mixing.brute_targets(goal, {s: i % 3 + 1 for i, s in enumerate(sorted(goal))})
    for r in result.collect():
        words, (source, own) = r.text.split(), size[r.doc_id]
        assert r.n_chars == len(r.text) and 0 < len(words) <= 3 * len(own) and set(words) <= set(own)
        total[source] += len(words)
    assert all(abs(total[s] - g) <= 1 for s, g in goal.items())


def test_packing_stage(steps):
    _, docs, result = steps[4]
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    test_packing.check(result.collect(), dict(zip([i for i, _ in texts], test_packing.brute_ids([t for _, t in texts]))))


def test_run_gives_the_last_stage(spark, steps):
    a, b = corpus_pipeline.run(spark, SF), steps[-1][2]
    assert a.columns == b.columns
    total = lambda df: df.agg(F.sum("length"), F.countDistinct("doc_id")).first()
    assert total(a) == total(b)


def test_mixed_text_pieces(spark):
    df = spark.createDataFrame([(1, " a b\tc d  e ", "s", None), (2, None, "s", 0), (3, "é ü\nx", None, 9), (3, "é ü\nx", None, 9)],
                               "doc_id long, text string, source string, n_chars long")
    out = mixing.mixed_rows(df, block_words=2)
    assert out.dtypes == df.dtypes
    got = {(r.doc_id, tuple(sorted(r.text.split()))) for r in out.collect()}
    assert 2 not in {d for d, _ in got} and all(set(w) <= set("abcde") | {"é", "ü", "x"} for _, w in got)
    assert sum(len(r.text.split()) for r in out.collect()) == 11
    assert mixing.mixed_rows(df.limit(0)).collect() == []
