"""Quality: held-out accuracy, and the shrinkage against the formulas in plain Python."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordtide.llm import quality

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    train = labels.where("doc_id % 2 = 0")
    out = {r.doc_id: r.kept for r in quality.classify(docs, train, F.col("source"), F.col("lang")).collect()}
    test = [(out[r.doc_id], r.quality) for r in labels.where("doc_id % 2 = 1").collect()]
    good, bad = [k for k, q in test if q == 1], [k for k, q in test if q == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.05
    assert len(out) == docs.count()


def brute_sites(rows, mean_prior=None):
    """rows: (host, path, p) -> leave-one-out host and path scores, by the docstring's formulas."""
    def ratio(groups):
        n, s = sum(map(len, groups)), sum(map(sum, groups))
        m, g = s / n, len(groups)
        within = sum((x - sum(v) / len(v)) ** 2 for v in groups for x in v) / (n - g)
        size = (n - sum(len(v) ** 2 for v in groups) / n) / (g - 1)
        between = (sum(len(v) * (sum(v) / len(v) - m) ** 2 for v in groups) / (g - 1) - within) / size
        return m, min(1e9, within / between) if between > 0 else 1e9

    hosts, paths = defaultdict(list), defaultdict(list)
    for h, q, p in rows:
        hosts[h].append(p)
    for h, q, p in rows:
        paths[h, q].append(p)
    mean, kh = ratio(list(hosts.values()))
    _, kp = ratio([[p - sum(hosts[h]) / len(hosts[h]) for p in v] for (h, q), v in paths.items()])
    out = []
    for h, q, p in rows:
        host = (sum(hosts[h]) - p + kh * mean) / (len(hosts[h]) - 1 + kh)
        out.append((host, (sum(paths[h, q]) - p + kp * host) / (len(paths[h, q]) - 1 + kp)))
    return out


def test_shrinkage_against_formulas(spark):
    rng = np.random.default_rng(0)
    rows, lab = [], []
    for i in range(300):
        host = None if i % 11 == 0 else f"h{i % 5}"
        path = None if i % 13 == 0 else f"p{i % 3}"
        bad = rng.random() < (0.8 if host == "h1" else 0.1)
        words = ["spam"] * 30 if bad and i % 2 else [f"w{rng.integers(40 if bad else 900)}" for _ in range(40)]
        rows.append((i, " ".join(words), host, path, "clash"))
        lab.append((i, int(not bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, p string")
    labels = spark.createDataFrame(lab + [(9999, 1), (1, None)], "doc_id long, quality int")
    out = sorted(quality.classify(df, labels, F.col("source"), F.col("lang")).collect())
    want = brute_sites([(r[2], r[3], o.doc_score) for r, o in zip(rows, out)])
    base = sum(y for _, y in lab) / len(lab)
    logit = lambda x: math.log(x / (1 - x))
    for o, (h, p) in zip(out, want):
        assert o.host_score == pytest.approx(h, rel=1e-6) and o.path_score == pytest.approx(p, rel=1e-6)
        z = logit(min(max(o.doc_score, 1e-9), 1 - 1e-9)) - logit(base) + logit(min(max(p, 1e-9), 1 - 1e-9))
        assert o.score == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-6) and o.kept == (o.score >= 0.5)


def test_edge_cases(spark):
    schema = "doc_id long, text string, source string, lang string"
    df = spark.createDataFrame([(1, None, "a", "x"), (2, "", None, None), (3, " \n", "a", "x"), (4, "word " * 9, "a", "x"), (4, "two words", "b", None),
                                (None, "x", "a", "x"), (6, "long " * 200_000, "a", "x")], schema)
    for lab in ([], [(4, 1)], [(4, None)]):
        out = quality.classify(df, spark.createDataFrame(lab, "doc_id long, quality int"), F.col("source"), F.col("lang")).collect()
        assert len(out) == 7 and {r.doc_id for r in out if not r.kept} == {1, 2, 3}
    two = spark.createDataFrame([(4, 1), (6, 0)], "doc_id long, quality int")
    out = {r.doc_id: r for r in quality.classify(df, two, F.col("source"), F.col("lang")).collect()}
    assert not out[6].kept and all(0 <= r.score <= 1 for r in out.values())
    assert quality.classify(df.limit(0), two, F.col("source"), F.col("lang")).collect() == []


def test_sites_of_urls(spark):
    df = spark.createDataFrame([("https://A.example.org:80/news/x?q#f",), ("http://b.org",), (None,), ("junk",)], "url string")
    assert [tuple(r) for r in df.select(*quality.url_site(F.col("url"))).collect()] == [("a.example.org", "news"), ("b.org", ""), (None, None), ("", "")]
