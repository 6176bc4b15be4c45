"""Clustering against brute force in Python integers, and against the SQL."""

import hashlib
import math

import numpy as np
import pytest

from tests.harness import compare, duckdb_con
from wordtide.llm import centroids

SF = "/root/testdata/sf0.01"


def brute(rows, components, k, rounds, scale=1024, salt="3:"):
    kept = [(i, [math.floor(float(v) * scale) for v in x]) for i, x in rows
            if x is not None and len(x) == components and all(v is not None and math.isfinite(v) for v in x)]
    name = lambda i: hashlib.sha256(f"{salt}{'null' if i is None else i}".encode()).hexdigest()
    cent = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((dist(v, c), j) for j, c in enumerate(cent))
    for _ in range(rounds):
        groups = [[] for _ in cent]
        for _, v in kept:
            groups[near(v)[1]].append(v)
        cent = [[sum(c) // len(g) for c in zip(*g)] if g else old for g, old in zip(groups, cent)]
    found = [(i, *near(v)) for i, v in kept]
    most = (1 << 63) - 1
    inertia = [sum(d for _, d, j in found if j == c) for c in range(len(cent))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return sorted(((i, j, min(d, most), min(inertia[j], most), min(sum(inertia), most), sha[j]) for i, d, j in found), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_against_sql(spark):
    r = compare(spark, duckdb_con(SF), "op12_centroids", centroids.op12_centroids, centroids.SQL, SF)
    assert r["status"] == "ok" and r["spark_rows"] == 500, r


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()][:200]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    assert got(centroids.cluster_vectors(df)) == brute(rows, 64, 8, 10)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_cases(spark, kind):
    rng = np.random.default_rng(5)
    x = rng.integers(-3, 4, (60, 4)) / 2.0  # many ties and copies
    rows = [(i % 50, r.tolist()) for i, r in enumerate(x)] + [(None, [0.5, 0.25, -0.1 if kind == "double" else -0.125, 3.0])]
    rows += [(100, None), (101, [1.0, 2.0]), (102, [1.0, None, 0.0, 0.0]), (103, [math.nan, 0.0, 0.0, 0.0]), (104, [math.inf, 0.0, 0.0, 0.0]), (105, [])]
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], f"vec_id long, embedding array<{kind}>, _id string, cluster int").repartition(4)
    for k, rounds in ((5, 4), (8, 0), (80, 2)):
        assert got(centroids.cluster_vectors(df, components=4, clusters=k, rounds=rounds, pivots=3)) == brute(rows, 4, k, rounds)
    assert got(centroids.cluster_vectors(df.limit(0), components=4)) == []
    assert got(centroids.cluster_vectors(df.where("vec_id >= 100"), components=4)) == []


def test_huge_components(spark):
    rows = [(1, [1e38, 0.0]), (2, [1.0000001e38, 1.0]), (3, [-3e30, 5.0]), (4, [2.0, 2.0]), (5, [2.0, 2.5]), (6, [1e5, 1e5]), (7, [3e5, -2e5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for k in (2, 3, 5):
        assert got(centroids.cluster_vectors(df, components=2, clusters=k, rounds=3)) == brute(rows, 2, k, 3)


def test_bounds_skip_centroids_and_lose_none():
    rng = np.random.default_rng(0)
    home = rng.normal(size=(12, 64)) * 2
    x = centroids.integers(home[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 64)) * 0.1, 1024)
    p = x[centroids.choose_pivots(x[:500], 16)]
    cent = x[rng.choice(3000, 10)]
    cluster, d, done = centroids.assign(x, centroids.pivot_distances(x, p), cent, centroids.pivot_distances(cent, p))
    full = np.stack([centroids.squared(x, c) for c in cent], axis=1)
    assert (cluster == full.argmin(axis=1)).all() and (d == full.min(axis=1)).all()
    assert done < 0.5 * full.size
