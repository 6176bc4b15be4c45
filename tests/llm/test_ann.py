"""Neighbours against brute force: exact on small tables, recall on the given ones."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wordtide.llm import ann

SF = "/root/testdata/sf0.001"


def brute(rows, k=20, every=20):
    ok = [(i, np.array(v, dtype=float)) for i, v in dict(rows).items()]
    out = []
    for i, q in ok:
        if i % every == 0:
            best = sorted(((-(v * q).sum(), j) for j, v in ok if j != i))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def same(a, b):
    assert [x[:3] for x in a] == [x[:3] for x in b]
    assert np.allclose([x[3] for x in a], [x[3] for x in b], rtol=1e-12)


def test_query_on_table_is_exact_where_a_block_holds_all(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    same(got(ann.op5_hilbert_ann(spark, SF)), brute(rows))


def test_recall_on_larger_table(spark):
    rng = np.random.default_rng(11)
    home = rng.normal(size=(40, 32))
    x = home[rng.integers(0, 40, 10_000)] + 0.5 * rng.normal(size=(10_000, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(8)
    out = ann.nearest(df).cache()
    assert ann.recall(df, out) >= 0.95
    n = {r.query_id: r["count"] for r in out.groupBy("query_id").count().collect()}
    assert set(n.values()) == {20} and len(n) == df.where("vec_id % 20 = 0").count()


def test_cases(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 6)) * rng.uniform(0.1, 3, (200, 1))
    rows = [(i, x[i].tolist()) for i in range(200)]
    rows += [(1000 + i, x[7].tolist()) for i in range(61)]  # copies of one vector, queries among them
    rows += [(2000, x[9].tolist()), (2020, [float(-v) for v in x[9]])]
    bad = [(3000, None), (3020, [0.0] * 6), (3040, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (3060, [float("nan")] * 6), (3080, [float("inf")] + [0.0] * 5),
           (3100, []), (3120, [1.0, 2.0]), (None, x[3].tolist())]
    schema = "vec_id long, embedding array<double>, id int, rep string"
    df = spark.createDataFrame([(*r, 1, "x") for r in rows + bad + rows[:5]], schema).repartition(3)
    same(got(ann.nearest(df)), brute(rows))
    assert ann.nearest(df.limit(0)).collect() == []
    small = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, -0.0])], "vec_id long, embedding array<float>")
    assert got(ann.nearest(small)) == [(0, 1, 1, 0.5)]


def test_small_blocks_cover_neighbours(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(600, 3)))], "vec_id long, embedding array<double>")
    out = ann.nearest(df, block=64, halo=32, k=5).cache()
    assert ann.recall(df, out, k=5) > 0.9
    assert out.groupBy("query_id").count().where("count <> 5").count() == 0


def test_rest_finds_what_the_curves_miss(spark):
    """Windows cover a twentieth of the table; most pairs of blocks of the clustered half can be skipped."""
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(1500, 16)), rng.normal(size=(1, 16)) * 5 + rng.normal(size=(1500, 16)) * 0.1])
    x[100:200] = np.round(x[100:200])  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    same(got(ann.nearest(df, k=7, curves=2, block=64, halo=8, rest_bytes=100 * 8 * 16)), brute(rows, k=7))


@pytest.mark.parametrize("large", [1e3, 1e12])
def test_one_large_norm_leaves_the_curves_spread(spark, large):
    """A table of 60 windows: the curves still find more than windows of neighbouring ids would."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 4))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(3001, [large, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    classes = ann.usable(df, "vec_id", "embedding", 20).select("vec", F.col("id").alias("rep"), "asks", "norm")
    found = ann.curve_lists(ann.curve_order(classes, 4), 20, 40, 5)
    lists = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    found = found.where("c <> 3001").withColumn("n", F.row_number().over(lists)).where("n <= 20").select(F.col("q").alias("query_id"), F.col("c").alias("vec_id"))
    assert ann.recall(df.where("vec_id <> 3001"), found) > 0.5
    same(got(ann.nearest(df, curves=4, block=40, halo=5, rest_bytes=4 << 10)), brute(rows))


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (5, 2)])
def test_hilbert_curve_visits_neighbours(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    key = ann.hilbert_index(grid, bits)
    assert sorted(key) == list(range(len(grid)))
    walk = grid[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()
