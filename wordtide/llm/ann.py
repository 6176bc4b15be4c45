"""Nearest neighbours by largest inner product: shifted space-filling curves for a bound, then an exact rest.

Method: vectors are projected onto ``dims`` random orthonormal directions, once per curve with
other directions and another random shift, quantised, and ordered by their Hilbert index. Vectors
that are close end up close on most curves. Spark range-partitions (curve, key), so every vector
gets its rank on every curve; ranks are cut into blocks of ``block`` rows, each widened by
``halo`` rows of its neighbours. A query is compared with its whole widened block on every
curve in double precision; the k-th best score over all curves is the query's bound.

Exact rest: rows and queries are cut into blocks along the first curve, and every pair of blocks is compared in
full, except where no row can reach a bound: a pair is left out when its centroids, radii and largest norms show it,
and within a pair a query when its own product with the row block's centroid and norm does. What reaches the bound is
kept, so the result is exact, whatever the curves found; the curves only decide how much can be skipped.

Inner product: the vectors get one more coordinate, sqrt(top^2 - norm^2), queries 0, which turns the
largest inner product into the smallest distance, also where norms differ. ``top`` is the 0.999 quantile of the norms;
larger ones come last on every curve, in blocks of their own. Axes are quantised by their own quantiles over all
vectors, so single large or distant vectors do not push the others into a few cells.

Skew: identical vectors form one class, indexed once, so a vector that a third of all rows
hold fills no block. A class keeps its smallest k + 1 ids: no query needs more, as ties go to
smaller ids. Blocks follow ranks, so each group has at most block + 2 * halo rows. The curves' work grows in
proportion to the rows; the rest's with queries times rows that cannot be skipped, which on isotropic vectors is all of
them (see the README for figures).

Defined cases: vectors that are null, empty, all zero, or hold a null or non-finite component take
no part, nor do null ids or vectors whose length is not the table's most frequent one (the longer
on ties); a row that repeats an id and vector counts once; with fewer than k other rows all of them
are returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordtide.llm._common import modest_batches, prefix_sums, stage

K = 20
CURVES = 16
DIMS, BITS = 8, 7
BLOCK, HALO = 4096, 1024
QUANTILES = 64
#: Blocks of the exact rest: so many bytes of vectors, and so many row blocks whose queries form one query block.
REST_BYTES, REST_QUERIES = 4 << 20, 8
SEED = 11


def hilbert_index(grid: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer points (rows, dims) with ``bits`` bits a coordinate; dims * bits <= 63.

    Undoes the rotations of the curve from the top bit down, then reads the Gray code's bits in turn.
    """
    x = grid.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        bit = np.int64(1) << level
        low = bit - 1
        for i in range(len(x)):
            up = (x[i] & bit) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> level) & 1, (np.int64(1) << level) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for row in x:
            key = (key << 1) | ((row >> level) & 1)
    return key


def projected(vectors: np.ndarray, top: float, curve: int, dims: int = DIMS, seed: int = SEED) -> np.ndarray:
    """(rows, dims): the vectors (rows, d) along one curve's axes; norms from ``top`` on have no further coordinate."""
    d = vectors.shape[1]
    rng = np.random.default_rng((seed, curve))
    axes = np.linalg.qr(rng.normal(size=(d + 1, d + 1)))[0][:, :min(dims, d + 1)]
    left = np.sqrt(np.maximum(top * top - np.einsum("ij,ij->i", vectors, vectors), 0))
    return vectors @ axes[:-1] + left[:, None] * axes[-1]


def curve_keys(vectors: np.ndarray, top: float, curve: int, cuts: np.ndarray, dims: int = DIMS, bits: int = BITS, seed: int = SEED) -> np.ndarray:
    """Keys of vectors (rows, d) on one curve; ``cuts`` (dims, quantiles) spread every axis evenly over its cells.

    Norms above ``top`` come after all others.
    """
    y = projected(vectors, top, curve, dims, seed)
    shift = np.random.default_rng((seed, curve, 1)).uniform(0, 1, y.shape[1])
    even = np.linspace(0, 1, cuts.shape[1])
    unit = np.stack([np.interp(v, c, even) for v, c in zip(y.T, cuts)], axis=1)
    cells = 1 << bits
    grid = np.minimum((unit + shift) * (cells / 2), cells - 1).astype(np.int64)
    return hilbert_index(grid, bits) + np.where(np.einsum("ij,ij->i", vectors, vectors) > top * top * (1 + 1e-9), np.int64(1) << 62, 0)


def axis_cuts(classes: DataFrame, top: float, curves: int) -> np.ndarray:
    """(curves, dims, QUANTILES + 1): quantiles of every projected axis over all classes, by partial sketches."""
    d = len(classes.first()["vec"]) // 8
    dims = min(DIMS, d + 1)
    names = [f"y{i}" for i in range(curves * dims)]

    def project(batches):
        for b in batches:
            vec = b.column("vec")
            if len(vec):
                x = np.frombuffer(b"".join(vec.to_pylist())).reshape(len(vec), -1)
                y = np.concatenate([projected(x, top, c) for c in range(curves)], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in np.ascontiguousarray(y.T)], names)

    at = [i / QUANTILES for i in range(QUANTILES + 1)]
    marks = classes.select("vec").mapInArrow(project, ", ".join(f"{n} double" for n in names)).agg(
        *[F.percentile_approx(n, at, 10 * QUANTILES).alias(n) for n in names]).first()
    return np.array([marks[n] for n in names]).reshape(curves, dims, -1)


def usable(df: DataFrame, id_col: str, vec_col: str, every: int) -> DataFrame:
    """(id, vec, norm, asks): vectors that take part, as 64-bit floats in bytes."""
    modest_batches(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = size["d"] if size else 1
    rows = rows.where(F.size("v") == d)

    def pack(batches):
        for b in batches:
            v = b.column("v")
            x = np.asarray(v.flatten()).reshape(-1, d) + 0.0  # -0.0 becomes 0.0
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([r.tobytes() for r in x], pa.binary()),
                                              pa.array(np.sqrt((x * x).sum(axis=1)))], ["id", "vec", "norm"])

    out = rows.mapInArrow(pack, "id long, vec binary, norm double").withColumn("asks", F.col("id") % every == 0)
    return stage(out, "vectors")


def nearest(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, every: int = 20,
            curves: int = CURVES, block: int = BLOCK, halo: int = HALO, rest_bytes: int = REST_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of every row whose id is divisible by ``every``."""
    rows = usable(df, id_col, vec_col, every)
    classes = stage(rows.groupBy("vec").agg(F.min("id").alias("rep"), F.max("asks").alias("asks"), F.max("norm").alias("norm")), "classes")
    placed = curve_order(classes, curves)
    found = rest(placed, curve_lists(placed, k, block, halo), k, rest_bytes)
    # copies of the query itself: its class, unless it is alone
    own = classes.where("asks").select(F.col("rep").alias("q"), F.col("rep").alias("c"), _self_product("vec").alias("score"))
    members = rows.join(classes.select("vec", "rep"), "vec").select("rep", "id", "asks").distinct()
    members = stage(members, "members")
    by_class = Window.partitionBy("rep").orderBy("id")
    few = members.withColumn("n", F.row_number().over(by_class)).where(F.col("n") <= k + 1).select(F.col("rep").alias("c"), "id")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    lists = found.unionByName(own).join(few, "c").withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    lists = stage(lists.select(F.col("q").alias("rep"), F.col("id").alias("vec_id"), "score", "n"), "class-lists")
    # of the k + 1 best of its class, a query drops itself; ranks after it move up
    asks = members.where("asks").select("rep", F.col("id").alias("query_id"))
    me = lists.select("rep", F.col("vec_id").alias("query_id"), F.col("n").alias("mine"))
    out = asks.join(me, ["rep", "query_id"], "left").join(lists, "rep").where("vec_id <> query_id")
    rank = F.col("n") - F.when(F.col("mine") < F.col("n"), 1).otherwise(0)
    return out.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def curve_order(classes: DataFrame, curves: int) -> DataFrame:
    """(curve, place, rep, asks, vec): the place of every class on every curve."""
    # the few largest norms form a class of their own, so that they neither squeeze the others nor widen their blocks
    top = classes.agg(F.percentile_approx("norm", 0.999, 10_000)).first()[0]
    cuts = axis_cuts(classes, top, curves) if top else None

    def keys(batches):
        for b in batches:
            vec = b.column("vec")
            if not len(vec):
                continue
            x = np.frombuffer(b"".join(vec.to_pylist())).reshape(len(vec), -1)
            for c in range(curves):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), c)), pa.array(curve_keys(x, top, c, cuts[c])), b.column("rep"), b.column("asks"), vec],
                                                 ["curve", "key", "rep", "asks", "vec"])

    def number(batches):
        """Place of every row among the rows of its curve in this range partition."""
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            curve = b.column("curve").to_numpy()
            at = np.empty(len(curve), np.int64)
            for c in np.unique(curve):
                i = np.flatnonzero(curve == c)
                at[i] = seen.get(c, 0) + np.arange(len(i))
                seen[c] = seen.get(c, 0) + len(i)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), part)), pa.array(at), b.column("curve"), b.column("rep"), b.column("asks"), b.column("vec")],
                                             ["part", "at", "curve", "rep", "asks", "vec"])

    ordered = classes.mapInArrow(keys, "curve long, key long, rep long, asks boolean, vec binary").repartitionByRange("curve", "key", "rep")
    ordered = ordered.sortWithinPartitions("curve", "key", "rep").mapInArrow(
        number, "part long, at long, curve long, rep long, asks boolean, vec binary")
    ordered = stage(ordered, "curve-order")
    base = stage(prefix_sums(ordered.withColumn("one", F.lit(1).cast("long")), ["curve"], "part", "one", "base"), "curve-offsets")
    return ordered.join(base, ["curve", "part"]).select("curve", (F.col("at") + F.col("base")).alias("place"), "rep", "asks", "vec")


def curve_lists(placed: DataFrame, k: int, block: int, halo: int) -> DataFrame:
    """(q, c, score): for every class that asks, the k best other classes of its widened block on every curve."""
    placed = placed.withColumn("own", F.floor(F.col("place") / block)).withColumn("off", F.col("place") % block)
    near = F.array_compact(F.array(F.col("own"), F.when(F.col("off") < halo, F.col("own") - 1), F.when(F.col("off") >= block - halo, F.col("own") + 1)))
    spread = placed.withColumn("block", F.explode(near)).select("curve", "block", "rep", "vec", (F.col("asks") & (F.col("own") == F.col("block"))).alias("asks"))

    def compare(t: pa.Table) -> pa.Table:
        t = t.combine_chunks().sort_by("rep")
        rep, asks = t["rep"].to_numpy(), np.asarray(t["asks"])
        x = np.frombuffer(b"".join(t["vec"].to_pylist())).reshape(len(rep), -1)
        q, c, s = [], [], []
        ask = np.flatnonzero(asks)
        for a in range(0, len(ask), 256):
            some = ask[a:a + 256]
            score = x[some] @ x.T
            score[np.arange(len(some)), some] = -np.inf
            m = min(k, len(rep) - 1)
            for row, i in zip(score, some):
                if not m:
                    continue
                # everything that ties with the m-th best, so that ties go to smaller ids; rounding may hide a tie
                least = np.partition(row, len(row) - m)[len(row) - m]
                best = np.flatnonzero(row >= least - 1e-9 * (1 + abs(least)))
                exact = (x[best] * x[i]).sum(axis=1)
                best = best[np.lexsort((rep[best], -exact))][:m]
                q.append(np.full(len(best), rep[i]))
                c.append(rep[best])
                s.append((x[best] * x[i]).sum(axis=1))
        q, c, s = (np.concatenate(v) if v else np.zeros(0, d) for v, d in ((q, np.int64), (c, np.int64), (s, np.float64)))
        return pa.table({"q": q, "c": c, "score": s})

    return spread.groupBy("curve", "block").applyInArrow(compare, "q long, c long, score double").dropDuplicates(["q", "c"])


def rest(placed: DataFrame, lists: DataFrame, k: int, rest_bytes: int = REST_BYTES) -> DataFrame:
    """(q, c, score): every class that can be among the k best others of a class that asks, by comparing blocks.

    ``lists`` gives each query its bound: k classes reach the k-th of its scores, so a class below it is not needed.
    """
    d = (placed.select(F.length("vec").alias("n")).first() or [8])[0] // 8
    size = max(1, rest_bytes // (8 * d))
    by_score = Window.partitionBy("q").orderBy(F.desc("score"))
    bounds = lists.withColumn("n", F.row_number().over(by_score)).where(F.col("n") == k).select(F.col("q").alias("rep"), F.col("score").alias("bound"))
    line = placed.where("curve = 0").withColumn("b", F.floor(F.col("place") / size))
    ask = line.where("asks").join(bounds, "rep", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    ask = ask.withColumn("b", F.floor(F.col("b") / REST_QUERIES))

    def pack(t: pa.Table) -> pa.Table:
        t = t.combine_chunks().sort_by("rep")
        x = np.frombuffer(b"".join(t["vec"].to_pylist())).reshape(t.num_rows, -1)
        mid = x.mean(axis=0)
        bound = t["bound"].to_numpy() if "bound" in t.column_names else np.zeros(0)
        return pa.table({"b": t["b"][:1], "reps": [t["rep"].to_numpy().tobytes()], "vecs": [x.tobytes()], "bounds": [bound.tobytes()],
                         "mid": [mid.tobytes()], "far": [np.sqrt(((x - mid) ** 2).sum(axis=1)).max()],
                         "norm": [np.sqrt((x * x).sum(axis=1)).max()], "least": [bound.min() if len(bound) else 0.0]},
                        schema=pa.schema([("b", pa.int64())] + [(n, pa.binary()) for n in ("reps", "vecs", "bounds", "mid")]
                                         + [(n, pa.float64()) for n in ("far", "norm", "least")]))

    packed = "b long, reps binary, vecs binary, bounds binary, mid binary, far double, norm double, least double"
    rows = stage(line.select("b", "rep", "vec").groupBy("b").applyInArrow(pack, packed), "row-blocks")
    queries = stage(ask.select("b", "rep", "vec", "bound").groupBy("b").applyInArrow(pack, packed), "query-blocks")

    @F.pandas_udf("double")
    def product(a, b):
        import pandas as pd

        return pd.Series([float(np.frombuffer(u) @ np.frombuffer(v)) for u, v in zip(a, b)], dtype="float64")

    # |q . x| <= |q| |x|, and q . x = mid_q . mid_x + (q - mid_q) . mid_x + q . (x - mid_x)
    ends = ("mid", "far", "norm")
    pairs = queries.select(F.col("b").alias("s"), "least", *[F.col(n).alias(f"q_{n}") for n in ends]).crossJoin(
        rows.select(F.col("b").alias("r"), *[F.col(n).alias(f"x_{n}") for n in ends]))
    both = F.col("q_norm") * F.col("x_norm")
    reach = F.least(both, product("q_mid", "x_mid") + F.col("q_far") * F.col("x_norm") + F.col("q_norm") * F.col("x_far"))
    pairs = stage(pairs.where(reach + 1e-9 * both >= F.col("least")).select("s", "r"), "block-pairs")

    def compare(batches):
        for batch in batches:
            for p in batch.to_pylist():
                rep, x, mid = np.frombuffer(p["reps"], np.int64), np.frombuffer(p["vecs"]).reshape(-1, d), np.frombuffer(p["mid"])
                name, ask, bound = np.frombuffer(p["q_reps"], np.int64), np.frombuffer(p["q_vecs"]).reshape(-1, d), np.frombuffer(p["q_bounds"])
                norm = np.sqrt((ask * ask).sum(axis=1))
                slack = 1e-14 * d * norm * p["norm"]  # rounding may hide a tie
                may = np.flatnonzero(np.minimum(norm * p["norm"], ask @ mid + norm * p["far"]) + 1e5 * slack >= bound)
                q, c, s = [], [], []
                for a in range(0, len(may), 256):
                    some = may[a:a + 256]
                    score = ask[some] @ x.T
                    score[rep[None, :] == name[some][:, None]] = -np.inf
                    least = (bound - slack)[some]
                    for j in np.flatnonzero((score >= least[:, None]).sum(axis=1) > k):  # many ties, or no bound
                        least[j] = max(least[j], np.partition(score[j], len(rep) - k)[len(rep) - k] - 2 * slack[some[j]])
                    i, j = np.nonzero((score >= least[:, None]) & (score > -np.inf))
                    exact = (x[j] * ask[some[i]]).sum(axis=1)
                    order = np.lexsort((rep[j], -exact, i))
                    i, j, exact = i[order], j[order], exact[order]
                    first = np.searchsorted(i, i)  # of k better ones with smaller ids none is left out
                    keep = np.arange(len(i)) - first < k
                    q.append(name[some[i[keep]]])
                    c.append(rep[j[keep]])
                    s.append(exact[keep])
                if q:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v)) for v in (q, c, s)], ["q", "c", "score"])

    work = pairs.join(queries.select(F.col("b").alias("s"), F.col("reps").alias("q_reps"), F.col("vecs").alias("q_vecs"), F.col("bounds").alias("q_bounds")), "s")
    work = work.join(rows.select(F.col("b").alias("r"), "reps", "vecs", "mid", "far", "norm"), "r")
    return work.drop("s", "r").mapInArrow(compare, "q long, c long, score double")


def _self_product(col: str):
    @F.pandas_udf("double")
    def product(v):
        import pandas as pd

        return pd.Series([float((x * x).sum()) for x in (np.frombuffer(b) for b in v)])

    return product(F.col(col))


def recall(df: DataFrame, found: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, every: int = 20, lot: int = 4096) -> float:
    """Share of the true k nearest of every query that ``found`` has, by comparing all queries with all rows.

    For measuring only: the queries, a ``every``-th of the rows, are sent to all tasks.
    """
    rows = usable(df, id_col, vec_col, every)
    ask = [(r["id"], r["vec"]) for r in rows.where("asks").select("id", "vec").collect()]
    if not ask:
        return 1.0
    ids, q = np.array([a for a, _ in ask]), np.frombuffer(b"".join(v for _, v in ask)).reshape(len(ask), -1)

    def best(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, own = np.frombuffer(b"".join(b.column("vec").to_pylist())).reshape(b.num_rows, -1), b.column("id").to_numpy()
            for i in range(0, len(ids), lot):
                score = x @ q[i:i + lot].T
                score[own[:, None] == ids[None, i:i + lot]] = -np.inf
                for j in range(score.shape[1]):
                    m = np.argsort(-score[:, j], kind="stable")[:k]
                    m = m[np.isfinite(score[m, j])]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(m), ids[i + j])), pa.array(own[m]), pa.array(score[m, j])], ["query_id", "vec_id", "s"])

    order = Window.partitionBy("query_id").orderBy(F.desc("s"), "vec_id")
    true = rows.mapInArrow(best, "query_id long, vec_id long, s double").withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)
    hit = true.join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return hit.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]


def op5_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
