"""Centroid clustering on integer vectors, with a table of pivot distances (LAESA).

Vectors become integers, floor(scale * x), and everything after that is exact. Pivots are vectors of
the input that lie far from each other. The distances from every vector to every pivot are computed
once and stored beside the vectors. In each round the driver measures the few centroids against the
pivots; |d(x, p) - d(c, p)| is a lower bound of d(x, c) for each pivot p, so per vector only centroids whose
bound does not exceed the best distance so far get an exact integer distance. Ties go to the smaller number.
New centroids are floor(sum / count) per component; clusters without vectors keep theirs.

Plan: one pass makes the stored table; each round is one scan of it that returns sums per task, folded by a
grouped aggregate into at most clusters x components rows, the only data that reaches the driver. Sums
travel as digits of base 2^40, so they never overflow. No row of the input is shuffled.

Pivots are chosen greedily among the ``SAMPLE`` vectors of smallest hash (the bound of the sample; any choice gives
the same result): each next one has the largest sum of distances to those before it.

Defined cases: vectors that are null, of another length, or hold a null or non-finite component are left
out; rows that repeat an id are separate vectors, taken as starting centroids in order of their components; a null id
has the text ``null`` in the hash; with fewer vectors than clusters there are as many clusters as vectors;
components may be as large as doubles are (such vectors are compared with Python's integers); a distance
or inertia beyond a 64-bit integer is reported as the largest one; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from typing import Optional

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtide.llm._common import modest_batches, stage

COMPONENTS, SCALE, CLUSTERS, ROUNDS, SALT = 64, 1024, 8, 10, "3:"
PIVOTS, SAMPLE = 16, 512
DIGIT = 40
LARGE = 1 << 27        # components up to here: 64 squared differences fit 64 bits for up to 128 components
SLACK = 1e-14          # relative error that the bounds allow for rounded square roots
MOST = (1 << 63) - 1
LOT = 4096


def integers(rows, scale: int) -> np.ndarray:
    """floor(scale * x) as int64, or as Python integers if one is large."""
    x = np.floor(np.asarray(rows, np.float64) * float(scale))
    if x.size and np.abs(x).max() > LARGE:
        exact = [[math.floor(float(v)) * scale if abs(v) > 1e300 else math.floor(float(v) * scale) for v in r] for r in rows]
        return np.array(exact, object)
    return x.astype(np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` from ``b``, a row or as many rows."""
    if b.dtype == object or a.dtype == object:
        a, b = a.astype(object), b.astype(object)
    d = a - b
    return (d * d).sum(axis=1)


def roots(d: np.ndarray) -> np.ndarray:
    if d.dtype != object:
        return np.sqrt(d.astype(np.float64))
    return np.array([float(min(math.isqrt(int(v)), 10 ** 300)) for v in d])  # capping both keeps their difference a lower bound


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([roots(squared(x, p)) for p in pivots], axis=1)


def choose_pivots(x: np.ndarray, n: int) -> np.ndarray:
    """Indices of up to ``n`` distinct vectors, each the farthest in sum from those before."""
    total = roots(squared(x, x[0]))
    picked = [0]
    while len(picked) < min(n, len(x)):
        total[picked] = -1.0
        best = int(total.argmax())
        picked.append(best)
        total += roots(squared(x, x[best]))
    return np.array(picked)


def assign(x: np.ndarray, table: np.ndarray, centroids: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, exact squared distance, number of distances computed) for every row of ``x``.

    ``table`` has the rows' distances from the pivots, ``to_pivots`` the centroids'.
    """
    # rounding moves a bound by less than SLACK of its terms; a root from isqrt by less than 1
    whole = 2.0 if x.dtype == object or centroids.dtype == object else 0.0
    bound = np.stack([(np.abs(table - c) - SLACK * (table + c)).max(axis=1) - whole for c in to_pivots], axis=1)
    cluster = bound.argmin(axis=1)
    best = squared(x, centroids[cluster])
    done = len(x)
    first = cluster.copy()
    for j in range(len(centroids)):
        m = np.flatnonzero((first != j) & (bound[:, j] <= roots(best) * (1 + SLACK) + whole))
        if len(m):
            done += len(m)
            d = squared(x[m], centroids[j])
            better = (d < best[m]) | ((d == best[m]) & (j < cluster[m]))
            best[m[better]], cluster[m[better]] = d[better], j
    return cluster, best, done


def _lots(batch: pa.RecordBatch, scale: int):
    """(ids, integer vectors, pivot distances) of the stored table, ``LOT`` rows at a time."""
    for a in range(0, batch.num_rows, LOT):
        b = batch.slice(a, LOT)
        flat = lambda name: b.column(name).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
        yield b.column("_id"), integers(flat("_vec"), scale), flat("_table")


def store(df: DataFrame, pivots: list[list[float]], scale: int) -> DataFrame:
    """(_id, _vec) with ``_table``, the distances from the pivots."""
    def measure(batches):
        p = integers(pivots, scale)
        for batch in batches:
            for a in range(0, batch.num_rows, LOT):
                b = batch.slice(a, LOT)
                vec = b.column("_vec")
                x = integers(vec.flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1), scale)
                t = pivot_distances(x, p)
                col = pa.ListArray.from_arrays(pa.array(np.arange(0, t.size + 1, t.shape[1]), pa.int32()), pa.array(t.reshape(-1)))
                yield pa.RecordBatch.from_arrays([b.column("_id"), vec, col], ["_id", "_vec", "_table"])

    schema = f"{df.select('_id', '_vec').schema.simpleString()[7:-1].replace(':', ' ', 1).replace(',_vec:', ', _vec ')}, _table array<double>"
    return stage(df.mapInArrow(measure, schema), "pivot-table")


def _move(table: DataFrame, centroids: np.ndarray, to_pivots: np.ndarray, scale: int) -> tuple[list, int]:
    """The centroids after one round, and how many exact distances it took."""
    k, size = centroids.shape

    def sums(batches):
        total, count, done = np.zeros((k, size), object), np.zeros(k, np.int64), 0
        for batch in batches:
            for _, x, t in _lots(batch, scale):
                cluster, _, n = assign(x, t, centroids, to_pivots)
                done += n
                count += np.bincount(cluster, minlength=k)
                for j in range(k):
                    total[j] += x[cluster == j].sum(axis=0).astype(object)
        rows = [(j, -1, 0, int(c)) for j, c in enumerate(count)] + [(-1, -1, 0, done)]
        for j in range(k):
            for i, v in enumerate(total[j]):
                sign, v, digit = (-1 if v < 0 else 1), abs(int(v)), 0
                while v:
                    rows.append((j, i, digit, sign * (v & ((1 << DIGIT) - 1))))
                    v, digit = v >> DIGIT, digit + 1
        j, i, d, v = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(j, pa.int32()), pa.array(i, pa.int32()), pa.array(d, pa.int32()), pa.array(v, pa.int64())],
                                         ["cluster", "part", "digit", "value"])

    parts = table.mapInArrow(sums, "cluster int, part int, digit int, value long")
    # at most clusters x components x digits rows
    total = np.zeros((k, size), object)
    count, done = [0] * k, 0
    for r in parts.groupBy("cluster", "part", "digit").agg(F.sum("value").alias("value")).collect():
        if r.cluster < 0:
            done = r.value
        elif r.part < 0:
            count[r.cluster] = r.value
        else:
            total[r.cluster, r.part] += r.value << (DIGIT * r.digit)
    new = centroids.astype(object)
    for j in range(k):
        if count[j]:
            new[j] = [v // count[j] for v in total[j]]
    return new, done


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64) if x.dtype == object and all(abs(v) <= LARGE for v in x.reshape(-1)) else x


def cluster_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
                    clusters: int = CLUSTERS, rounds: int = ROUNDS, salt: str = SALT, pivots: int = PIVOTS,
                    work: Optional[list] = None) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector kept.

    ``work``, if given, gets (exact distances computed, vectors x clusters) of every round.
    """
    spark = df.sparkSession
    modest_batches(spark)
    vec = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    rows = df.select(F.col(id_col).alias("_id"), vec.alias("_vec"))
    sound = F.forall("_vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = rows.where((F.size("_vec") == components) & F.coalesce(sound, F.lit(False)))
    text = F.concat(F.lit(salt), F.coalesce(F.col("_id").cast("string"), F.lit("null")))
    # a sample of fixed size: the starting centroids and the candidates for pivots
    sample = [r._vec for r in rows.orderBy(F.sha2(text, 256), "_vec").limit(max(SAMPLE, clusters)).collect()]
    id_type = df.schema[id_col].dataType.simpleString()
    out = f"{id_col} {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not sample:
        return spark.createDataFrame([], out)
    x = integers(sample, scale)
    points = [sample[i] for i in choose_pivots(x, pivots)]
    table = store(rows, points, scale)
    p = integers(points, scale)
    cent = _narrow(x[:clusters])
    for _ in range(rounds):
        new, done = _move(table, cent, pivot_distances(cent, p), scale)
        if work is not None:
            work.append(done)
        cent = _narrow(new)
    to_pivots = pivot_distances(cent, p)

    def last(batches):
        for batch in batches:
            for ids, x, t in _lots(batch, scale):
                cluster, d, _ = assign(x, t, cent, to_pivots)
                d = np.array([min(int(v), MOST) for v in d], np.int64) if d.dtype == object else d
                yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(d, pa.int64())], ["_id", "cluster", "distance"])

    final = stage(table.mapInArrow(last, f"_id {id_type}, cluster int, distance long"), "clusters")
    sums = {r.cluster: int(r.total) for r in final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    whole = min(sum(sums.values()), MOST)
    facts = spark.createDataFrame(
        [(j, min(sums.get(j, 0), MOST), whole, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(cent.tolist())],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row per cluster
    return final.join(F.broadcast(facts), "cluster").select(
        F.col("_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_centroids(spark, sf_dir: str) -> DataFrame:
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql() -> str:
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {COMPONENTS}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{SALT}' || vec_id), v) - 1 AS c, v FROM kept ORDER BY c LIMIT {CLUSTERS})"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, vec_id, v, best.d AS d, best.c AS c FROM (
    SELECT r, any_value(k.vec_id) AS vec_id, any_value(k.v) AS v, min(struct_pack(
      d := list_sum(list_transform(list_zip(k.v, c{i}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c := c{i}.c)) AS best
    FROM kept k, c{i} GROUP BY r))""")
        if i < ROUNDS:
            steps.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c{i}.c, coalesce(n.v, c{i}.v) AS v FROM c{i} LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
      SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{i}) GROUP BY c, i)
    GROUP BY c) n USING (c))""")
    return "WITH" + ",".join(steps) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(z.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} z ON a.c = z.c
"""


SQL = _sql()
