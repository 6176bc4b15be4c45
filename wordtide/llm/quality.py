"""Quality classifier with hierarchical empirical Bayes.

Evidence of a document: a logistic regression on features of its whole text (word repetition, letter case,
symbols, line structure), fitted on at most ``sample`` labelled rows. Evidence of its site: the scores of the
other documents of its host and of its path there. Sites are shrunk step by step, each by the ratio of
within-site to between-site variance that its level shows: a host towards the global mean, a path towards its host. A
sparse site thus stays near its prior and a large one speaks for itself:

  host  = (sum of the host's other scores + k_host * global) / (their number + k_host)
  path  = (sum of the path's other scores + k_path * host)   / (their number + k_path)
  score = sigmoid(logit(document) - logit(base rate of the labels) + logit(path))

A document is kept when ``score`` is at least ``threshold``. Its own score is left out of its site's
sums, so it does not count twice.

Plan: one pass over the texts gives one narrow staged row per document; sums by path are partial aggregates
over all documents, hosts come from paths, and the variance ratios are two scalars. The join that
brings the sums back has staged scans on both sides, so AQE splits a host that holds a third of the
rows. The sample, the only rows that reach the driver, is the ``sample`` labelled documents with the
smallest hash of their id (a bound of the fit alone; all documents are scored and counted).

Defined cases: a text without words (null, empty, white space) has document score 0 and is rejected; null
hosts and paths are sites of their own; labels that are null are ignored, an id with several labels has the largest;
without labels of both classes every document score is the base rate (1 without labels) and texts with words are
kept when that reaches the threshold; rows that repeat an id are scored each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from typing import Optional

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.llm._common import free_name, join_null_safe, modest_batches, stage

SAMPLE = 20_000
THRESHOLD = 0.5
FEATURES = ["log_words", "distinct", "herdan", "top_word", "upper_words", "digits", "symbols", "exclaims", "pipes",
            "word_length", "repeated_lines", "other_bytes"]
SHRINK_MOST = 1e9

_BYTES = np.arange(256)
_CLASSES = np.stack([
    np.isin(_BYTES, list(b"0123456789")),
    np.isin(_BYTES, list(b"#$%&*+/<=>@[\\]^_`{}~")),
    _BYTES == ord("!"),
    _BYTES == ord("|"),
    (_BYTES >= 128),
]).astype(np.float64)


def text_features(text: bytes) -> Optional[list[float]]:
    """The features of one text, None without words."""
    words = text.split()
    if not words:
        return None
    counts: dict = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    n, d = len(words), len(counts)
    share = _CLASSES @ np.bincount(np.frombuffer(text, np.uint8), minlength=256) / len(text)
    lines = [x for x in text.split(b"\n") if x.strip()]
    upper = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper())
    return [float(np.log1p(n)), d / n, float(np.log1p(d) / np.log1p(n)), max(counts.values()) / n, upper / n, *share[:4].tolist(),
            sum(map(len, words)) / n, 1 - len(set(lines)) / max(1, len(lines)), float(share[4])]


def featured(df: DataFrame, id_col: str, text_col: str, host, path) -> DataFrame:
    """(_id, _hash, _host, _path, features...) staged; all features are null without words."""
    modest_batches(df.sparkSession)
    src = df.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_hash"), host.cast("string").alias("_host"),
                    path.cast("string").alias("_path"), F.col(text_col).cast("binary").alias("_text"))
    id_type = src.schema["_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = [text_features(t.as_py()) if t.is_valid else None for t in b.column("_text")]
            cols = [pa.array([r[i] if r else None for r in rows], pa.float64()) for i in range(len(FEATURES))]
            names = ["_id", "_hash", "_host", "_path"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *cols], [*names, *FEATURES])

    return stage(src.mapInArrow(run, f"_id {id_type}, _hash long, _host string, _path string, " + ", ".join(f"{f} double" for f in FEATURES)), "features")


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic regression on raw features, by Newton steps."""
    mean, sd = x.mean(axis=0), x.std(axis=0)
    sd[sd == 0] = 1
    z = np.column_stack([(x - mean) / sd, np.ones(len(x))])
    w, pen = np.zeros(z.shape[1]), np.full(z.shape[1], ridge * len(x) / 100)
    pen[-1] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(pen)
        step = np.linalg.solve(h, z.T @ (y - p) - pen * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1] / sd, float(w[-1] - (w[:-1] * mean / sd).sum())


def _logit(c):
    p = F.least(F.greatest(c, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(p / (1 - p))


def document_scores(rows: DataFrame, labels: DataFrame, label_id: str, label_col: str, sample: int) -> tuple[DataFrame, float]:
    """``rows`` with ``p``, the probability of good quality by the text alone (null without words), and the base rate."""
    lab = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(label_id).alias("_lid")).agg(F.max(label_col).alias("_y"))
    joined = rows.where(F.col(FEATURES[0]).isNotNull()).join(lab, rows["_id"] == lab["_lid"])
    # about 1.2 times the sample by hash, then the smallest hashes of it: no task returns more than its share
    share = min(1.0, 1.2 * sample / max(1, joined.count()) + 0.001)
    some = joined.where(F.pmod(F.xxhash64("_lid"), F.lit(1 << 30)) < int(share * (1 << 30)))
    some = some.orderBy(F.pmod(F.xxhash64("_lid"), F.lit(1 << 30)), "_lid", *FEATURES).limit(sample).select(*FEATURES, "_y").collect()
    data = np.array([tuple(r) for r in some], dtype=float).reshape(-1, len(FEATURES) + 1)
    y = (data[:, -1] > 0).astype(float)
    base = float(y.mean()) if len(y) else 1.0
    words = F.col(FEATURES[0]).isNotNull()
    if not 0 < base < 1:
        return rows.withColumn("p", F.when(words, F.lit(base))), base
    w, b = fit(data[:, :-1], y)
    z = F.lit(b)
    for name, weight in zip(FEATURES, w):
        z = z + F.lit(float(weight)) * F.col(name)
    return rows.withColumn("p", F.when(words, 1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0)))))), base


def variance_ratio(groups: DataFrame, n: str, s: str, ss: str) -> tuple[float, float]:
    """(mean, within-variance / between-variance) of groups with count n, sum s and sum of squares ss: how many
    documents the prior of the level is worth. One row reaches the driver."""
    r = groups.agg(F.count(F.lit(1)).alias("g"), F.sum(n).alias("n"), F.sum(s).alias("s"), F.sum(ss).alias("ss"),
                   F.sum(F.col(s) * F.col(s) / F.col(n)).alias("b"), F.sum(F.col(n).cast("double") * F.col(n)).alias("nn")).first()
    if not r["n"]:
        return 0.5, SHRINK_MOST
    mean, g, n_ = r["s"] / r["n"], r["g"], r["n"]
    if g < 2 or n_ <= g:
        return mean, SHRINK_MOST
    within = max(0.0, (r["ss"] - r["b"]) / (n_ - g))
    size = (n_ - r["nn"] / n_) / (g - 1)
    between = ((r["b"] - n_ * mean * mean) / (g - 1) - within) / size if size > 0 else 0.0
    return mean, min(SHRINK_MOST, within / between) if between > 0 else SHRINK_MOST


def classify(df: DataFrame, labels: DataFrame, host, path, id_col: str = "doc_id", text_col: str = "text",
             label_id: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: (id, doc_score, host_score, path_score, score, kept, text_hash).

    ``host`` and ``path`` are columns of ``df``.
    """
    rows, base = document_scores(featured(df, id_col, text_col, host, path), labels, label_id, label_col, sample)
    p = F.col("p")
    paths = rows.where(p.isNotNull()).groupBy("_host", "_path").agg(
        F.count(F.lit(1)).alias("n_p"), F.sum(p).alias("s_p"), F.sum(p * p).alias("ss_p"))
    paths = stage(paths, "path-sums")
    hosts = stage(paths.groupBy("_host").agg(F.sum("n_p").alias("n_h"), F.sum("s_p").alias("s_h"), F.sum("ss_p").alias("ss_h")), "host-sums")
    mean, k_host = variance_ratio(hosts, "n_h", "s_h", "ss_h")
    # a path's spread is taken within its host: host sums enter as sums about the host's mean
    about = paths.join(hosts, paths["_host"].eqNullSafe(hosts["_host"])).select(
        "n_p", (F.col("s_p") - F.col("n_p") * F.col("s_h") / F.col("n_h")).alias("d"),
        (F.col("ss_p") - 2 * F.col("s_p") * F.col("s_h") / F.col("n_h") + F.col("n_p") * F.pow(F.col("s_h") / F.col("n_h"), 2)).alias("dd"))
    _, k_path = variance_ratio(about, "n_p", "d", "dd")
    sites = stage(join_null_safe(paths, hosts, ["_host"]).select("_host", "_path", "n_p", "s_p", "n_h", "s_h"), "site-sums")
    out = join_null_safe(rows.select("_id", "_hash", "_host", "_path", "p"), sites, ["_host", "_path"], "left")
    mine, one = F.coalesce(p, F.lit(0.0)), F.when(p.isNotNull(), 1).otherwise(0)
    others = lambda s, n, k, prior: ((F.coalesce(F.col(s), F.lit(0.0)) - mine + k * prior)
                                     / (F.coalesce(F.col(n), F.lit(0)) - one + k))
    tiny = 1e-9  # a site of one document and no spread falls back on its prior
    out = out.withColumn("host_score", others("s_h", "n_h", F.lit(max(k_host, tiny)), F.lit(mean)))
    out = out.withColumn("path_score", others("s_p", "n_p", F.lit(max(k_path, tiny)), F.col("host_score")))
    score = 1 / (1 + F.exp(-(_logit(p) - _logit(F.lit(base)) + _logit(F.col("path_score")))))
    out = out.withColumn("score", F.when(p.isNotNull(), score).otherwise(0.0))
    return out.select(F.col("_id").alias(id_col), F.coalesce(p, F.lit(0.0)).alias("doc_score"), "host_score", "path_score", "score",
                      (p.isNotNull() & (F.col("score") >= threshold)).alias("kept"), F.col("_hash").alias("text_hash"))


def keep_rows(df: DataFrame, labels: DataFrame, host, path, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that are kept, with all their columns."""
    kept = classify(df, labels, host, path, id_col, text_col, **options).where("kept")
    kept = stage(kept.select(F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash")), "kept")
    name = free_name(df, "_text_hash")
    rows = df.withColumn(name, F.xxhash64(F.col(text_col)))
    on = rows[id_col].eqNullSafe(kept["_id"]) & (rows[name] == kept["_hash"])
    return rows.join(kept, on, "left_semi").drop(name)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), host=F.col("source"), path=F.col("lang"))
    return out.drop("text_hash")


def url_site(url) -> tuple:
    """(host, first path segment) of a URL column, for tables of pages."""
    return (F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1)),
            F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]*)", 1))
