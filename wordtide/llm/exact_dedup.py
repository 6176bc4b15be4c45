"""Exact duplicates by deterministic block naming, in DataFrame functions only.

Method: cut each normalised text into fixed-size byte blocks, sort the distinct blocks
and give each an integer name, then name adjacent pairs of names again and again until
every document has one name. Names come from sorting contents, so two documents of the
same length have the same final name exactly when they are equal; no hash decides.

Documents whose (length, 64-bit hash) occurs once have no twin and skip the naming: equal
texts always agree in both, so nothing is lost. All rows of larger groups are named.

Plan: one pass over the texts for length, hash and digest; one exchange of the texts
keyed by (length, hash), which AQE splits for a hot group; the names of each level are
staged, so the join that hands them out has a plain scan on either side and AQE can split
a block that a third of all rows share. Groups are aggregates with partial sums.

Defined cases: a null text counts as empty, and empty texts are equal; ties between rows
of equal text go to the largest id (null ids last); rows that repeat an id are all reported and
all counted in ``group_size``; an empty table gives an empty result; other columns are
ignored (``keep_rows`` returns them untouched).
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.llm._common import free_name, join_null_safe, stage

BLOCK_BYTES = 16384


def normalised(text: Column) -> Column:
    """Lower-case A-Z only; null becomes the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def _integer_names(df: DataFrame, cols: list[str], name: str) -> DataFrame:
    """Distinct ``cols``, sorted within hash partitions, each with its own integer in that order.

    A global sort would send samples of whole blocks to the driver, and only equality of names matters.
    """
    distinct = df.select(*cols).distinct().sortWithinPartitions(*cols)
    return stage(distinct.withColumn(name, F.monotonically_increasing_id()), "block-names")


def _named(df: DataFrame, cols: list[str], name: str, keep: list[str]) -> DataFrame:
    names = _integer_names(df, cols, name)
    return df.join(names, cols).select(*keep, name)


def block_names(texts: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(_id, _sha, _n, _text) -> (_id, _sha, _n, _name): one name per text.

    Names are comparable between texts of equal byte length ``_n``.
    """
    body = F.col("_text").cast("binary")
    last = F.greatest(F.floor((F.col("_n") - 1) / block_bytes), F.lit(0)).cast("int")
    blocks = texts.select(
        "_id", "_sha", "_n",
        F.posexplode(F.transform(F.sequence(F.lit(0), last),
                                 lambda i: F.substring(body, i * block_bytes + 1, F.lit(block_bytes)))).alias("_pos", "_block"))
    blocks = stage(blocks, "blocks")
    cur = stage(_named(blocks, ["_block"], "_name", ["_id", "_sha", "_n", "_pos"]), "named")
    done = []
    left = F.ceil(F.greatest(F.col("_n"), F.lit(1)) / block_bytes)  # blocks of the text at this level
    most = blocks.agg(F.max("_pos")).first()[0]  # one number: the largest block index
    while most is not None:
        done.append(cur.where(left <= 1).select("_id", "_sha", "_n", "_name"))
        if most == 0:
            break
        half = (F.col("_pos") / 2).cast("int")
        odd = F.col("_pos") % 2 == 1
        pairs = (cur.where(left > 1).groupBy("_id", "_sha", "_n", half.alias("_half"))
                 .agg(F.max(F.when(~odd, F.col("_name"))).alias("_a"),
                      F.coalesce(F.max(F.when(odd, F.col("_name"))), F.lit(-1)).alias("_b"))
                 .withColumnRenamed("_half", "_pos"))
        pairs = stage(pairs, "pairs")
        cur = stage(_named(pairs, ["_a", "_b"], "_name", ["_id", "_sha", "_n", "_pos"]), "named")
        left = F.ceil(left / 2)
        most //= 2
    if not done:
        return cur.select("_id", "_sha", "_n", "_name")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: (id, keep_id, group_size, kept, text_sha256)."""
    docs = df.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_text"))
    docs = docs.select("_id", "_text", F.octet_length("_text").alias("_n"), F.xxhash64("_text").alias("_h"))
    sha = F.sha2(F.col("_text").cast("binary"), 256).alias("_sha")
    base = stage(docs.select("_id", "_n", "_h", sha), "digests")
    twins = stage(base.groupBy("_n", "_h").count().where("count > 1").select("_n", "_h"), "twins")
    # rows that repeat an id with the same text have one name; they are counted in `base`
    mult = base.groupBy("_id", "_sha").agg(F.count(F.lit(1)).alias("_rows"))
    texts = docs.join(twins, ["_n", "_h"]).select("_id", sha, "_n", "_text")
    named = block_names(texts, block_bytes).distinct()
    named = stage(join_null_safe(named, mult, ["_id", "_sha"]), "identities")
    groups = stage(named.groupBy("_n", "_name").agg(F.max("_id").alias("keep_id"), F.sum("_rows").alias("group_size"))
                   .where("group_size > 1"), "groups")
    found = stage(named.join(groups, ["_n", "_name"]).select("_id", "_sha", "keep_id", "group_size"), "found")
    out = join_null_safe(base, found, ["_id", "_sha"], "left")
    keep = F.when(F.col("group_size").isNotNull(), F.col("keep_id")).otherwise(F.col("_id"))
    return out.select(F.col("_id").alias(id_col), keep.alias("keep_id"),
                      F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                      F.col("_id").eqNullSafe(keep).alias("kept"), F.col("_sha").alias("text_sha256"))


def keep_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns; one row where an id repeats with the same text."""
    kept = exact_dedup(df, id_col, text_col).where("kept").groupBy(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha")).count()
    kept = stage(kept, "kept")
    sha = free_name(df, "_sha")
    rows = df.withColumn(sha, F.sha2(normalised(F.col(text_col)).cast("binary"), 256))
    rows = rows.join(kept, rows[id_col].eqNullSafe(kept["_id"]) & (rows[sha] == kept["_sha"]), "left_semi")
    if not kept.where("count > 1").isEmpty():
        rows = rows.dropDuplicates([id_col, sha])
    return rows.drop(sha)


def op10_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
