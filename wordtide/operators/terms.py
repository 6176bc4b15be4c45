"""Text -> terms (T1-T5) and the term dictionary.

The dictionary is a plain DataFrame ``terms(term_id, normalized, needs_review,
is_blocked, blocked_reason, surface_examples, created_at)``.  All operators are
set-wise: one call handles every post of every date and board.
"""

from __future__ import annotations

from typing import Callable, Optional

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordtide import schemas
from wordtide.functions.text import nfkc, normalize_after_nfkc, normalize_tokens, regex_tokens

# --- fixed values ------------------------------------------------------------
# Part-of-speech tag kept from a lexicon (noun).
NOUN_POS = "名詞"
# -----------------------------------------------------------------------------

# Least number of hash buckets used to number new terms in parallel (see ``assign_term_ids``).
LEAST_ID_BUCKETS = 256


def id_buckets(spark: SparkSession) -> int:
    """As many buckets as the shuffle is wide, so numbering scales with the cluster."""
    return max(LEAST_ID_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))


# ------------------------------------------------------------------- T1 / T5


def tokenize_posts(posts: DataFrame, tokenizer: Optional[Callable[[Column], Column]] = None,
                   content_col: str = "content") -> DataFrame:
    """Add ``tokens`` (surfaces in text order; NULL = tokenizer failure) and a
    ``post_key`` that identifies a post inside its (date, board, thread).

    ``post_key`` hashes post number and content, so identical copies of a post share
    a key; counting copies separately is handled downstream by multiplicity.
    """
    tok = tokenizer(F.col(content_col)) if tokenizer else regex_tokens(F.col(content_col))
    return (posts
            .withColumn("tokens", tok)
            .withColumn("post_key", F.xxhash64(F.col("post_no"), F.col(content_col))))


def text_terms(content: Column) -> Column:
    """T1 + T3/T4: the normalised terms of a text in the default tokenizer, in text order."""
    return normalize_tokens(regex_tokens(content))


# ------------------------------------------------------------------- T2 / T3


def normalize_surfaces(surfaces: DataFrame, col: str = "surface") -> DataFrame:
    """T3/T4 on a DataFrame of *distinct* surfaces -> adds ``normalized``.

    NFKC runs in the Arrow UDF (ASCII strings return at once); it is marked nondeterministic, so
    Catalyst does not move it below the distinct. The rest of the rules are JVM expressions.
    """
    return surfaces.withColumn("normalized", normalize_after_nfkc(nfkc(F.col(col))))


def nouns(lexicon: DataFrame) -> DataFrame:
    """The surfaces that a (surface, pos) lexicon tags as nouns."""
    return lexicon.where((F.col("pos") == NOUN_POS) & (F.col("surface") != "")).select("surface").distinct()


# ------------------------------------------------------------------ D1 - D6


def empty_terms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.TERMS)


def get_by_id(terms: DataFrame, term_id) -> DataFrame:
    """D1."""
    return terms.where(F.col("term_id") == F.lit(term_id))


def get_by_normalized(terms: DataFrame, normalized) -> DataFrame:
    """D2."""
    return terms.where(F.col("normalized") == F.lit(normalized))


def get_by_ids(terms: DataFrame, ids: DataFrame) -> DataFrame:
    """D1 for a set of ids (column ``term_id``)."""
    return terms.join(ids.select("term_id").distinct(), "term_id", "left_semi")


def get_by_texts(terms: DataFrame, texts: DataFrame) -> DataFrame:
    """D2 for a set of texts (column ``normalized``)."""
    return terms.join(texts.select("normalized").distinct(), "normalized", "left_semi")


def assign_term_ids(new_terms: DataFrame, start_after: Column,
                    buckets: Optional[int] = None) -> DataFrame:
    """Dense ids ``start_after + 1 ..`` for distinct ``normalized`` values, in parallel.

    A global ``row_number()`` would run in one task.  Instead terms are hashed into
    ``buckets``; the per-bucket counts (``buckets`` rows) give each bucket an offset,
    and ids inside a bucket follow the term text.  The result depends only on the
    set of new terms, so a recomputed partition gets the same ids.
    """
    buckets = buckets or id_buckets(new_terms.sparkSession)
    b = new_terms.withColumn("_bucket", F.pmod(F.xxhash64("normalized"), F.lit(buckets)))
    counts = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # ``buckets`` rows at most: a single-partition running sum is bounded by the parameter.
    offsets = counts.withColumn(
        "_offset",
        F.coalesce(F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
    ranked = b.withColumn("_rn", F.row_number().over(Window.partitionBy("_bucket").orderBy("normalized")))
    return (ranked.join(F.broadcast(offsets.select("_bucket", "_offset")), "_bucket")
            .withColumn("term_id", (start_after + F.col("_offset") + F.col("_rn")).cast("long"))
            .drop("_bucket", "_offset", "_rn"))


def get_or_create_terms(terms: DataFrame, normalized: DataFrame,
                        buckets: Optional[int] = None) -> DataFrame:
    """D3/D4 set-wise: the dictionary plus every unseen non-empty ``normalized`` value.

    Known terms keep their ids; new ones get ``max(term_id) + 1 ..`` with the
    declared defaults (not blocked, no review, no reason).
    """
    cand = normalized.select("normalized").where(F.col("normalized") != "").distinct()
    new = cand.join(terms.select("normalized"), "normalized", "left_anti")
    start_after = F.coalesce(terms.select(F.max("term_id")).scalar(), F.lit(0).cast("long"))
    created = (assign_term_ids(new, start_after, buckets)
               .withColumn("needs_review", F.lit(False))
               .withColumn("is_blocked", F.lit(False))
               .withColumn("blocked_reason", F.lit(None).cast("string"))
               .withColumn("surface_examples", F.lit(None).cast("array<string>"))
               .withColumn("created_at", F.localtimestamp()))
    return terms.unionByName(created.select(*terms.columns))


def append_terms(terms: DataFrame, new: DataFrame) -> DataFrame:
    """Insert terms with defaults; an existing id or normalized text raises."""
    from wordtide.operators import tables

    new = tables.with_term_defaults(new)
    tables.assert_unique_against(terms, new, ["normalized"], "terms(normalized)")
    return tables.append(terms, new, ["term_id"], "terms(term_id)")


def update_blocked(terms: DataFrame, updates: DataFrame) -> DataFrame:
    """``updates(term_id, is_blocked[, blocked_reason])``; a missing reason
    overwrites with NULL.  Unknown ids are ignored; last row per id wins only if
    ``updates`` is already deduplicated (see ``tables.dedupe_updates``)."""
    if "blocked_reason" not in updates.columns:
        updates = updates.withColumn("blocked_reason", F.lit(None).cast("string"))
    u = updates.select("term_id", F.col("is_blocked").alias("_b"),
                       F.col("blocked_reason").alias("_r"), F.lit(True).alias("_m"))
    return (terms.join(u, "term_id", "left")
            .withColumn("is_blocked", F.when(F.col("_m"), F.col("_b")).otherwise(F.col("is_blocked")))
            .withColumn("blocked_reason", F.when(F.col("_m"), F.col("_r")).otherwise(F.col("blocked_reason")))
            .select(*terms.columns))


def block_by_text(terms: DataFrame, words: list[str], reason: Optional[str] = None) -> DataFrame:
    """D5 for a short word list: a projection, no join (the reason is overwritten,
    NULL when not given)."""
    hit = F.col("normalized").isin(words)
    return (terms.withColumn("blocked_reason", F.when(hit, F.lit(reason).cast("string"))
                             .otherwise(F.col("blocked_reason")))
            .withColumn("is_blocked", F.when(hit, F.lit(True)).otherwise(F.col("is_blocked"))))
