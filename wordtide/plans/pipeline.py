"""Composite plans over the driver tables: posts -> daily -> weekly.

Each function returns lazy DataFrames; the registered queries in
``plans.queries`` pick the columns they report.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.functions.dates import week_start
from wordtide.operators import daily, ledger, terms as T, weekly
from wordtide.session import stage
from wordtide.sources import adapters as A


def daily_for_posts(spark: SparkSession, posts: DataFrame, lexicon: Optional[DataFrame] = None,
                    blocked_words=tuple(A.BLOCKED_WORDS), segmenter=None) -> daily.DailyResult:
    """Daily job from an empty dictionary with the stop words blocked before counting.

    What is asked of the result is staged, so the posts are read once for it.
    """

    def targets(days: DataFrame) -> DataFrame:
        return ledger.runs_from_days(days).select(F.col("target_date").alias("date"), "board_key", "run_id", "started_at", "finished_at")

    return daily.run_daily(posts, T.empty_terms(spark), targets=targets, lexicon=lexicon, materialize=stage, segmenter=segmenter,
                           block_words=blocked_words, block_reason=A.BLOCK_REASON)


def lineitem_daily(spark: SparkSession, sf_dir: str) -> daily.DailyResult:
    return daily_for_posts(spark, A.posts_from_lineitem(spark, sf_dir, terms=True))


def runs_of(res: daily.DailyResult) -> DataFrame:
    """The adapter's ledger of the days that have posts."""
    return ledger.runs_from_days(res.days())


def weekly_rates(res: daily.DailyResult) -> DataFrame:
    """W2 + W3 + W5 over every week with a valid day, keyed by term text.

    The stats come first: days and metrics then follow from the same counts, in no pass over the posts of their own.
    """
    stats = res.stats.select("date", "board_key", "term_id", "normalized", "post_hits", "thread_hits")
    valid = ledger.valid_days(runs_of(res))
    agg = weekly.weekly_aggregation(stats, valid, term_cols=("term_id", "normalized"))
    totals = weekly.weekly_total_posts(res.metrics, valid)
    return weekly.with_rates(agg, totals)


def weeks_of(res: daily.DailyResult) -> DataFrame:
    """The (week, board) pairs that have posts."""
    return res.days().select(week_start(F.col("date")).alias("week_start_date"), "board_key").distinct()


def weekly_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship chain: weekly rates and z-scores for all weeks and boards."""
    return weekly.with_zscore(weekly_rates(lineitem_daily(spark, sf_dir)))


def weekly_with_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship chain plus the 8-week regression columns for every week."""
    return weekly.with_regression(weekly_trends(spark, sf_dir))


def conversation_daily(spark: SparkSession, sf_dir: str) -> daily.DailyResult:
    posts = A.posts_from_conversations(spark, sf_dir)
    return daily_for_posts(spark, posts)


def part_name_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A (surface, pos) lexicon derived from ``part`` names: the last word of a
    name is tagged as a noun, the first as an adjective."""
    from wordtide.operators.terms import NOUN_POS

    part = A.table(spark, sf_dir, "part")
    words = F.split(F.col("p_name"), " ")
    nouns = part.select(F.element_at(words, -1).alias("surface"), F.lit(NOUN_POS).alias("pos"))
    adjectives = part.select(F.element_at(words, 1).alias("surface"), F.lit("形容詞").alias("pos"))
    return nouns.unionByName(adjectives).distinct()


def lexicon_daily(spark: SparkSession, sf_dir: str) -> daily.DailyResult:
    """Daily job with the T2 noun filter from ``part_name_lexicon``."""
    posts = A.posts_from_lineitem(spark, sf_dir)
    return daily_for_posts(spark, posts, lexicon=part_name_lexicon(spark, sf_dir))
