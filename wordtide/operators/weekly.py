"""Weekly analytics (W1-W22) for any number of weeks and boards in one plan.

Windows are ``partitionBy(board_key, term_id)`` over weekly rows: a partition holds
one row per week of one term, so its size is bounded by the number of weeks no
matter how hot the term is.  History frames are date ranges
(``rangeBetween`` on the Monday's day number), so a missing week is a gap and not
a shifted neighbour.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordtide.functions import stats as S
from wordtide.functions.beta import binomial_bounds
from wordtide.functions.dates import HISTORY_DAYS, analysis_window, week_start
from wordtide.operators import ledger, tables

WEEK = ["week_start_date", "board_key"]
SERIES = ["board_key", "term_id"]
# Reference Monday for week numbers used as regression x (keeps x small).
EPOCH_MONDAY = "2000-01-03"


def weekly_aggregation(daily_stats: DataFrame, valid: Optional[DataFrame] = None,
                       term_cols: tuple = ("term_id",)) -> DataFrame:
    """Sum post_hits and thread_hits per (week, board, term) over valid days.

    ``valid`` is (date, board_key); the semi join is broadcast automatically when
    the calendar is small (Spark checks its size), else shuffled.
    """
    d = daily_stats
    if valid is not None:
        d = d.join(valid, ["date", "board_key"], "left_semi")
    return (d.withColumn("week_start_date", week_start(F.col("date")))
            .groupBy(*WEEK, *term_cols)
            .agg(F.try_sum("post_hits").cast("long").alias("post_hits"),  # NULL beyond 64 bits, see ``errors_of``
                 F.try_sum("thread_hits").cast("long").alias("thread_hits")))


def weekly_total_posts(metrics: DataFrame, valid: Optional[DataFrame] = None) -> DataFrame:
    """W3 (valid days only) / W4 (all days, ``valid=None``): sum of fetched_posts."""
    m = metrics
    if valid is not None:
        m = m.join(valid, ["date", "board_key"], "left_semi")
    return (m.withColumn("week_start_date", week_start(F.col("date")))
            .groupBy(*WEEK).agg(F.coalesce(F.sum("fetched_posts"), F.lit(0)).cast("long").alias("total_posts")))


def appearance_rate(post_hits: Column, total_posts: Column) -> Column:
    """post_hits / total_posts, 0.0 when total is 0; NULL where the hits could not be summed."""
    return F.when(post_hits.isNotNull(), F.coalesce(F.try_divide(post_hits.cast("double"), total_posts.cast("double")), F.lit(0.0)))


def with_rates(agg: DataFrame, totals: DataFrame) -> DataFrame:
    """Attach total_posts (0 when none) and the appearance rate."""
    return (agg.join(totals, WEEK, "left")
            .withColumn("total_posts", F.coalesce("total_posts", F.lit(0)))
            .withColumn("appearance_rate", appearance_rate(F.col("post_hits"), F.col("total_posts"))))


def with_binomial_ci(df: DataFrame, k: str = "post_hits", n: str = "total_posts",
                     alpha: float = S.DEFAULT_ALPHA, materialize=None, native: bool = False) -> DataFrame:
    """Exact Clopper-Pearson interval, computed once per distinct (k, n) pair and joined back (a hot pair is
    split by AQE's skew join). The Arrow kernel solves all pairs of a batch together; ``native`` uses column
    expressions only (``functions.beta``), several times slower, for sessions without Python workers.
    ``materialize(df, name)`` keeps the pairs' intervals, so later uses do not solve them again."""
    # pairs are small and dear: a fixed number of tasks, where AQE would solve them in one (it would also after a
    # repartition by the pair: the distinct has made that one already, so Spark drops it)
    spark, pairs = df.sparkSession, df.select(F.col(k).alias("_k"), F.col(n).alias("_n")).distinct()
    tasks = spark.sparkContext.defaultParallelism  # a task of the kernel costs a Python worker its start
    if native:
        tasks = max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions")))
        ci = binomial_bounds(pairs.repartition(tasks), "_k", "_n", alpha)
    else:
        ci = pairs.repartition(tasks).withColumn("_ci", S.binomial_ci_udf(alpha)(F.col("_k"), F.col("_n"))).select("_k", "_n", "_ci.lower", "_ci.upper")
    ci = ci.select("_k", "_n", F.col("lower").alias("appearance_rate_ci_lower"), F.col("upper").alias("appearance_rate_ci_upper"))
    if materialize is not None:
        ci = materialize(ci, "binomial-intervals")
    return (df.join(ci, (df[k] == ci["_k"]) & (df[n] == ci["_n"]), "left").drop("_k", "_n"))


def _day_number(c: str = "week_start_date") -> Column:
    return F.unix_date(F.col(c))


def with_zscore(trends: DataFrame, rate: str = "appearance_rate", series=SERIES) -> DataFrame:
    """Z of each week's rate against the weeks in [week - 49 d, week - 1 d]."""
    w = Window.partitionBy(*series).orderBy(_day_number()).rangeBetween(-HISTORY_DAYS, -1)
    r = F.col(rate)
    return trends.withColumn("zscore", S.zscore(r, F.count(r).over(w), F.avg(r).over(w),
                                                F.stddev_samp(r).over(w)))


def with_regression(trends: DataFrame, rate: str = "appearance_rate", series=SERIES, points: int = S.REGRESSION_POINTS) -> DataFrame:
    """OLS of the rate on x = 0..points-1 for every week that ends a stretch of ``points`` weekly rows without a
    gap; NULL columns elsewhere. Any number of points from 3 on; 8 are what is stored."""
    days = 7 * (points - 1)
    w = Window.partitionBy(*series).orderBy(_day_number()).rangeBetween(-days, 0)
    x = ((_day_number() - F.unix_date(F.lit(EPOCH_MONDAY).cast("date"))) / 7).cast("double")
    y = F.col(rate)
    agg = {
        "_n": F.regr_count(y, x).over(w), "_slope": F.regr_slope(y, x).over(w),
        "_ybar": F.regr_avgy(y, x).over(w), "_sxx": F.regr_sxx(y, x).over(w),
        "_sxy": F.regr_sxy(y, x).over(w), "_syy": F.regr_syy(y, x).over(w),
    }
    df = trends.withColumns(agg)
    exprs = S.regression_sql(points, "_slope", "_ybar", "_sxx", "_sxy", "_syy")
    ok = F.col("_n") == points
    start, end = analysis_window(F.col("week_start_date"), days)
    df = df.withColumn("t_x", F.when(ok, F.expr(exprs.pop("t_x"))))
    cols = {name: F.when(ok, F.expr(e)) for name, e in exprs.items()}
    cols["has_regression"] = ok
    cols["analysis_start_date"] = start
    cols["analysis_end_date"] = end
    return df.withColumns(cols).drop("t_x", *agg.keys())


def with_history(current: DataFrame, history: Optional[DataFrame], keys=("week_start_date",) + tuple(SERIES)) -> DataFrame:
    """Stored trend rows with the current batch replacing same-key rows, so the
    current week is the 8th point of its regression (trend upsert before read)."""
    if history is None:
        return current.withColumn("_current", F.lit(True))
    h = history.select(*current.columns).join(current.select(*keys), list(keys), "left_anti")
    return h.withColumn("_current", F.lit(False)).unionByName(current.withColumn("_current", F.lit(True)))


def trending(trends: DataFrame, limit: Optional[int] = 10, order_col: str = "zscore",
             tie_col: str = "term_id") -> DataFrame:
    """W15 for every (week, board): ``zscore`` desc nulls last, ``term_id`` asc; top ``limit``."""
    return tables.ranked(trends, WEEK, [F.desc_nulls_last(order_col), F.asc(tie_col)], limit)


def term_history(trends: DataFrame, term_id, board_key: str, start, end, ascending: bool = True) -> DataFrame:
    """One term's weeks in [start, end] for a board, ordered by week.
    ``term_id=None`` keeps every term of ``trends`` (pre-filtered by the caller)."""
    o = F.asc("week_start_date") if ascending else F.desc("week_start_date")
    cond = (F.col("board_key") == board_key) & F.col("week_start_date").between(
        F.lit(start).cast("date"), F.lit(end).cast("date"))
    if term_id is not None:
        cond = cond & (F.col("term_id") == F.lit(term_id))
    return trends.where(cond).orderBy(o)


def growth_ranking(regressions: DataFrame, limit: Optional[int] = 10, order_col: str = "slope",
                   tie_col: str = "term_id") -> DataFrame:
    """W17 for every board: slope desc, term_id asc; top ``limit``."""
    return tables.ranked(regressions, ["board_key"], [F.desc(order_col), F.asc(tie_col)], limit)


def regression_lookup(regressions: DataFrame, board_key: str, term_id=None) -> DataFrame:
    """W18 (``term_id=None``: every term of the pre-filtered input)."""
    cond = F.col("board_key") == board_key
    if term_id is not None:
        cond = cond & (F.col("term_id") == F.lit(term_id))
    return regressions.where(cond)


def errors_of(df: DataFrame, alpha: float = S.DEFAULT_ALPHA) -> Column:
    """Why the kernels have no result for a row, empty if they do. A kernel never raises: it gives NULL, and the reason is told here."""
    k, n = F.col("post_hits"), F.col("total_posts")
    reasons = {
        "sum: post_hits exceed 64 bits": k.isNull(),
        "interval: post_hits outside 0 to total_posts": (n > 0) & ((k < 0) | (k > n)),
        "interval: no convergence": (n > 0) & (k >= 0) & (k <= n) & (F.col("appearance_rate_ci_lower").isNull() | F.col("appearance_rate_ci_upper").isNull()),
    }
    return F.filter(F.array(*[F.when(c, r) for r, c in reasons.items()]), lambda x: x.isNotNull())


def regression_errors(reg: DataFrame) -> Column:
    """W20 for the regression of a week that has one: a coefficient or bound that is not a finite number."""
    odd = F.lit(False)
    for c in ("intercept", "slope", "intercept_ci_lower", "intercept_ci_upper", "slope_ci_lower", "slope_ci_upper"):
        odd = odd | F.col(c).isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.when(F.col("has_regression") & odd, "regression: not finite")


REGRESSION_COLS = ["intercept", "slope", "intercept_ci_lower", "intercept_ci_upper", "slope_ci_lower",
                   "slope_ci_upper", "p_value", "analysis_start_date", "analysis_end_date"]
TREND_COLS = ["post_hits", "total_posts", "appearance_rate", "appearance_rate_ci_lower",
              "appearance_rate_ci_upper", "zscore"]


def latest_regressions(with_reg: DataFrame) -> DataFrame:
    """W14 input: per (board, term) the regression of the latest week that has one
    (earlier weeks of a backfill would be overwritten by later upserts)."""
    r = with_reg.where("has_regression")
    return (r.groupBy(*SERIES)
            .agg(F.max_by(F.struct(*REGRESSION_COLS), F.col("week_start_date")).alias("_r"))
            .select(*SERIES, *[F.col("_r")[c].alias(c) for c in REGRESSION_COLS]))


class WeeklyResult:
    def __init__(self, trends, regressions, quarantine, summary, calendar):
        self.trends = trends            # upserted weekly_term_trends (affected week partitions)
        self.regressions = regressions  # upserted term_regression_results
        self.quarantine = quarantine    # rows failing the checks or a kernel, with the reasons in ``violations`` (W20)
        self.summary = summary          # W21 per (week, board)
        self.calendar = calendar        # L6 per (week, board, date)


def run_weekly(weeks: DataFrame, runs: DataFrame, daily_stats: DataFrame, metrics: DataFrame,
               trends: Optional[DataFrame] = None, regressions: Optional[DataFrame] = None,
               alpha: float = S.DEFAULT_ALPHA, started_at=None, materialize=None) -> WeeklyResult:
    """W1 -> L6 -> W2/W3 -> W5 -> W6 -> W7 -> W13 -> W8 -> W14 for every
    (week_start_date, board_key) in ``weeks`` at once.

    ``weeks`` holds the Mondays to analyse (``dates.previous_week`` of execution
    dates).  A week without a valid day gives no term rows and a summary with 7
    invalid dates.  Rows failing the table checks, and rows for which a kernel has no result (``errors_of``),
    are quarantined with their reasons (W20) and, as in a per-term try/except, neither stored nor used as history.  ``started_at`` (a
    timestamp) gives the summary's ``duration_sec``; without it the duration is 0.
    ``materialize(df, name)`` (e.g. ``session.stage``) is applied to the week's rows and to the series with z-scores
    and regressions, which the trends, regressions, summary and affected partitions all read.
    """
    from wordtide import schemas

    keep = materialize or (lambda df, name: df)
    calendar = ledger.validate_collection(weeks, runs)
    valid = calendar.where("is_valid").select("date", "board_key")
    # The analysed weeks as scalar bounds prune the partitions of date-partitioned daily tables.
    first, last = weeks.select(F.min("week_start_date")).scalar(), F.date_add(weeks.select(F.max("week_start_date")).scalar(), 6)
    daily_stats, metrics = (df.where(F.col("date").between(first, last)) for df in (daily_stats, metrics))
    agg = weekly_aggregation(daily_stats, valid)
    totals = weekly_total_posts(metrics, valid)
    rates = keep(with_rates(agg, totals), "weekly-rates")
    cur = with_binomial_ci(rates, alpha=alpha, materialize=materialize)
    cur = cur.select(*WEEK, "term_id", *[c for c in TREND_COLS if c != "zscore"])
    good, bad = tables.split_valid(cur, "weekly_term_trends", errors_of(cur, alpha))
    hist = None
    if trends is not None:
        # Only the 7 weeks before the earliest analysed week are history; the range
        # filter prunes the partitions of a week-partitioned trends table.
        lo = F.date_sub(weeks.select(F.min("week_start_date")).scalar(), HISTORY_DAYS)
        hi = weeks.select(F.max("week_start_date")).scalar()
        hist = (trends.where(F.col("week_start_date").between(lo, hi))
                .select(*WEEK, "term_id", *TREND_COLS))
    series = with_history(good.withColumn("zscore", F.lit(None).cast("double")), hist)
    zs = with_zscore(series.withColumnRenamed("zscore", "_stored_z"))
    zs = (zs.withColumn("zscore", F.when(F.col("_current"), F.col("zscore")).otherwise(F.col("_stored_z")))
          .drop("_stored_z"))
    reg = with_regression(zs).where("_current")
    failed = regression_errors(reg)
    reg = keep(reg.withColumn("regression_error", failed).withColumn("has_regression", F.col("has_regression") & failed.isNull()), "weekly-series")
    no_line = reg.where("regression_error IS NOT NULL").select(*[c for c in bad.columns if c != "violations"], F.array("regression_error").alias("violations"))
    trend_rows = reg.select(*WEEK, "term_id", *TREND_COLS).withColumn("created_at", F.localtimestamp())
    t_schema, r_schema = schemas.WEEKLY_TERM_TRENDS, schemas.TERM_REGRESSION_RESULTS
    upd_trends = tables.align(trend_rows, t_schema)
    spark = weeks.sparkSession
    base_trends = tables.align(trends if trends is not None else spark.createDataFrame([], t_schema), t_schema)
    # Upsert only the week partitions being written (dynamic partition overwrite).
    base_trends = tables.affected_partitions(base_trends, upd_trends, ["week_start_date"])
    new_trends = tables.upsert(base_trends, upd_trends, ["week_start_date", "board_key", "term_id"], TREND_COLS)
    reg_rows = (latest_regressions(reg).withColumn("created_at", F.localtimestamp())
                .withColumn("updated_at", F.localtimestamp()))
    base_reg = tables.align(regressions if regressions is not None else spark.createDataFrame([], r_schema),
                            r_schema)
    new_reg = tables.upsert(base_reg, tables.align(reg_rows, r_schema), SERIES, REGRESSION_COLS)
    summary = weekly_summary(calendar, good, bad, started_at)
    return WeeklyResult(new_trends, new_reg, bad.unionByName(no_line), summary, calendar)


def weekly_summary(calendar: DataFrame, good: DataFrame, bad: DataFrame, started_at=None) -> DataFrame:
    """W21 per (week, board): processed_terms, error_terms, invalid_dates, duration_sec."""
    from wordtide.operators.daily import duration_sec

    start = F.lit(started_at).cast("timestamp_ntz") if started_at is not None else F.lit(None).cast("timestamp_ntz")
    inv = ledger.invalid_dates(calendar)
    g = good.groupBy(*WEEK).agg(F.count(F.lit(1)).alias("processed_terms"))
    b = bad.groupBy(*WEEK).agg(F.count(F.lit(1)).alias("error_terms"))
    return (inv.join(g, WEEK, "left").join(b, WEEK, "left")
            .select(*WEEK, F.coalesce("processed_terms", F.lit(0)).alias("processed_terms"),
                    F.coalesce("error_terms", F.lit(0)).alias("error_terms"),
                    "valid_days", "invalid_dates",
                    duration_sec(start, F.localtimestamp()).alias("duration_sec")))
