"""End-to-end daily and weekly jobs over a table folder (the reference's two DAG tasks).

Tables live as Parquet under one shared ``warehouse`` folder:

  terms/                      dictionary            } kept as numbered folders, each written once:
  pipeline_runs/              ledger                } ``<n>.base`` holds a whole table, ``<n>.delta`` rows
  term_regression_results/    latest regressions    } added since
  weekly_errors/              rows not stored, why  }
  daily_term_stats/           partitioned by date
  pipeline_metrics_daily/     partitioned by date
  weekly_term_trends/         partitioned by week_start_date
  day_state/                  counts of late batches, partitioned by batch_id and date

A numbered folder counts once its ``_SUCCESS`` file is there, and a base is deleted only after the next one counts.
A job that stops at any point therefore leaves the last complete state: term ids are never lost or given
twice. New terms and runs are written as deltas, so a daily run does not rewrite the dictionary.

Partitioned tables are upserted (U1) by affected partitions. Intermediate tables are staged in the cluster's shared
folder (``spark.checkpoint.dir``) and deleted when the job's results are stored, so the table being
overwritten is never read by the writing plan.
"""

from __future__ import annotations

import datetime
from typing import Callable, Iterable, Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide import schemas
from wordtide.functions.dates import previous_week
from wordtide.operators import daily, ledger, tables, weekly
from wordtide.session import Stages, drop_path, list_names, path_exists

PARTITIONS = {
    "daily_term_stats": ["date"],
    "pipeline_metrics_daily": ["date"],
    "weekly_term_trends": ["week_start_date"],
}
SCHEMAS = {
    "terms": schemas.TERMS,
    "pipeline_runs": schemas.PIPELINE_RUNS,
    "daily_term_stats": schemas.DAILY_TERM_STATS,
    "pipeline_metrics_daily": schemas.PIPELINE_METRICS_DAILY,
    "weekly_term_trends": schemas.WEEKLY_TERM_TRENDS,
    "term_regression_results": schemas.TERM_REGRESSION_RESULTS,
    "weekly_errors": schemas.WEEKLY_ERRORS,
}


def _path(warehouse: str, name: str) -> str:
    return f"{warehouse.rstrip('/')}/{name}"


def _folders(spark: SparkSession, path: str) -> list[str]:
    """The complete numbered folders that make up the table now: the last base and the deltas after it."""
    found = [n for n in list_names(spark, path) if n.endswith((".base", ".delta")) and path_exists(spark, f"{path}/{n}/_SUCCESS")]
    last = max((i for i, n in enumerate(found) if n.endswith(".base")), default=0)
    return found[last:]


def read_table(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """A stored table aligned to its declared schema (I5); empty only where nothing was stored yet."""
    path = _path(warehouse, name)
    if name in PARTITIONS:
        paths = [path] if path_exists(spark, path) else []
    else:
        paths = [f"{path}/{n}" for n in _folders(spark, path)]
    if not paths:
        return spark.createDataFrame([], SCHEMAS[name])
    out = tables.align(spark.read.option("mergeSchema", "true").parquet(*paths), SCHEMAS[name])
    if name == "pipeline_runs":
        out = out.withColumn("is_recovered", F.coalesce("is_recovered", F.lit(False)))
    return out


def write_partitions(df: DataFrame, warehouse: str, name: str) -> None:
    """Overwrite the partitions present in ``df``. Rows are rebalanced by partition first, which AQE sizes: a small
    partition is one file, a large one several."""
    parts = PARTITIONS[name]
    (df.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(_path(warehouse, name)))


def write_folder(df: DataFrame, warehouse: str, name: str, kind: str) -> None:
    """Add a ``base`` (the whole table) or ``delta`` (new rows) folder; a new base replaces what was before it."""
    spark, path = df.sparkSession, _path(warehouse, name)
    names = list_names(spark, path)
    number = 1 + max((int(n.split(".")[0]) for n in names), default=0)
    df.write.parquet(f"{path}/{number:08d}.{kind}")
    if kind == "base":
        for n in names:
            drop_path(spark, f"{path}/{n}")


def upsert_table(spark: SparkSession, warehouse: str, name: str, updates: DataFrame,
                 keys: list[str], update_cols: list[str], keep: Stages) -> None:
    """U1 against a stored partitioned table, restricted to the partitions ``updates`` touches."""
    updates = keep(tables.align(updates, SCHEMAS[name]), f"{name}-updates")
    existing = tables.affected_partitions(read_table(spark, warehouse, name), updates, PARTITIONS[name])
    write_partitions(keep(tables.upsert(existing, updates, keys, update_cols), f"{name}-merged"), warehouse, name)


def record_runs(spark: SparkSession, warehouse: str, runs: DataFrame) -> None:
    """L1: append new runs with defaults; a repeated (date, board) or run id raises."""
    keep = Stages(spark)
    new = keep(tables.with_run_defaults(runs), "new-runs")
    ledger.append_runs(read_table(spark, warehouse, "pipeline_runs"), new)  # checks the keys
    write_folder(new, warehouse, "pipeline_runs", "delta")
    keep.drop()


def store_terms(spark: SparkSession, warehouse: str, stored: DataFrame, terms: DataFrame) -> None:
    """Add the terms that ``stored`` lacks; a new base is written only when a stored row was edited."""
    terms = tables.align(terms, schemas.TERMS)
    edited = terms.join(stored.select("term_id"), "term_id", "left_semi").exceptAll(stored)
    if not edited.isEmpty():
        write_folder(terms, warehouse, "terms", "base")
        return
    new = terms.join(stored.select("term_id"), "term_id", "left_anti")
    if not new.isEmpty():
        write_folder(tables.align(new, schemas.TERMS), warehouse, "terms", "delta")


def daily_job(spark: SparkSession, posts: DataFrame, warehouse: str,
              lexicon: Optional[DataFrame] = None,
              tokenizer: Optional[Callable[[Column], Column]] = None,
              prepare_terms: Optional[Callable[[DataFrame], DataFrame]] = None,
              target_dates: Optional[Iterable[str]] = None) -> None:
    """A12 end to end for every (date, board) in ``posts``, plus every recorded run
    of ``target_dates`` (a run without posts gets a metrics row of zeros).

    The posts are read once: their counts at (date, board, term) grain are staged, and the dictionary, stats
    and metrics come from these.
    """
    keep = Stages(spark)
    stored = read_table(spark, warehouse, "terms")
    res = daily.run_daily(posts, stored, _targets(spark, warehouse, target_dates), lexicon, tokenizer, prepare_terms, materialize=keep)
    _store_daily(spark, warehouse, stored, res, keep)


def late_posts_job(spark: SparkSession, posts: DataFrame, warehouse: str, batch_id: int, lexicon: Optional[DataFrame] = None,
                   tokenizer: Optional[Callable[[Column], Column]] = None,
                   prepare_terms: Optional[Callable[[DataFrame], DataFrame]] = None,
                   target_dates: Optional[Iterable[str]] = None) -> None:
    """A7/A12 for posts that arrive in batches, each post in one: only the new posts are read.

    ``day_state`` keeps the (date, board, thread, term) counts of every batch; they add up, so a day that gets late posts is
    made again from its counts. A batch that is run again replaces its own counts.
    """
    keep = Stages(spark)
    parts = keep(daily.thread_counts(*daily.tokens_of(posts, lexicon, tokenizer, keep=keep)), "batch-counts")
    days = keep(parts.select(*daily.DAY).distinct(), "batch-days")
    path = _path(warehouse, "day_state")
    (parts.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id", "date").parquet(path))
    state = spark.read.schema(schemas.DAY_STATE).parquet(path)
    state = tables.affected_partitions(state, days, ["date"]).join(days, daily.DAY, "left_semi")
    stored = read_table(spark, warehouse, "terms")
    res = daily.run_merged(state, stored, _targets(spark, warehouse, target_dates), prepare_terms, materialize=keep)
    _store_daily(spark, warehouse, stored, res, keep)


def _targets(spark: SparkSession, warehouse: str, target_dates: Optional[Iterable[str]]) -> Callable[[DataFrame], DataFrame]:
    """The (date, board) pairs that get metrics: those with posts, and the recorded runs of ``target_dates``."""
    runs = read_table(spark, warehouse, "pipeline_runs")

    def targets(days: DataFrame) -> DataFrame:
        if target_dates:
            wanted = F.array(*[F.lit(d).cast("date") for d in target_dates])
            days = days.unionByName(runs.where(F.array_contains(wanted, F.col("target_date")))
                                    .select(F.col("target_date").alias("date"), "board_key")).distinct()
        return days.join(runs.select(F.col("target_date").alias("date"), "board_key", "run_id",
                                     "started_at", "finished_at"), ["date", "board_key"], "left")

    return targets


def _store_daily(spark: SparkSession, warehouse: str, stored: DataFrame, res: daily.DailyResult, keep: Stages) -> None:
    res.counts  # read the posts once: stats and metrics both come from the counts
    store_terms(spark, warehouse, stored, res.terms)
    upsert_table(spark, warehouse, "daily_term_stats", res.stats.drop("normalized"),
                 ["date", "board_key", "term_id"], ["post_hits", "thread_hits"], keep)
    upsert_table(spark, warehouse, "pipeline_metrics_daily", res.metrics, ["date", "board_key"],
                 ["run_id", "fetched_threads", "fetched_posts", "parsed_posts", "parse_fail_posts",
                  "tokenize_fail_posts", "filtered_tokens", "total_tokens", "filtered_rate", "duration_sec"], keep)
    keep.drop()


def weeks_for(execution_dates: Iterable[str], boards: DataFrame) -> DataFrame:
    """W1 for each execution date (a short parameter list), for every board."""
    dates = F.array(*[F.lit(d).cast("date") for d in execution_dates])
    ex = boards.select("board_key").distinct().select("board_key", F.explode(dates).alias("_ex"))
    start, _ = previous_week(F.col("_ex"))
    return ex.select(start.alias("week_start_date"), "board_key").distinct()


def weekly_job(spark: SparkSession, warehouse: str, weeks: DataFrame) -> list:
    """W22 end to end for the (week_start_date, board_key) rows of ``weeks``; returns the W21 summary rows, one
    per week and board."""
    keep = Stages(spark)
    runs = read_table(spark, warehouse, "pipeline_runs")
    stats = read_table(spark, warehouse, "daily_term_stats")
    metrics = read_table(spark, warehouse, "pipeline_metrics_daily")
    trends = read_table(spark, warehouse, "weekly_term_trends")
    regs = read_table(spark, warehouse, "term_regression_results")
    out = weekly.run_weekly(weeks, runs, stats, metrics, trends, regs, started_at=datetime.datetime.now(), materialize=keep)
    new_trends = keep(out.trends, "trends")
    new_regs = keep(out.regressions, "regressions")
    errors = keep(out.quarantine.select("week_start_date", "board_key", "term_id", F.col("violations").alias("reasons"),
                                        F.localtimestamp().alias("created_at")), "errors")
    summary = out.summary.collect()
    if not errors.isEmpty():
        write_folder(tables.align(errors, schemas.WEEKLY_ERRORS), warehouse, "weekly_errors", "delta")
    write_partitions(new_trends, warehouse, "weekly_term_trends")
    write_folder(new_regs, warehouse, "term_regression_results", "base")
    keep.drop()
    return summary
