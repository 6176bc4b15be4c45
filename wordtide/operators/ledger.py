"""Run ledger and collection completeness."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtide.operators import tables

# --- fixed values ------------------------------------------------------------
SUCCESS = "success"
# -----------------------------------------------------------------------------


def append_runs(runs: DataFrame, new: DataFrame) -> DataFrame:
    """L1: append with defaults; raises when a (target_date, board_key) or run_id repeats."""
    new = tables.with_run_defaults(new)
    tables.assert_unique_against(runs, new, ["target_date", "board_key"], "pipeline_runs(target_date, board_key)")
    tables.assert_unique_against(runs, new, ["run_id"], "pipeline_runs(run_id)")
    return runs.unionByName(new.select(*runs.columns))


def run_by_id(runs: DataFrame, run_id: str) -> DataFrame:
    """L2."""
    return runs.where(F.col("run_id") == run_id)


def run_by_date_and_board(runs: DataFrame, target_date, board_key: str) -> DataFrame:
    """L3."""
    return runs.where((F.col("target_date") == F.lit(target_date).cast("date")) & (F.col("board_key") == board_key))


def runs_in_range(runs: DataFrame, start, end, board_key: str) -> DataFrame:
    """L4: inclusive range for one board (prunes a partitioned ledger)."""
    return runs.where(F.col("target_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
                      & (F.col("board_key") == board_key))


def update_status(runs: DataFrame, updates: DataFrame) -> DataFrame:
    """``updates(run_id, status[, finished_at])``; finished_at changes only when
    given (non-NULL); unknown run ids are no-ops."""
    if "finished_at" not in updates.columns:
        updates = updates.withColumn("finished_at", F.lit(None).cast("timestamp_ntz"))
    u = updates.select("run_id", F.col("status").alias("_s"), F.col("finished_at").alias("_f"),
                       F.lit(True).alias("_m"))
    return (runs.join(u, "run_id", "left")
            .withColumn("status", F.when(F.col("_m"), F.col("_s")).otherwise(F.col("status")))
            .withColumn("finished_at", F.coalesce(F.col("_f"), F.col("finished_at")))
            .select(*runs.columns))


def is_valid_run(status, is_recovered):
    return (status == SUCCESS) | F.coalesce(is_recovered, F.lit(False))


def valid_days(runs: DataFrame) -> DataFrame:
    """(date, board_key) whose collection counts: status success or recovered."""
    return (runs.where(is_valid_run(F.col("status"), F.col("is_recovered")))
            .select(F.col("target_date").alias("date"), "board_key").distinct())


def week_calendar(weeks: DataFrame) -> DataFrame:
    """The 7 days of every (week_start_date, board_key)."""
    return weeks.select("week_start_date", "board_key",
                        F.explode(F.sequence(F.col("week_start_date"), F.date_add("week_start_date", 6))).alias("date"))


def validate_collection(weeks: DataFrame, runs: DataFrame) -> DataFrame:
    """Per (week_start_date, board_key, date) of the 7-day calendar, ``is_valid``
    when a run exists and succeeded or was recovered."""
    r = runs.select(F.col("target_date").alias("date"), "board_key",
                    is_valid_run(F.col("status"), F.col("is_recovered")).alias("_ok"))
    return (week_calendar(weeks).join(r, ["date", "board_key"], "left")
            .groupBy("week_start_date", "board_key", "date")
            .agg(F.coalesce(F.bool_or("_ok"), F.lit(False)).alias("is_valid")))


def invalid_dates(calendar: DataFrame) -> DataFrame:
    """Per (week, board) the valid-day count and the invalid dates in order."""
    return calendar.groupBy("week_start_date", "board_key").agg(
        F.count_if("is_valid").alias("valid_days"),
        F.sort_array(F.collect_list(F.when(~F.col("is_valid"), F.col("date")))).alias("invalid_dates"),
    )


def runs_from_days(days: DataFrame, failed_mod: Optional[int] = 9, recovered_mod: Optional[int] = 18) -> DataFrame:
    """Deterministic ledger for the driver tables: one run per (date, board);
    ``failed`` when day-of-month % failed_mod = 0, recovered when % recovered_mod = 0."""
    dom = F.dayofmonth("date")
    failed = (dom % failed_mod == 0) if failed_mod else F.lit(False)
    recovered = (dom % recovered_mod == 0) if recovered_mod else F.lit(False)
    started = F.to_timestamp_ntz(F.date_format("date", "yyyy-MM-dd 17:00:00"))
    return days.select(
        F.concat_ws(":", "board_key", F.date_format("date", "yyyy-MM-dd")).alias("run_id"),
        F.col("date").alias("target_date"),
        "board_key",
        F.when(failed, F.lit("failed")).otherwise(F.lit(SUCCESS)).alias("status"),
        started.alias("started_at"),
        (started + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0),
                                   (F.dayofyear("date") % 50 + 10).cast("decimal(18,6)"))).alias("finished_at"),
        F.lit(None).cast("string").alias("config"),
        F.lit(None).cast("string").alias("code_version"),
        recovered.alias("is_recovered"),
        started.alias("created_at"),
    )
