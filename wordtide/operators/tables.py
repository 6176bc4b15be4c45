"""Cross-cutting table operators: keyed upsert (U1), integrity (I1-I5), joins.

Tables are DataFrames; an upsert is a pure ``(existing, updates) -> DataFrame``
function.  Write its result to a new path (or overwrite only the affected
partitions with dynamic partition overwrite), never onto the path the plan reads.
"""

from __future__ import annotations

from typing import Iterable, Optional, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordtide import schemas
from wordtide.session import stage

# ------------------------------------------------------------------------ U1


def dedupe_updates(updates: DataFrame, keys: Sequence[str], seq_col: str) -> DataFrame:
    """Last update wins inside a batch: one row per key, the one with max ``seq_col``.

    ``max_by`` is an ordinary aggregate, so a hot key is reduced map-side.
    """
    rest = [c for c in updates.columns if c not in keys]
    picked = updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq_col)).alias("_r"))
    return picked.select(*keys, *[F.col("_r")[c].alias(c) for c in rest])


def upsert(existing: DataFrame, updates: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
           seq_col: Optional[str] = None, touch_cols: Iterable[str] = ("updated_at",),
           keep_cols: Iterable[str] = ("created_at",)) -> DataFrame:
    """Update ``update_cols`` where the key matches, insert otherwise.

    * other columns of matched rows (e.g. ``created_at``) are kept;
    * ``touch_cols`` of matched or inserted rows are set to now;
    * a NULL update value overwrites (no ``coalesce``);
    * existing keys missing from ``updates`` stay untouched (no delete).
    """
    if seq_col:
        updates = dedupe_updates(updates, keys, seq_col)
        if seq_col not in existing.columns:
            updates = updates.drop(seq_col)
    touch_cols, keep_cols = set(touch_cols), set(keep_cols)
    ucols = [c for c in updates.columns if c not in keys]
    u = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in ucols], F.lit(True).alias("_um"))
    e = existing.withColumn("_em", F.lit(True))
    j = e.join(u, list(keys), "full_outer")
    out = []
    for c in existing.columns:
        if c in keys:
            out.append(F.col(c))
            continue
        dtype = existing.schema[c].dataType
        new_val = F.col(f"_u_{c}") if c in ucols else F.lit(None).cast(dtype)
        if c in touch_cols:
            val = F.when(F.col("_um"), F.localtimestamp()).otherwise(F.col(c))
        elif c in update_cols:
            val = F.when(F.col("_um"), new_val).otherwise(F.col(c))
        elif c in keep_cols:
            fresh = F.coalesce(new_val, F.localtimestamp()) if isinstance(dtype, (T.TimestampNTZType,
                                                                                  T.TimestampType)) else new_val
            val = F.when(F.col("_em"), F.col(c)).otherwise(fresh)
        else:
            val = F.when(F.col("_em"), F.col(c)).otherwise(new_val)
        out.append(val.cast(dtype).alias(c))
    return j.select(*out)


def affected_partitions(existing: DataFrame, updates: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Rows of ``existing`` in partitions touched by ``updates``, to upsert and overwrite with
    ``partitionOverwriteMode=dynamic``.

    The scan is bounded by the smallest and largest value of each partition column as scalar subqueries, which
    reach its partition filters however the join is planned; the semi join then takes the exact partitions.
    """
    touched = updates.select(*partition_cols).distinct()
    for c in partition_cols:
        existing = existing.where(F.col(c).between(touched.select(F.min(c)).scalar(), touched.select(F.max(c)).scalar()))
    return existing.join(touched, list(partition_cols), "left_semi")


# ------------------------------------------------------------------------ I1

# --- fixed values (constraint names and predicates of the stored tables) -------
CHECKS = {
    "pipeline_runs": [("check_pipeline_runs_status", "status IN ('success', 'failed', 'partial')")],
    "daily_term_stats": [("check_daily_term_stats_post_hits", "post_hits >= 0"),
                         ("check_daily_term_stats_thread_hits", "thread_hits >= 0")],
    "weekly_term_trends": [
        ("check_weekly_term_trends_post_hits", "post_hits >= 0"),
        ("check_weekly_term_trends_total_posts", "total_posts >= 0"),
        ("check_weekly_term_trends_appearance_rate", "appearance_rate >= 0 AND appearance_rate <= 1"),
        ("check_weekly_term_trends_ci_lower", "appearance_rate_ci_lower >= 0 AND appearance_rate_ci_lower <= 1"),
        ("check_weekly_term_trends_ci_upper", "appearance_rate_ci_upper >= 0 AND appearance_rate_ci_upper <= 1"),
    ],
    "term_regression_results": [("check_term_regression_results_p_value", "p_value >= 0 AND p_value <= 1")],
    "pipeline_metrics_daily": [
        (f"check_pipeline_metrics_daily_{c}", f"{c} >= 0")
        for c in ["fetched_threads", "fetched_posts", "parsed_posts", "parse_fail_posts",
                  "tokenize_fail_posts", "filtered_tokens", "total_tokens"]
    ] + [("check_pipeline_metrics_daily_filtered_rate", "filtered_rate >= 0 AND filtered_rate <= 1"),
         ("check_pipeline_metrics_daily_duration_sec", "duration_sec >= 0")],
}
# -------------------------------------------------------------------------------


def violations(df: DataFrame, table: str) -> Column:
    """Array of violated check names; SQL semantics, so NULL passes
    (and NaN, which compares greater than any number in Spark, fails)."""
    items = [F.when(~F.coalesce(F.expr(pred), F.lit(True)), F.lit(name)) for name, pred in CHECKS[table]]
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def split_valid(df: DataFrame, table: str, errors: Optional[Column] = None) -> tuple[DataFrame, DataFrame]:
    """W20-style quarantine: (good rows, bad rows with a ``violations`` column).

    ``errors`` is an array of further reasons, why a row's values could not be computed.
    """
    found = violations(df, table)
    v = df.withColumn("violations", found if errors is None else F.concat(errors, found))
    return v.where(F.size("violations") == 0).drop("violations"), v.where(F.size("violations") > 0)


# ------------------------------------------------------------------------ I2 / I3


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def conflicting_keys(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """I2 against stored rows: keys of ``new`` already present."""
    return new.select(*keys).join(existing.select(*keys), list(keys), "left_semi")


def assert_unique_against(existing: DataFrame, new: DataFrame, keys: Sequence[str], name: str) -> None:
    """Raise like a unique index would (an action; meant for append paths)."""
    if not duplicate_keys(new, keys).isEmpty() or not conflicting_keys(existing, new, keys).isEmpty():
        raise ValueError(f"unique constraint violated: {name}")


def append(existing: DataFrame, new: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Insert rows, rejecting keys already stored or repeated."""
    assert_unique_against(existing, new, keys, name)
    return existing.unionByName(new.select(*existing.columns))


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: Optional[str] = None) -> DataFrame:
    """Child rows whose non-NULL ``key`` has no parent row."""
    pk = parent_key or key
    p = parent.select(F.col(pk).alias(key)).distinct()
    return child.where(F.col(key).isNotNull()).join(p, key, "left_anti")


# ------------------------------------------------------------------------ I4 / I5


def with_run_defaults(runs: DataFrame) -> DataFrame:
    """I4 for pipeline_runs: new run_id, timestamps now, is_recovered false."""
    cols = {f.name: f.dataType for f in schemas.PIPELINE_RUNS.fields}
    df = align(runs, schemas.PIPELINE_RUNS)
    return (df.withColumn("run_id", F.coalesce("run_id", F.expr("uuid()")))
            .withColumn("started_at", F.coalesce("started_at", F.localtimestamp()))
            .withColumn("created_at", F.coalesce("created_at", F.localtimestamp()))
            .withColumn("is_recovered", F.coalesce("is_recovered", F.lit(False)))
            .select(*[F.col(c).cast(t) for c, t in cols.items()]))


def with_term_defaults(terms: DataFrame) -> DataFrame:
    """I4 for terms: booleans false, created_at now."""
    df = align(terms, schemas.TERMS)
    return (df.withColumn("needs_review", F.coalesce("needs_review", F.lit(False)))
            .withColumn("is_blocked", F.coalesce("is_blocked", F.lit(False)))
            .withColumn("created_at", F.coalesce("created_at", F.localtimestamp())))


def align(df: DataFrame, schema) -> DataFrame:
    """Add missing declared columns as NULL and order/cast them as declared."""
    out = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)


def read_runs_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old ledger rows without ``is_recovered`` read as false."""
    return (old.unionByName(new, allowMissingColumns=True)
            .withColumn("is_recovered", F.coalesce("is_recovered", F.lit(False))))


# ------------------------------------------------------------------------ J1 - J4


def with_term_text(df: DataFrame, terms: DataFrame) -> DataFrame:
    """Attach the term text (and block flag) to any term_id keyed table."""
    return df.join(terms.select("term_id", "normalized", "is_blocked"), "term_id")


def runs_with_metrics(metrics: DataFrame, runs: DataFrame) -> DataFrame:
    """Metrics -> optional run (left join on run_id)."""
    r = runs.select("run_id", "status", "is_recovered", "started_at", "finished_at")
    return metrics.join(r, "run_id", "left")


# ------------------------------------------------------------------------ ranking


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column], limit: Optional[int] = None) -> DataFrame:
    """Add ``rank`` (1, 2, ..., by ``order`` within ``group``); with ``limit`` only the rows up to it.

    With a limit Spark cuts every group before its shuffle. Without one, a window would sort a whole group in one
    task; instead the rows are range-partitioned and sorted by (group, order), staged, and numbered by their place
    in the partition plus the group's rows in earlier partitions, so one group may span many tasks.
    """
    if limit:
        w = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)
    by = [F.asc(c) for c in group] + list(order)
    placed = stage(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_place", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    pieces = placed.groupBy(*group, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    names = [*group, "_part"]  # groups may be null
    pieces = pieces.withColumnsRenamed({n: f"_right_{n}" for n in names})
    same = [F.col(n).eqNullSafe(F.col(f"_right_{n}")) for n in names]
    out = placed.join(pieces, same)
    return out.withColumn("rank", (F.col("_place") - F.col("_first") + F.col("_before") + 1).cast("int")).select(*df.columns, "rank")
