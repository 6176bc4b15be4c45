"""U1, I1-I5, L1-L7 and S2."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wordtide import schemas
from wordtide.operators import ledger, tables
from wordtide.sources import html as H

KEYS = ["date", "board_key", "term_id"]


def stats_df(spark, rows):
    return spark.createDataFrame(rows, "date string, board_key string, term_id long, post_hits int, thread_hits int, "
                                       "created_at string").withColumn("date", F.col("date").cast("date"))


def test_upsert_replaces_and_inserts(spark):
    existing = stats_df(spark, [("2025-01-01", "b", 1, 10, 1, "t0"), ("2025-01-01", "b", 2, 5, 5, "t0")])
    updates = stats_df(spark, [("2025-01-01", "b", 1, 20, 2, "t1"), ("2025-01-02", "b", 1, 7, 7, "t1")])
    out = {(str(r.date), r.term_id): r for r in tables.upsert(existing, updates, KEYS, ["post_hits", "thread_hits"]).collect()}
    assert len(out) == 3
    assert (out[("2025-01-01", 1)].post_hits, out[("2025-01-01", 1)].thread_hits) == (20, 2)
    assert out[("2025-01-01", 1)].created_at == "t0"          # kept on update
    assert out[("2025-01-01", 2)].post_hits == 5               # untouched key stays
    assert out[("2025-01-02", 1)].created_at == "t1"          # inserted row keeps its own


def test_upsert_null_overwrites_and_last_wins(spark):
    ex = spark.createDataFrame([("w", 1, 0.5)], "k string, term_id long, zscore double")
    up = spark.createDataFrame([("w", 1, 2.0, 1), ("w", 1, None, 2)], "k string, term_id long, zscore double, seq int")
    out = tables.upsert(ex, up, ["k", "term_id"], ["zscore"], seq_col="seq").collect()
    assert len(out) == 1 and out[0].zscore is None


def test_check_constraints(spark):
    df = spark.createDataFrame([(-1, 0), (1, 1), (None, 2)], "post_hits int, thread_hits int")
    good, bad = tables.split_valid(df, "daily_term_stats")
    assert good.count() == 2
    assert bad.collect()[0].violations == ["check_daily_term_stats_post_hits"]
    tr = spark.createDataFrame([(1, 1, 1.5, None, None), (1, 2, float("nan"), 0.1, 0.2)],
                               "post_hits int, total_posts int, appearance_rate double, "
                               "appearance_rate_ci_lower double, appearance_rate_ci_upper double")
    assert tables.split_valid(tr, "weekly_term_trends")[1].count() == 2


def test_keys_and_orphans(spark):
    runs = spark.createDataFrame([("r1", "2025-01-01", "b"), ("r2", "2025-01-01", "b")],
                                 "run_id string, target_date string, board_key string")
    assert tables.duplicate_keys(runs, ["target_date", "board_key"]).count() == 1
    stats = spark.createDataFrame([(1,), (9,)], "term_id long")
    terms = spark.createDataFrame([(1,)], "term_id long")
    assert [r.term_id for r in tables.orphans(stats, terms, "term_id").collect()] == [9]


def _runs(spark, rows):
    df = spark.createDataFrame(rows, "run_id string, target_date string, board_key string, status string, "
                                     "is_recovered boolean")
    return tables.align(df.withColumn("target_date", F.col("target_date").cast("date")), schemas.PIPELINE_RUNS)


def test_append_runs_rejects_duplicates(spark):
    empty = spark.createDataFrame([], schemas.PIPELINE_RUNS)
    first = ledger.append_runs(empty, _runs(spark, [("r1", "2024-01-01", "b", "partial", None)]))
    row = first.collect()[0]
    assert row.is_recovered is False and row.created_at is not None
    with pytest.raises(ValueError):
        ledger.append_runs(first, _runs(spark, [("r2", "2024-01-01", "b", "failed", None)]))


def test_update_status(spark):
    runs = _runs(spark, [("r1", "2024-01-01", "b", "partial", False)])
    upd = spark.createDataFrame([("r1", "success"), ("nope", "failed")], "run_id string, status string")
    out = ledger.update_status(runs, upd).collect()
    assert len(out) == 1 and out[0].status == "success" and out[0].finished_at is None


@pytest.mark.parametrize("statuses,valid", [
    (["success"] * 7, 7),
    (["success", "success", "failed", "success", "failed", "success", "success"], 5),
    (["failed!"] * 7, 7),
    ([], 0),
])
def test_collection_validity(spark, statuses, valid):
    rows = [(f"r{i}", str(dt.date(2024, 1, 1) + dt.timedelta(days=i)), "b",
             "failed" if s == "failed!" else s, s == "failed!") for i, s in enumerate(statuses)]
    runs = _runs(spark, rows) if rows else spark.createDataFrame([], schemas.PIPELINE_RUNS)
    weeks = spark.createDataFrame([("2024-01-01", "b")], "week_start_date string, board_key string") \
        .withColumn("week_start_date", F.col("week_start_date").cast("date"))
    (r,) = ledger.invalid_dates(ledger.validate_collection(weeks, runs)).collect()
    assert r.valid_days == valid and len(r.invalid_dates) == 7 - valid
    assert r.invalid_dates == sorted(r.invalid_dates)


def test_schema_evolution_reads_false(spark):
    old = spark.createDataFrame([("r0", "success")], "run_id string, status string")
    new = spark.createDataFrame([("r1", "failed", True)], "run_id string, status string, is_recovered boolean")
    got = {r.run_id: r.is_recovered for r in tables.read_runs_evolved(old, new).collect()}
    assert got == {"r0": False, "r1": True}


def test_decode_charsets(spark):
    body = "日本語テキスト".encode("shift_jis")
    df = spark.createDataFrame([(bytearray(body), None), (bytearray("é".encode("utf-8")), "utf-8"),
                                (bytearray(b"\xff\xfe"), "utf-8"), (bytearray(body), "no-such-charset"), (bytearray(b"\x81"), None),
                                (None, "utf-8"), (bytearray("é".encode("latin-1")), "ISO-8859-1")], "body binary, charset string")
    got = [r.t for r in df.select(H.decode(F.col("body"), F.col("charset")).alias("t")).collect()]
    assert got[0] == "日本語テキスト" and got[1] == "é" and "�" in got[2]
    assert got[3] == "日本語テキスト"  # an unknown charset falls back on the default
    assert got[4] == "�" and got[5] is None and got[6] == "é"


def test_append_terms_unique(spark):
    from wordtide.operators import terms as T

    t = T.append_terms(T.empty_terms(spark), spark.createDataFrame([(1, "python")], "term_id long, normalized string"))
    row = t.collect()[0]
    assert row.is_blocked is False and row.needs_review is False and row.created_at is not None
    with pytest.raises(ValueError):
        T.append_terms(t, spark.createDataFrame([(2, "python")], "term_id long, normalized string"))
    with pytest.raises(ValueError):
        T.append_terms(t, spark.createDataFrame([(1, "java")], "term_id long, normalized string"))


def test_ranking_without_a_limit_spans_tasks(spark):
    """One group with most rows, ties and NULLs: the same ranks as a window, dealt over several partitions."""
    from pyspark.sql import Window

    df = spark.range(3000).select(F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("g"), F.col("id"),
                                  F.when(F.col("id") % 17 != 0, F.col("id") % 40).alias("v"))
    order = [F.desc_nulls_last("v"), F.asc("id")]
    want = {r.id: r["rank"] for r in df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(*order))).collect()}
    got = tables.ranked(df, ["g"], order)
    assert {r.id: r["rank"] for r in got.collect()} == want
    assert {r.id: r["rank"] for r in tables.ranked(df, ["g"], order, 7).collect()} == {i: k for i, k in want.items() if k <= 7}
    assert tables.ranked(df.limit(0), ["g"], order).collect() == []


def test_ranked_keeps_null_groups(spark):
    rows = [(g, b, i) for i, (g, b) in enumerate([("a", 1), ("a", None), (None, 1), (None, None)] * 5)]
    df = spark.createDataFrame(rows, "g string, b int, id int").repartition(3)
    want = {(g, b, i): 1 + sum((g, b) == r[:2] and r[2] > i for r in rows) for g, b, i in rows}
    for limit in (None, 0, 9):
        out = tables.ranked(df, ["g", "b"], [F.desc("id")], limit)
        assert out.columns == ["g", "b", "id", "rank"]
        assert {(r.g, r.b, r.id): r["rank"] for r in out.collect()} == want
