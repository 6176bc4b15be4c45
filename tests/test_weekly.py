"""The weekly job on small fixtures, and the end-to-end jobs on sf0.001."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from wordtide import schemas
from wordtide.operators import tables, weekly
from wordtide.plans import jobs
from wordtide.sources import adapters as A

WEEK = dt.date(2024, 1, 1)


def _day(i):
    return WEEK + dt.timedelta(days=i)


def _inputs(spark, statuses, hits, posts):
    runs = spark.createDataFrame(
        [(f"r{i}", _day(i), "b", s, False) for i, s in enumerate(statuses)],
        "run_id string, target_date date, board_key string, status string, is_recovered boolean")
    runs = tables.align(runs, schemas.PIPELINE_RUNS)
    stats = spark.createDataFrame([(_day(i), "b", 1, h, 1) for i, h in enumerate(hits)],
                                  "date date, board_key string, term_id long, post_hits int, thread_hits int")
    metrics = spark.createDataFrame([(_day(i), "b", p) for i, p in enumerate(posts)],
                                    "date date, board_key string, fetched_posts int")
    weeks = spark.createDataFrame([(WEEK, "b")], "week_start_date date, board_key string")
    return weeks, runs, stats, metrics


def test_integration_week(spark):
    hits = [5, 0, 7, 31, 2, 9, 6]
    posts = [80, 75, 92, 140, 66, 101, 59]
    out = weekly.run_weekly(*_inputs(spark, ["success"] * 7, hits, posts))
    (t,) = out.trends.collect()
    k, n = sum(hits), sum(posts)
    assert (t.post_hits, t.total_posts) == (k, n) and t.appearance_rate == pytest.approx(k / n, rel=1e-12)
    at_least = lambda p: sum(math.comb(n, j) * p ** j * (1 - p) ** (n - j) for j in range(k, n + 1))
    at_most = lambda p: sum(math.comb(n, j) * p ** j * (1 - p) ** (n - j) for j in range(k + 1))
    assert at_least(t.appearance_rate_ci_lower) == pytest.approx(0.025, rel=1e-9)
    assert at_most(t.appearance_rate_ci_upper) == pytest.approx(0.025, rel=1e-9)
    assert t.zscore is None
    (s,) = out.summary.collect()
    assert (s.processed_terms, s.error_terms, s.valid_days, s.invalid_dates) == (1, 0, 7, [])


def test_invalid_days_are_excluded(spark):
    st = ["success", "success", "failed", "success", "failed", "success", "success"]
    out = weekly.run_weekly(*_inputs(spark, st, [1] * 7, [10] * 7))
    (t,) = out.trends.collect()
    assert (t.post_hits, t.total_posts) == (5, 50)
    (s,) = out.summary.collect()
    assert [str(d) for d in s.invalid_dates] == ["2024-01-03", "2024-01-05"]


def test_no_valid_day(spark):
    out = weekly.run_weekly(*_inputs(spark, ["failed"] * 7, [1] * 7, [10] * 7))
    assert out.trends.count() == 0
    (s,) = out.summary.collect()
    assert (s.processed_terms, s.error_terms, s.valid_days, len(s.invalid_dates)) == (0, 0, 0, 7)


def test_rate_above_one_is_quarantined(spark):
    # A valid day with stats but no metrics (Q9): hits exceed posts -> check violation.
    weeks, runs, stats, metrics = _inputs(spark, ["success"] * 7, [5] * 7, [10] * 7)
    out = weekly.run_weekly(weeks, runs, stats, metrics.where("date = '2024-01-01'"))
    assert out.trends.count() == 0
    (s,) = out.summary.collect()
    assert (s.processed_terms, s.error_terms) == (0, 1)


def test_jobs_end_to_end_match_queries(spark, tmpdir_path):
    sf = "/root/testdata/sf0.001"
    # Ten weeks of posts keep the date-partitioned writes small in local mode.
    posts = A.posts_from_lineitem(spark, sf).where(F.col("date").between("1996-01-01", "1996-03-10"))
    jobs.record_runs(spark, tmpdir_path, A.runs_for_posts(posts))
    jobs.daily_job(spark, posts, tmpdir_path, prepare_terms=A.blocked_dictionary)
    boards = posts.select("board_key").distinct()
    # Two execution Mondays: the second week's z-score reads the first from storage.
    mondays = [r.d for r in posts.select(F.date_add(F.to_date(F.date_trunc("week", "date")), 7).alias("d"))
               .distinct().orderBy("d").collect()]
    assert len(mondays) >= 9
    for d in mondays[:3]:
        jobs.weekly_job(spark, tmpdir_path, jobs.weeks_for([str(d)], boards))
    stored = jobs.read_table(spark, tmpdir_path, "weekly_term_trends")
    terms = jobs.read_table(spark, tmpdir_path, "terms")
    got = {(str(r.week_start_date), r.board_key, r.normalized): (r.post_hits, r.total_posts)
           for r in tables.with_term_text(stored, terms).collect()}
    import __spark_entry__ as E

    ref = E.queries()["w7_weekly_trends"](spark, sf)
    weeks = {str(d - dt.timedelta(days=7)) for d in mondays[:3]}
    exp = {(r.week_start_date, r.board_key, r.term): (r.post_hits, r.total_posts)
           for r in ref.collect() if r.week_start_date in weeks}
    assert got == exp and len(got) > 0
    m = jobs.read_table(spark, tmpdir_path, "pipeline_metrics_daily")
    assert m.count() == posts.select("date", "board_key").distinct().count()


def test_weekly_counts_beyond_32_bits(spark):
    """Seven days of 900 million posts: the sums need 64 bits."""
    weeks, runs, stats, metrics = _inputs(spark, ["success"] * 7, [400_000_000] * 7, [900_000_000] * 7)
    out = weekly.run_weekly(weeks, runs, stats, metrics)
    (t,) = out.trends.collect()
    assert (t.post_hits, t.total_posts) == (2_800_000_000, 6_300_000_000)
    assert t.appearance_rate_ci_lower < t.appearance_rate < t.appearance_rate_ci_upper


def _words(spark, *posts):
    return spark.createDataFrame([(WEEK, "b", f"/t{i}", i, None, c) for i, c in enumerate(posts)], schemas.POSTS)


def test_interrupted_dictionary_write_keeps_the_ids(spark, tmpdir_path, monkeypatch):
    jobs.daily_job(spark, _words(spark, "alpha beta"), tmpdir_path)
    before = {r.normalized: r.term_id for r in jobs.read_table(spark, tmpdir_path, "terms").collect()}
    monkeypatch.setattr(jobs, "drop_path", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):  # a full rewrite that stops before the old folders go
        jobs.store_terms(spark, tmpdir_path, jobs.read_table(spark, tmpdir_path, "terms"),
                         A.T.block_by_text(jobs.read_table(spark, tmpdir_path, "terms"), ["alpha"], "r"))
    monkeypatch.undo()
    # a folder without _SUCCESS is a write that never finished: not read
    import os

    os.makedirs(f"{tmpdir_path}/terms/00000099.base")
    rows = {r.normalized: (r.term_id, r.is_blocked) for r in jobs.read_table(spark, tmpdir_path, "terms").collect()}
    assert rows == {"alpha": (before["alpha"], True), "beta": (before["beta"], False)}
    jobs.daily_job(spark, _words(spark, "beta gamma"), tmpdir_path)
    after = {r.normalized: r.term_id for r in jobs.read_table(spark, tmpdir_path, "terms").collect()}
    assert {k: after[k] for k in before} == before and len(set(after.values())) == 3


def test_daily_job_adds_terms_without_rewriting(spark, tmpdir_path):
    import os

    jobs.daily_job(spark, _words(spark, "alpha beta"), tmpdir_path)
    first = os.listdir(f"{tmpdir_path}/terms")
    jobs.daily_job(spark, _words(spark, "beta gamma"), tmpdir_path)
    assert set(first) < set(os.listdir(f"{tmpdir_path}/terms"))
    jobs.daily_job(spark, _words(spark, "beta gamma"), tmpdir_path)
    assert len(os.listdir(f"{tmpdir_path}/terms")) == 2


def test_jobs_leave_no_staged_tables(spark, tmpdir_path):
    import os

    from wordtide.session import shared_dir

    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    jobs.record_runs(spark, tmpdir_path, A.runs_for_posts(_words(spark, "a")))
    jobs.daily_job(spark, _words(spark, "alpha"), tmpdir_path)
    jobs.weekly_job(spark, tmpdir_path, jobs.weeks_for(["2024-01-08"], spark.createDataFrame([("b",)], "board_key string")))
    assert set(os.listdir(folder)) == before


def test_unreadable_table_is_an_error_not_an_empty_one(spark, tmpdir_path):
    import os

    os.makedirs(f"{tmpdir_path}/terms/00000001.base")
    for name in ("_SUCCESS", "part-00000.parquet"):
        with open(f"{tmpdir_path}/terms/00000001.base/{name}", "w") as f:
            f.write("" if name[0] == "_" else "not parquet")
    with pytest.raises(Exception):
        jobs.read_table(spark, tmpdir_path, "terms").count()
    assert jobs.read_table(spark, tmpdir_path, "pipeline_runs").count() == 0
