"""The streaming daily job equals the batch daily query on the same posts."""

import datetime as dt
import os

from pyspark.sql import functions as F

from wordtide import schemas
from wordtide.plans import jobs
from wordtide.sources import adapters as A
from wordtide.streaming.daily_stream import start_daily_stream

SF = "/root/testdata/sf0.001"


def test_stream_matches_batch(spark, tmpdir_path):
    # Two months of posts keep the date-partitioned writes small in local mode.
    posts = (A.posts_from_lineitem(spark, SF).where(F.col("date").between("1996-01-01", "1996-02-29"))
             .select(*[f.name for f in schemas.POSTS.fields]))
    src = os.path.join(tmpdir_path, "incoming")
    # Three files that split most days, and threads, across micro-batches.
    for i, name in enumerate("abc"):
        posts.where(F.pmod(F.xxhash64("thread_path", "post_no"), F.lit(3)) == i).coalesce(1).write.parquet(f"{src}/{name}")
    wh = os.path.join(tmpdir_path, "wh")
    q = start_daily_stream(spark, src + "/*", wh, os.path.join(tmpdir_path, "ckpt"), max_files_per_trigger=1,
                           prepare_terms=A.blocked_dictionary)
    q.awaitTermination(600)
    assert q.exception() is None
    stored = jobs.read_table(spark, wh, "daily_term_stats")
    terms = jobs.read_table(spark, wh, "terms")
    got = {(str(r.date), r.board_key, r.normalized): (r.post_hits, r.thread_hits)
           for r in stored.join(terms, "term_id").collect()}
    import __spark_entry__ as E

    exp = {(r.date, r.board_key, r.term): (r.post_hits, r.thread_hits)
           for r in E.queries()["a_daily_term_stats"](spark, SF).collect()
           if "1996-01-01" <= r.date <= "1996-02-29"}
    assert got == exp and len(got) > 0


def test_late_batches_read_only_new_posts(spark, tmpdir_path):
    """Three batches of one day's posts equal one job over them all; a batch run again changes nothing; earlier posts are not needed."""
    def posts(*texts):
        return spark.createDataFrame([(dt.date(2025, 1, 1), "b", f"/t{n % 2}", n, None, c) for n, c in texts], schemas.POSTS)

    batches = [[(1, "alpha beta alpha"), (2, "beta")], [(3, "alpha"), (4, None)], [(5, "gamma beta"), (6, "old")]]
    for i, b in enumerate(batches):
        jobs.late_posts_job(spark, posts(*b), f"{tmpdir_path}/late", i, prepare_terms=A.blocked_dictionary)
    jobs.late_posts_job(spark, posts(*batches[1]), f"{tmpdir_path}/late", 1, prepare_terms=A.blocked_dictionary)
    jobs.daily_job(spark, posts(*sum(batches, [])), f"{tmpdir_path}/whole", prepare_terms=A.blocked_dictionary)

    def stored(warehouse):
        terms = {r.term_id: r.normalized for r in jobs.read_table(spark, warehouse, "terms").collect()}
        stats = sorted((terms[r.term_id], r.post_hits, r.thread_hits) for r in jobs.read_table(spark, warehouse, "daily_term_stats").collect())
        (m,) = jobs.read_table(spark, warehouse, "pipeline_metrics_daily").collect()
        return stats, (m.fetched_threads, m.fetched_posts, m.total_tokens, m.filtered_tokens, m.tokenize_fail_posts)

    assert stored(f"{tmpdir_path}/late") == stored(f"{tmpdir_path}/whole")
    assert not os.path.exists(f"{tmpdir_path}/late/posts")
