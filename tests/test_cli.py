"""The scheduled tasks through the command line on a small warehouse."""

import os

from pyspark.sql import functions as F

from wordtide import cli, schemas
from wordtide.plans import jobs
from wordtide.session import scale_conf
from wordtide.sources import adapters as A


def test_cli_daily_then_weekly(spark, tmpdir_path):
    posts = (A.posts_from_lineitem(spark, "/root/testdata/sf0.001")
             .where(F.col("date").between("1996-01-01", "1996-01-21"))
             .select(*[f.name for f in schemas.POSTS.fields]))
    src = os.path.join(tmpdir_path, "posts")
    posts.write.parquet(src)
    wh = os.path.join(tmpdir_path, "wh")
    jobs.record_runs(spark, wh, A.runs_for_posts(posts))
    days = [str(r.date) for r in posts.select("date").distinct().orderBy("date").collect()]
    cli.main(["daily", "--posts", src, "--warehouse", wh] + sum([["--date", d] for d in days[:5]], []))
    cli.main(["daily", "--posts", src, "--warehouse", wh] + sum([["--date", d] for d in days[5:]], []))
    m = jobs.read_table(spark, wh, "pipeline_metrics_daily")
    assert m.count() == posts.select("date", "board_key").distinct().count()
    # A recorded run without any posts still gets a metrics row of zeros.
    extra = spark.createDataFrame([("1996-02-01", "Z")], "target_date string, board_key string") \
        .withColumn("target_date", F.col("target_date").cast("date"))
    jobs.record_runs(spark, wh, extra)
    cli.main(["daily", "--posts", src, "--warehouse", wh, "--date", "1996-02-01"])
    z = jobs.read_table(spark, wh, "pipeline_metrics_daily").where("board_key = 'Z'").collect()
    assert len(z) == 1 and (z[0].fetched_posts, z[0].total_tokens, z[0].filtered_rate) == (0, 0, 0.0)
    cli.main(["weekly", "--warehouse", wh, "--execution-date", "1996-01-09", "--execution-date", "1996-01-16"])
    t = jobs.read_table(spark, wh, "weekly_term_trends")
    assert sorted(str(r.week_start_date) for r in t.select("week_start_date").distinct().collect()) == \
        ["1996-01-01", "1996-01-08"]


def test_scale_conf():
    c = scale_conf(100 * 10 ** 12, 16000)
    assert int(c["spark.sql.shuffle.partitions"]) > 100000
    assert int(scale_conf(10 ** 6, 8)["spark.sql.shuffle.partitions"]) == 16
