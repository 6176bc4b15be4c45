"""Command line for the two scheduled tasks (run with spark-submit or python -m).

    python -m wordtide.cli daily  --posts <parquet> --warehouse <folder> [--date 2024-01-07]
    python -m wordtide.cli weekly --warehouse <folder> --execution-date 2024-01-08 [...]
    python -m wordtide.cli stream --source <folder> --warehouse <folder> --checkpoint <folder>

Without ``--date`` the daily task takes yesterday in JST (S14) of the current UTC time.
"""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import functions as F

from wordtide.plans import jobs
from wordtide.session import ensure_checkpoint_dir, get_spark


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="wordtide")
    sub = ap.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily")
    d.add_argument("--posts", required=True)
    d.add_argument("--warehouse", required=True)
    d.add_argument("--date", action="append", help="target date(s); default: JST yesterday")
    w = sub.add_parser("weekly")
    w.add_argument("--warehouse", required=True)
    w.add_argument("--execution-date", action="append", required=True)
    s = sub.add_parser("stream")
    s.add_argument("--source", required=True)
    s.add_argument("--warehouse", required=True)
    s.add_argument("--checkpoint", required=True)
    args = ap.parse_args(argv)

    spark = get_spark()
    ensure_checkpoint_dir(spark)
    if args.cmd == "daily":
        posts = spark.read.parquet(args.posts)
        if args.date:
            dates = args.date
        else:  # S14: yesterday in JST (a scalar of the clock, computed on the driver)
            jst = datetime.timezone(datetime.timedelta(hours=9))
            dates = [str(datetime.datetime.now(jst).date() - datetime.timedelta(days=1))]
        days = F.array(*[F.lit(x).cast("date") for x in dates])
        posts = posts.where(F.array_contains(days, F.col("date")))
        jobs.daily_job(spark, posts, args.warehouse, target_dates=dates)
    elif args.cmd == "weekly":
        boards = jobs.read_table(spark, args.warehouse, "pipeline_runs").select("board_key")
        jobs.weekly_job(spark, args.warehouse, jobs.weeks_for(args.execution_date, boards))
    else:
        from wordtide.streaming.daily_stream import start_daily_stream

        start_daily_stream(spark, args.source, args.warehouse, args.checkpoint).awaitTermination()


if __name__ == "__main__":
    main()
