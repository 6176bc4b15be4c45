"""Daily collection (the reference's crawl task) over already-fetched pages.

board pages (board_key, target_date, html)  --S3-S6-->  threads in board order
thread pages (url, html)                    --S7-S9-->  posts, latest N (S13)
threads + posts                             --S10-S12, S15-->  target-day posts

One call handles every (board, target date) crawl at once.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtide.functions.urls import url_path
from wordtide.operators import extraction as X


def collect_posts(board_pages: DataFrame, thread_pages: DataFrame,
                  max_posts: Optional[int] = None,
                  excluded_titles: Optional[list] = None) -> DataFrame:
    """Posts (date, board_key, thread_path, post_no, date_text, content) of each crawl's
    target day.

    ``thread_pages`` holds (board_key, target_date, url, html): the page as that crawl fetched it, the
    url being the thread path with or without host and ``/l<N>`` suffix. A thread that is fetched
    on several days has a page for each, and each crawl reads its own. A thread listed on a board
    page but missing here, or with NULL html, is skipped without ending the scan (S12).
    """
    crawl = X.CRAWL
    threads = X.board_threads(board_pages, excluded_titles=excluded_titles)
    pages = (thread_pages.select(*crawl, X.clean_thread_path(url_path(F.col("url"))).alias("thread_path"), "html")
             .where(F.col("html").isNotNull()))
    page = [*crawl, "thread_path"]
    posts = X.latest_posts(X.parse_thread_pages(pages, keys=page), max_posts, thread_keys=page)
    fetched = pages.select(*page).distinct().withColumn("page_ok", F.lit(True))
    listing = (threads.join(fetched, page, "left")
               .withColumn("page_ok", F.coalesce("page_ok", F.lit(False))))
    out = X.collect_target_posts(listing, posts, join_keys=page)
    return out.select("date", "board_key", "thread_path", "post_no", "date_text", "content")
