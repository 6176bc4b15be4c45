"""Pages -> threads -> posts (S3-S15) as DataFrame operators.

A *crawl* is one (board_key, target_date): its board page lists threads in order
(``position``), each thread page holds posts.  Many crawls are processed at once;
the reference's early exit (S11) becomes an aggregate: per crawl the smallest
position of a fetched thread without target-day or next-day posts, then a filter.
"""

from __future__ import annotations

from typing import Callable, Optional, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordtide.sources import html as H

# --- fixed values (the reference's board conventions) ------------------------
# Thread titles excluded from collection (announcement threads).
EXCLUDED_THREAD_TITLES = [
    "★ UPLIFT プレミアム・サービスのお知らせ",
    "★ 5ちゃんねるから新しいお知らせです",
]
# Title decoration: leading "<n>:  " and trailing " (<n>)".
# Digits and white space are Unicode's, as in U+FF11 and U+3000, plus the separators U+001C..U+001F.
TITLE_PREFIX_RE = r"(?U)^\d+:[\s\x{1c}-\x{1f}]*"
TITLE_SUFFIX_RE = r"(?U)[\s\x{1c}-\x{1f}]*\(\d+\)$"
# Thread path suffix selecting the last posts, e.g. /l50.
PATH_LIMIT_SUFFIX_RE = r"(?U)/l\d+/?$"
# Posts per thread page that the crawl's own schedule asks for; the operators keep all unless told.
JOB_MAX_POSTS = 300
# -----------------------------------------------------------------------------

CRAWL = ["board_key", "target_date"]


def clean_title(raw: Column) -> Column:
    """S4."""
    return F.regexp_replace(F.regexp_replace(raw, TITLE_PREFIX_RE, ""), TITLE_SUFFIX_RE, "")


def clean_thread_path(href: Column) -> Column:
    """Drop a trailing /l<n>[/], then trailing slashes."""
    return F.regexp_replace(F.regexp_replace(href, PATH_LIMIT_SUFFIX_RE, ""), "/+$", "")


def board_threads(board_pages: DataFrame, html_col: str = "html", keys: Sequence[str] = CRAWL,
                  excluded_titles: Optional[list[str]] = None, **parse_opts) -> DataFrame:
    """Board pages -> (keys..., position, thread_path, title) in board order.

    ``position`` is the link's index on its page, so it survives the exclusions
    (gaps are fine: only the order matters).  Excluded titles are a short fixed
    list, so ``isin`` is enough; a large list would be a broadcast anti join.
    """
    links = H.board_links_udf(**parse_opts)(F.col(html_col))
    excluded = EXCLUDED_THREAD_TITLES if excluded_titles is None else excluded_titles
    t = (board_pages.select(*keys, F.posexplode(links).alias("position", "link"))
         .select(*keys, "position", F.col("link.href").alias("href"),
                 clean_title(F.col("link.title")).alias("title")))
    if excluded:
        t = t.where(~F.col("title").isin(excluded))
    return (t.withColumn("thread_path", clean_thread_path(F.col("href")))
            .where(F.col("thread_path") != "")
            .select(*keys, "position", "thread_path", "title"))


def parse_thread_pages(thread_pages: DataFrame, html_col: str = "html", keys: Sequence[str] = ("thread_path",),
                       **parse_opts) -> DataFrame:
    """Thread pages -> (keys..., post_no, date_text, content); posts without
    a date or content are dropped.  A NULL page yields no posts."""
    posts = H.thread_posts_udf(**parse_opts)(F.col(html_col))
    p = (thread_pages.select(*keys, F.posexplode(posts).alias("pos", "post"))
         .select(*keys, (F.col("pos") + 1).cast("int").alias("post_no"),
                 F.col("post.date_text").alias("date_text"), F.col("post.content").alias("content")))
    return p.where((F.col("date_text") != "") & (F.col("content") != ""))


def latest_posts(posts: DataFrame, n: Optional[int] = None,
                 thread_keys: Sequence[str] = ("thread_path",), tie_break: Sequence[Column] = ()) -> DataFrame:
    """At most ``n`` newest posts (highest post_no) per thread, all when ``n`` is None.  The filter on
    ``row_number`` lets Spark cut each group to ``n`` before the shuffle.
    ``tie_break`` orders posts sharing a number (deterministic results)."""
    if not n:
        return posts
    w = Window.partitionBy(*thread_keys).orderBy(F.desc("post_no"), *tie_break)
    return posts.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def post_day(date_text: Column) -> Column:
    """The day a post's display text begins with, NULL when it has no ``yyyy/MM/dd(``."""
    return F.try_to_date(F.regexp_extract(date_text, r"^(\d{4}/\d{2}/\d{2})\(", 1), "yyyy/MM/dd")


def collect_target_posts(listing: DataFrame, posts: DataFrame, join_keys: Sequence[str] = ("thread_path",),
                         materialize: Optional[Callable[[DataFrame, str], DataFrame]] = None) -> DataFrame:
    """S10-S12 + S15 for many crawls at once.

    ``listing``: (board_key, target_date, position, thread_path, page_ok) — the
    threads of each crawl in board order; ``page_ok`` false means the page could
    not be fetched (S12: skipped, does not stop the scan). Instead of ``target_date`` it may hold ``target_dates``, an
    array of the days whose crawls list the thread at that position.
    ``posts``: (join_keys..., post_no, date_text, content) of the fetched pages.
    ``materialize(df, name)`` (e.g. ``session.stage``) is applied to the threads that are open, whose posts are kept: where the scans
    stop early these are few, and the posts are then not shuffled.

    Returns the posts of each crawl's target day, from the threads before the
    first fetched thread with neither target-day nor next-day posts (S11).

    A listed thread is one row with the array of its target days and meets one row with the array of its posts' days, so what is
    shuffled grows with the threads and not with the days that list them. Both arrays are bounded by the calendar. The
    posts kept are an equi-join on (thread, day).
    """
    keys = list(join_keys)
    thread = [k for k in keys if k not in CRAWL]
    dated = posts.withColumn("_day", post_day(F.col("date_text"))).where(F.col("_day").isNotNull())
    days = dated.groupBy(*keys).agg(F.collect_set("_day").alias("_days"))
    place = ["board_key", "position", *thread]
    per_crawl = [k for k in keys if k == "target_date"]  # pages of their own for every crawl
    if per_crawl:
        listing = listing.withColumn("target_dates", F.array("target_date"))
    elif "target_dates" not in listing.columns:
        listing = listing.groupBy(*place, "page_ok").agg(F.collect_list("target_date").alias("target_dates"))
    fetched = listing.where("page_ok").select(*place, *per_crawl, "target_dates").join(days, keys, "left")
    seen = F.coalesce("_days", F.array().cast("array<date>"))
    quiet = F.array_except("target_dates", F.concat(seen, F.transform(seen, lambda d: F.date_sub(d, 1))))
    cutoff = (fetched.select("board_key", "position", F.explode(quiet).alias("target_date"))
              .groupBy(*CRAWL).agg(F.min("position").alias("_cutoff")))
    # threads without target-day posts have nothing to keep; one row per crawl is a calendar of the boards
    asked = F.filter("target_dates", lambda d: F.array_contains("_days", d))
    open_ = (fetched.select(*place, F.explode(asked).alias("target_date")).join(F.broadcast(cutoff), CRAWL, "left")
             .where(F.col("_cutoff").isNull() | (F.col("position") < F.col("_cutoff")))
             .select(*CRAWL, "position", *thread))
    if materialize is not None:
        open_ = materialize(open_, "open-threads")
    kept = open_.withColumn("_day", F.col("target_date")).join(dated, [*keys, "_day"])
    return kept.select(F.col("target_date").alias("date"), "board_key", *thread, "post_no", "date_text",
                       "content", "position")
