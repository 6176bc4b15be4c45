"""Registered queries: one per SURVEY §2 operator group, each over whole driver tables.

Every query reads the driver tables (whole tables, whole texts) and returns a
DataFrame whose columns match its oracle SQL in ``ORACLE``: dates as ISO text,
doubles rounded to 9 decimals, terms by their normalised text (term ids are an
implementation detail no other engine reproduces).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.functions import dates as Dt
from wordtide.functions import urls as U
from wordtide.functions.dates import iso
from wordtide.operators import daily, extraction as X, ledger, tables, terms as T, weekly
from wordtide.plans import edge_queries as edge
from wordtide.plans import oracle as O
from wordtide.plans import pipeline as P
from wordtide.plans import segment_queries as seg
from wordtide.session import delete_on_exit, new_path, stage
from wordtide.sources import adapters as A
from wordtide.sources import html as H
from wordtide.sources.page_files import read_pages, write_pages

Query = Callable[[SparkSession, str], DataFrame]

TRENDING_LIMIT = 10
ROUND = 9


def _r(c, name=None):
    col = F.col(c) if isinstance(c, str) else c
    return (F.round(col, ROUND) + F.lit(0.0)).alias(name or (c if isinstance(c, str) else "x"))


def _d(c, name=None):
    return iso(F.col(c)).alias(name or c)


# ----------------------------------------------------------------- weekly


def flagship_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 + W3 + W5 + W7 + W15: per (week, board) the top-10 terms by z-score."""
    t = P.weekly_trends(spark, sf_dir).withColumnRenamed("normalized", "term")
    top = weekly.trending(t, TRENDING_LIMIT, tie_col="term")
    return top.select(_d("week_start_date"), "board_key", "term", "post_hits", "total_posts",
                      _r("appearance_rate"), _r("zscore"), "rank")


def w2_weekly_aggregation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 + W3 + W4: weekly hits over valid days, totals over valid days and all days."""
    res = P.lineitem_daily(spark, sf_dir)
    rates = P.weekly_rates(res)
    all_days = weekly.weekly_total_posts(res.metrics).withColumnRenamed("total_posts", "total_posts_all")
    return (rates.join(all_days, weekly.WEEK, "left")
            .select(_d("week_start_date"), "board_key", F.col("normalized").alias("term"), "post_hits",
                    "thread_hits", "total_posts", F.coalesce("total_posts_all", F.lit(0)).alias("total_posts_all")))


def w7_weekly_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5 + W7: appearance rate and z-score of every (week, board, term)."""
    t = P.weekly_trends(spark, sf_dir)
    return t.select(_d("week_start_date"), "board_key", F.col("normalized").alias("term"), "post_hits",
                    "total_posts", _r("appearance_rate"), _r("zscore"))


REG_OUT = ["intercept", "slope", "intercept_ci_lower", "intercept_ci_upper", "slope_ci_lower",
           "slope_ci_upper", "p_value"]


def w8_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8-week OLS (coefficients, t-intervals, p-value, r²) for every week with 8 points."""
    r = P.weekly_with_regression(spark, sf_dir).where("has_regression")
    return r.select(_d("week_start_date"), "board_key", F.col("normalized").alias("term"),
                    *[_r(c) for c in REG_OUT + ["r_squared"]], _d("analysis_start_date"), _d("analysis_end_date"))


def _latest(spark, sf_dir, res=None):
    """W14 rows with their term text."""
    res = res or P.lineitem_daily(spark, sf_dir)
    r = weekly.with_regression(weekly.with_zscore(P.weekly_rates(res)))
    return tables.with_term_text(weekly.latest_regressions(r), res.terms)


def w14_latest_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regression row kept per (board, term) after a backfill of all weeks."""
    return _latest(spark, sf_dir).select("board_key", F.col("normalized").alias("term"),
                                         *[_r(c) for c in REG_OUT], _d("analysis_start_date"),
                                         _d("analysis_end_date"))


def w17_growth_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per board the 5 terms with the steepest latest slope."""
    lt = _latest(spark, sf_dir).withColumnRenamed("normalized", "term")
    top = weekly.growth_ranking(lt, 5, tie_col="term")
    return top.select("board_key", "term", _r("slope"), "rank")


def w16_w18_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W16 (one term's weekly history in a range) and W18 (its regression row)."""
    res = P.lineitem_daily(spark, sf_dir)  # one daily job for both lookups
    t = weekly.with_zscore(P.weekly_rates(res))
    # D2 (lookup by text) then W16 for that term.
    hist = weekly.term_history(t.where(F.col("normalized") == "ring"), None, "A", "1996-01-01", "1996-12-31")
    h = hist.select(F.lit("history").alias("lookup"), _d("week_start_date"), "board_key",
                    F.col("normalized").alias("term"), _r("appearance_rate", "value"))
    lt = _latest(spark, sf_dir, res)
    rl = weekly.regression_lookup(lt.where(F.col("normalized") == "gear"), "R")
    r = rl.select(F.lit("regression").alias("lookup"), _d("analysis_start_date", "week_start_date"), "board_key",
                  F.col("normalized").alias("term"), _r("slope", "value"))
    return h.unionByName(r)


def _weekly_job(spark, sf_dir):
    res = P.lineitem_daily(spark, sf_dir)
    stats = res.stats  # before the days, see ``P.weekly_rates``
    return weekly.run_weekly(P.weeks_of(res), P.runs_of(res), stats, res.metrics, materialize=stage), res


def w21_weekly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 + L7 + W20 + W21: per (week, board) processed / error terms and invalid dates."""
    out, _ = _weekly_job(spark, sf_dir)
    return out.summary.select(_d("week_start_date"), "board_key", "processed_terms", "error_terms",
                              F.col("valid_days").cast("int").alias("valid_days"),
                              F.array_join(F.transform("invalid_dates", lambda d: iso(d)), ",").alias("invalid_dates"),
                              "duration_sec")


def w22_weekly_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W22 end to end (with the W6 interval and the W13/W14 upserts): stored trend rows."""
    out, res = _weekly_job(spark, sf_dir)
    tr = tables.with_term_text(out.trends, res.terms)
    return tr.select(_d("week_start_date"), "board_key", F.col("normalized").alias("term"), "post_hits",
                     "total_posts", _r("appearance_rate"), _r("appearance_rate_ci_lower"),
                     _r("appearance_rate_ci_upper"), _r("zscore"))


def w6_binomial_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact interval for every distinct (post_hits, total_posts) of the weekly rows."""
    t = P.weekly_rates(P.lineitem_daily(spark, sf_dir)).select("post_hits", "total_posts").distinct()
    ci = weekly.with_binomial_ci(t)
    return ci.select("post_hits", "total_posts", _r("appearance_rate_ci_lower"), _r("appearance_rate_ci_upper"))


# ------------------------------------------------------------------ daily


def w6_native_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6 in column expressions: the interval for every distinct (hits, posts) of a day and role in ``conversations``."""
    res = P.conversation_daily(spark, sf_dir)
    t = res.stats.groupBy("date", "board_key", "post_hits").agg(F.count(F.lit(1)).alias("n_terms"))
    t = t.join(res.metrics.select("date", "board_key", "fetched_posts"), ["date", "board_key"]).groupBy("post_hits", "fetched_posts").agg(F.sum("n_terms").alias("n_terms"))
    ci = weekly.with_binomial_ci(t, "post_hits", "fetched_posts", native=True)
    return ci.select("post_hits", "fetched_posts", "n_terms", _r("appearance_rate_ci_lower"), _r("appearance_rate_ci_upper"))


def daily_term_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1-T5 + D3 + D6 + A2/A3: daily post and thread hits for every (date, board, term)."""
    res = P.lineitem_daily(spark, sf_dir)
    return res.stats.select(_d("date"), "board_key", F.col("normalized").alias("term"), "post_hits", "thread_hits")


def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A4 + A5 + A6 + A8: per-(date, board) run metrics."""
    res = P.lineitem_daily(spark, sf_dir)
    return res.metrics.select(_d("date"), "board_key", "run_id", "fetched_threads",
                              "fetched_posts", "parsed_posts", "parse_fail_posts", "tokenize_fail_posts",
                              "filtered_tokens", "total_tokens", _r("filtered_rate"), "duration_sec")


def a9_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 (limit 3, offset 1) for every (date, board), and A10 for one day."""
    res = P.lineitem_daily(spark, sf_dir)
    top = daily.top_terms_of_day(res.stats, limit=3, offset=1, tie_col="normalized")
    return top.select(_d("date"), "board_key", F.col("normalized").alias("term"), "post_hits", "rank")


def a10_metrics_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: the metrics row of one (date, board)."""
    res = P.lineitem_daily(spark, sf_dir)
    m = daily.metrics_lookup(res.metrics, "1996-03-04", "R")
    return m.select(_d("date"), "board_key", "fetched_posts", "total_tokens", "filtered_tokens")


def t_conversation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + T3 (NFKC) + A2/A3 on free text: conversations as posts."""
    res = P.conversation_daily(spark, sf_dir)
    return res.stats.select(_d("date"), "board_key", F.col("normalized").alias("term"), "post_hits", "thread_hits")


def t_conversation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4/A5 on free text: token and filter counters per (date, role)."""
    res = P.conversation_daily(spark, sf_dir)
    return res.metrics.select(_d("date"), "board_key", "fetched_threads", "fetched_posts", "total_tokens",
                              "filtered_tokens", _r("filtered_rate"))


def t2_lexicon_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only surfaces a (surface, pos) lexicon tags as nouns count as tokens."""
    res = P.lexicon_daily(spark, sf_dir)
    return res.stats.select(_d("date"), "board_key", F.col("normalized").alias("term"), "post_hits", "thread_hits")


def t2_lexicon_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 + A4: token counters when only lexicon nouns are tokens."""
    res = P.lexicon_daily(spark, sf_dir)
    return res.metrics.select(_d("date"), "board_key", "fetched_posts", "total_tokens", "filtered_tokens",
                              _r("filtered_rate"))


def t3_document_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + T3 + T4 on whole documents: every distinct surface and its normalised term."""
    docs = A.table(spark, sf_dir, "documents")
    s = docs.select(F.explode(T.regex_tokens(F.col("text"))).alias("surface")).distinct()
    return T.normalize_surfaces(s).select("surface", "normalized")


def d3_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids are dense 1..n, unique, one per term; D5/D6 blocked count."""
    res = P.lineitem_daily(spark, sf_dir)
    return res.terms.agg(F.count(F.lit(1)).alias("n_terms"), F.min("term_id").alias("min_id"),
                         F.max("term_id").alias("max_id"), F.count_distinct("term_id").alias("n_ids"),
                         F.count_distinct("normalized").alias("n_texts"),
                         F.count_if("is_blocked").alias("n_blocked"))


# ----------------------------------------------------------------- ledger


def l1_l5_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 (append with key checks) + L5 (status update): recovered failures become success."""
    posts = A.posts_from_lineitem(spark, sf_dir)
    new = A.runs_for_posts(posts)
    from wordtide import schemas

    runs = ledger.append_runs(spark.createDataFrame([], schemas.PIPELINE_RUNS), new)
    upd = runs.where((F.col("status") == "failed") & F.col("is_recovered")).select("run_id", F.lit("success").alias("status"))
    out = ledger.update_status(runs, upd)
    return out.select("run_id", _d("target_date"), "board_key", "status", "is_recovered",
                      F.date_format("finished_at", "yyyy-MM-dd HH:mm:ss").alias("finished_at"))


def l2_l4_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 (by id), L3 (by date and board), L4 (inclusive date range for a board)."""
    runs = A.runs_for_posts(A.posts_from_lineitem(spark, sf_dir))
    a = ledger.runs_in_range(runs, "1996-01-01", "1996-01-31", "N").withColumn("lookup", F.lit("range"))
    b = ledger.run_by_date_and_board(runs, "1997-05-05", "A").withColumn("lookup", F.lit("date_board"))
    c = ledger.run_by_id(runs, "R:1998-02-09").withColumn("lookup", F.lit("id"))
    return a.unionByName(b).unionByName(c).select("lookup", "run_id", _d("target_date"), "board_key", "status")


def l6_collection_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6 + L7: per (week, board) the valid days and the invalid dates in order."""
    posts = A.posts_from_lineitem(spark, sf_dir)
    runs = A.runs_for_posts(posts)
    weeks = posts.select(Dt.week_start(F.col("date")).alias("week_start_date"), "board_key").distinct()
    inv = ledger.invalid_dates(ledger.validate_collection(weeks, runs))
    return inv.select(_d("week_start_date"), "board_key", F.col("valid_days").cast("int").alias("valid_days"),
                      F.array_join(F.transform("invalid_dates", lambda d: iso(d)), ",").alias("invalid_dates"))


# ------------------------------------------------------------- extraction


NAV_LINKS = dict(container_tag="li", style_pattern=None, link_pattern=r"^/")


def s3_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3-S6 with list-item / root-link parameters: every navigation link of every page."""
    pages = A.table(spark, sf_dir, "pages")
    th = X.board_threads(pages, keys=["page_id"], **NAV_LINKS)
    return th.select("page_id", F.col("position").cast("int").alias("position"), "thread_path", "title")


def s7_page_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7-S9 with article/h1 parameters: one post per article, its whole text as lines."""
    pages = A.table(spark, sf_dir, "pages")
    posts = X.parse_thread_pages(pages, keys=["page_id"], post_tag="article", post_class=None,
                                 date_tag="h1", date_class=None, content_tag=None)
    return posts.select("page_id", "post_no", "date_text", "content")


def s8_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 column function on whole pages: the text's lines, length and hash."""
    pages = A.table(spark, sf_dir, "pages")
    t = pages.select("page_id", H.html_text(F.col("html")).alias("text"))
    return t.select("page_id", F.size(F.split("text", "\n")).alias("n_lines"), F.length("text").alias("n_chars"),
                    F.md5(F.col("text").cast("binary")).alias("text_md5"))


def s16_s18_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S16 (thread id), S17 (URL validity) on page URLs and derived thread URLs; S18
    (resolve each navigation link against its page URL)."""
    pages = A.table(spark, sf_dir, "pages")
    links = X.board_threads(pages.select("page_id", "url", "html"), keys=["page_id", "url"], **NAV_LINKS)
    thread_url = F.concat(F.regexp_extract("url", r"^([^?#]*)", 1), F.lit("/test/read.cgi/b/"),
                          F.col("page_id").cast("string"), F.lit("/l50"))
    return links.select(
        "page_id", F.col("position").cast("int").alias("position"),
        U.is_valid_url(F.col("url")).alias("url_valid"),
        U.thread_id(F.col("url")).alias("url_thread_id"),
        U.thread_id(thread_url).alias("thread_id"),
        U.build_url(F.col("url"), F.col("thread_path")).alias("resolved"))


def s2_page_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2: page bodies as bytes, by turns UTF-8, Shift_JIS, without a charset (Shift_JIS is the default) and with a
    charset nobody knows. Shift_JIS bodies hold half-width katakana, one byte each, where the page has non-ASCII letters."""
    pages = A.table(spark, sf_dir, "pages")
    kana_bytes = F.encode(F.regexp_replace("html", r"[^\x{00}-\x{7f}]", "\u00b1"), "ISO-8859-1")  # 0xB1 is U+FF71
    turn = F.col("page_id") % 4
    body = pages.select("page_id", F.when(turn == 0, F.encode("html", "UTF-8")).otherwise(kana_bytes).alias("body"),
                        F.when(turn == 0, "utf-8").when(turn == 1, "shift_jis").when(turn == 3, "x-none").alias("charset"))
    txt = body.select("page_id", H.decode(F.col("body"), F.col("charset")).alias("text"))
    return txt.select("page_id", F.length("text").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


def s1_page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2 + S8: the pages are written as raw files into folders, read back as a table with two folders and the
    empty files excluded by filters on the listing, and decoded."""
    folder = new_path(spark, "page-files")
    pages = A.table(spark, sf_dir, "pages").select(
        F.concat(F.lit("host"), F.col("page_id") % 5, F.lit("/"), F.col("page_id"), F.lit(".html")).alias("name"),
        F.when(F.col("page_id") % 13 != 0, F.encode("html", "UTF-8")).alias("body"))
    write_pages(pages, folder, "name", "body").write.format("noop").mode("overwrite").save()
    delete_on_exit(spark, folder)
    got = read_pages(spark, folder, "utf-8").where((F.col("size") > 0) & F.col("path").startswith("host") & F.col("path").endswith(".html"))
    got = got.where(~F.col("path").startswith("host3/"))
    return got.select("path", "size", F.sha2("body", 256).alias("body_sha256"), F.length("html").alias("n_chars"), "error")


def _active_threads(posts: DataFrame) -> DataFrame:
    """Per (board, thread) the days whose board page lists it, one row each: it has posts in the week up to the next day.

    Days on which the board has no post are no crawl; they need not be taken out, as nothing is kept for them.
    """
    days = posts.groupBy("board_key", "thread_path").agg(F.collect_set("date").alias("_dates"))
    listed = F.flatten(F.transform("_dates", lambda d: F.sequence(F.date_sub(d, 1), F.date_add(d, 6))))
    return days.select("board_key", "thread_path", F.array_distinct(listed).alias("target_dates"),
                       (-F.col("thread_path").cast("long")).alias("position"))


def s11_crawl_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10-S13 + S15: each (board, day) is a crawl whose board page lists the threads
    active in the past week, newest thread first; the scan stops at the first thread
    without posts on the day or the next day."""
    posts = A.posts_from_lineitem(spark, sf_dir)
    listing = _active_threads(posts).select("*", F.lit(True).alias("page_ok"))
    # Thread pages are per board here, so posts join on (board_key, thread_path).
    kept = X.collect_target_posts(listing, posts.drop("date"), join_keys=("board_key", "thread_path"), materialize=stage)
    return (kept.groupBy("board_key", "date")
            .agg(F.count_distinct("thread_path").alias("kept_threads"), F.count(F.lit(1)).alias("kept_posts"))
            .select(_d("date", "target_date"), "board_key", "kept_threads", "kept_posts"))


def s12_crawl_missing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11 + S12: as ``s11_crawl_cutoff``, but the page of a thread whose order is
    still pending ('P') could not be fetched: it is skipped and does not end the scan."""
    posts = A.posts_from_lineitem(spark, sf_dir)
    orders = A.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("thread_path"), (F.col("o_orderstatus") != "P").alias("page_ok"))
    listing = (_active_threads(posts).join(orders, "thread_path", "left")
               .withColumn("page_ok", F.coalesce("page_ok", F.lit(False))))
    fetched = posts.join(orders.where("page_ok").select("thread_path"), "thread_path", "left_semi")
    kept = X.collect_target_posts(listing, fetched.drop("date"), join_keys=("board_key", "thread_path"), materialize=stage)
    return (kept.groupBy("board_key", "date")
            .agg(F.count_distinct("thread_path").alias("kept_threads"), F.count(F.lit(1)).alias("kept_posts"))
            .select(_d("date", "target_date"), "board_key", "kept_threads", "kept_posts"))


def s14_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 prefix, S14 JST target date, W1 previous week, W12 window for every ship time."""
    ts = A.table(spark, sf_dir, "lineitem").select("l_shipdate").distinct()
    ws, we = Dt.previous_week(F.to_date("l_shipdate"))
    a, b = Dt.analysis_window(ws)
    return ts.select(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("ts"),
                     iso(Dt.target_date_jst(F.col("l_shipdate"))).alias("target_date"),
                     Dt.day_prefix(F.col("l_shipdate")).alias("day_prefix"),
                     iso(ws).alias("week_start"), iso(we).alias("week_end"),
                     iso(a).alias("analysis_start"), iso(b).alias("analysis_end"))


# ----------------------------------------------------------------- tables


POINTS = (3, 5, 8, 13)


def w9_regression_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W8-W12 for other numbers of weekly points: OLS, t-intervals and p-value over 3, 5, 8 and 13 weeks."""
    rates = stage(P.weekly_rates(P.lineitem_daily(spark, sf_dir)), "weekly-rates")
    out = None
    for n in POINTS:
        r = weekly.with_regression(rates, points=n).where("has_regression").withColumn("points", F.lit(n))
        out = r if out is None else out.unionByName(r)
    return out.select("points", _d("week_start_date"), "board_key", F.col("normalized").alias("term"),
                      *[_r(c) for c in REG_OUT + ["r_squared"]], _d("analysis_start_date"), _d("analysis_end_date"))


def u1_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert 1997's rows recomputed over all days (W4 totals, z-score NULL) into
    the stored trends: matched keys change, unseen keys are inserted, others stay."""
    res = P.lineitem_daily(spark, sf_dir)
    stored = weekly.with_zscore(P.weekly_rates(res))
    agg = weekly.weekly_aggregation(res.stats, term_cols=("term_id", "normalized"))
    upd = weekly.with_rates(agg, weekly.weekly_total_posts(res.metrics))
    upd = upd.where(F.year("week_start_date") == 1997).withColumn("zscore", F.lit(None).cast("double"))
    cols = ["week_start_date", "board_key", "term_id", "normalized", "post_hits", "total_posts",
            "appearance_rate", "zscore"]
    out = tables.upsert(stored.select(*cols), upd.select(*cols), ["week_start_date", "board_key", "term_id"],
                        ["post_hits", "total_posts", "appearance_rate", "zscore"])
    return out.select(_d("week_start_date"), "board_key", F.col("normalized").alias("term"), "post_hits",
                      "total_posts", _r("appearance_rate"), _r("zscore"))


def i2_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(thread, post number) keys of the structured posts that occur more than once."""
    posts = A.posts_from_lineitem(spark, sf_dir)
    return tables.duplicate_keys(posts, ["thread_path", "post_no"])


def i5_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4 + I5: 1995 ledger rows written before ``is_recovered`` existed read as false."""
    runs = A.runs_for_posts(A.posts_from_lineitem(spark, sf_dir))
    old = runs.where(F.year("target_date") == 1995).drop("is_recovered")
    new = runs.where(F.year("target_date") != 1995)
    ev = tables.read_runs_evolved(old, new)
    return ev.select("run_id", "status", "is_recovered")


def j4_runs_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + J4: metrics with their run (left join) and stats with their term text."""
    res = P.lineitem_daily(spark, sf_dir)
    runs = P.runs_of(res)
    j = tables.runs_with_metrics(res.metrics, runs)
    return j.select(_d("date"), "board_key", "status", "is_recovered", "fetched_posts")


QUERIES: dict[str, Query] = edge.QUERIES | seg.QUERIES | {
    "flagship_trending": flagship_trending,
    "w2_weekly_aggregation": w2_weekly_aggregation,
    "w7_weekly_trends": w7_weekly_trends,
    "w8_regression": w8_regression,
    "w9_regression_points": w9_regression_points,
    "w14_latest_regression": w14_latest_regression,
    "w17_growth_ranking": w17_growth_ranking,
    "w16_w18_lookups": w16_w18_lookups,
    "w21_weekly_summary": w21_weekly_summary,
    "w22_weekly_job": w22_weekly_job,
    "w6_binomial_ci": w6_binomial_ci,
    "w6_native_ci": w6_native_ci,
    "a_daily_term_stats": daily_term_stats,
    "a_daily_metrics": daily_metrics,
    "a9_top_terms": a9_top_terms,
    "a10_metrics_lookup": a10_metrics_lookup,
    "t_conversation_stats": t_conversation_stats,
    "t_conversation_metrics": t_conversation_metrics,
    "t2_lexicon_stats": t2_lexicon_stats,
    "t2_lexicon_metrics": t2_lexicon_metrics,
    "t3_document_terms": t3_document_terms,
    "d3_dictionary": d3_dictionary,
    "l1_l5_ledger": l1_l5_ledger,
    "l2_l4_lookups": l2_l4_lookups,
    "l6_collection_check": l6_collection_check,
    "s3_page_links": s3_page_links,
    "s7_page_posts": s7_page_posts,
    "s8_page_text": s8_page_text,
    "s16_s18_urls": s16_s18_urls,
    "s1_page_files": s1_page_files,
    "s2_page_decode": s2_page_decode,
    "s11_crawl_cutoff": s11_crawl_cutoff,
    "s12_crawl_missing_pages": s12_crawl_missing_pages,
    "s14_dates": s14_dates,
    "u1_upsert": u1_upsert,
    "i2_duplicate_keys": i2_duplicate_keys,
    "i5_schema_evolution": i5_schema_evolution,
    "j4_runs_metrics": j4_runs_metrics,
}

ORACLE: dict[str, str] = O.build(TRENDING_LIMIT) | edge.ORACLE | seg.ORACLE
