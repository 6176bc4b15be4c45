"""Registered queries for the branches that clean driver tables never reach, each with its DuckDB SQL.

Stored tables with rows to update, to insert and to leave alone; rows that violate checks and keys; decorated
titles; pages fetched on several days; failing tokenizers; dictionary edits by id. The rows that make the difference
are derived from the driver tables by rules stated in each query and repeated in its SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide import schemas
from wordtide.functions.dates import iso, post_date_text, week_start
from wordtide.functions.text import safe_udf_tokenizer
from wordtide.operators import daily, extraction as X, ledger, tables, terms as T, weekly
from wordtide.plans import oracle as O, pipeline as P
from wordtide.plans.collect import collect_posts
from wordtide.session import stage
from wordtide.sources import adapters as A

WEEKLY, DAILY = O.weekly_ctes(), O.daily_ctes()


def _r(c):
    return (F.round(F.col(c), 9) + F.lit(0.0)).alias(c)


def _d(c):
    return iso(F.col(c)).alias(c)


# ------------------------------------------------------------------ extraction

#: variants of a decorated title and of a thread link, chosen by the part key
TITLES = ["{k}: {t} ({k})", "{k}:　{t}　({k})", "１２: {t} (３)", "{k}:\x1c {t}\x1d(7)", "{t}", "{k}:  " + X.EXCLUDED_THREAD_TITLES[0] + " (2)",
          "{k}:　" + X.EXCLUDED_THREAD_TITLES[1] + "　({k})"]
SUFFIXES = ["/l50", "/", "/l50/", "", "//", "/l300"]


def s4_s6_board_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3-S6 on board pages in the reference's markup: one page per 40 parts, titles with ASCII and Unicode
    decoration, excluded titles, paths with limits and slashes."""
    k = F.col("p_partkey").cast("string")

    def fill(template):
        pieces = [k if x == "{k}" else F.col("p_name") if x == "{t}" else F.lit(x)
                  for x in template.replace("{k}", "\0{k}\0").replace("{t}", "\0{t}\0").split("\0") if x]
        return F.concat(*pieces)

    title = reduce(lambda c, i: F.when(F.col("p_partkey") % len(TITLES) == i, fill(TITLES[i])).otherwise(c), range(len(TITLES)), F.lit(""))
    suffix = F.element_at(F.array(*[F.lit(x) for x in SUFFIXES]), (F.col("p_partkey") % len(SUFFIXES) + 1).cast("int"))
    item = F.concat(F.lit('<p style="margin:0; background: #BEB;"><a href="/test/read.cgi/parts/'), k, suffix, F.lit('">'), title, F.lit("</a></p>"))
    pages = (A.table(spark, sf_dir, "part").select((F.floor(F.col("p_partkey") / 40)).alias("page"), F.struct("p_partkey", item.alias("h")).alias("x"))
             .groupBy("page").agg(F.sort_array(F.collect_list("x")).alias("xs"))  # 40 parts a page
             .select("page", F.concat(F.lit("<html><body>"), F.array_join(F.transform("xs", lambda x: x["h"]), "\n"), F.lit("</body></html>")).alias("html")))
    return X.board_threads(pages, keys=["page"]).select("page", F.col("position").cast("int").alias("position"), "thread_path", "title")


S4_S6_SQL = f"""
SELECT CAST(floor(p_partkey / 40.0) AS BIGINT) AS page,
       CAST(row_number() OVER (PARTITION BY floor(p_partkey / 40.0) ORDER BY p_partkey) - 1 AS INTEGER) AS position,
       '/test/read.cgi/parts/' || p_partkey AS thread_path, p_name AS title
FROM part QUALIFY p_partkey % {len(TITLES)} < {len(TITLES) - 2}"""


def s13_latest_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two newest turns of every conversation."""
    posts = A.posts_from_conversations(spark, sf_dir)
    return X.latest_posts(posts, 2).select("thread_path", "post_no", "content")


S13_SQL = f"""WITH {O.POSTS_CONVERSATIONS}
SELECT thread_path, post_no, content FROM posts QUALIFY row_number() OVER (PARTITION BY thread_path ORDER BY post_no DESC) <= 2"""

#: conversation posts spread over days, so that threads are fetched on several of them
DAY_SQL = "CAST(DATE '2024-01-01' + CAST(conv_id % 70 + turn // 2 AS INTEGER) AS DATE)"


def s15_crawl_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (board, day) crawl fetches its own copies of the threads active around that day; a thread fetched
    on several days has a page for each, and pages of every 11th conversation are missing. Post by post."""
    c = A.table(spark, sf_dir, "conversations")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("conv_id") % 70 + F.floor(F.col("turn") / 2)).cast("int"))
    posts = c.select(F.concat(F.lit("b"), F.col("conv_id") % 3).alias("board_key"), "conv_id", "turn", day.alias("day"), "text")
    crawls = posts.select("board_key", F.col("day").alias("target_date")).distinct()
    around = F.explode(F.sequence(F.date_sub("day", 1), F.date_add("day", 2))).alias("target_date")
    listing = posts.select("board_key", "conv_id", around).distinct().join(crawls, ["board_key", "target_date"], "left_semi")
    path = F.concat(F.lit("/test/read.cgi/"), F.col("board_key"), F.lit("/"), F.col("conv_id"))
    link = F.concat(F.lit('<p style="background:#BEB"><a href="'), path, F.lit('/l50">1: t (2)</a></p>'))
    boards = (listing.select("board_key", "target_date", F.struct((-F.col("conv_id")).alias("o"), link.alias("h")).alias("x"))
              .groupBy("board_key", "target_date").agg(F.sort_array(F.collect_list("x")).alias("xs"))  # one day's threads of a board
              .select("board_key", "target_date", F.array_join(F.transform("xs", lambda x: x["h"]), "").alias("html")))
    safe = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", "&", "&amp;"), "<", "&lt;"), ">", "&gt;")
    stamp = post_date_text(F.col("day").cast("timestamp_ntz"))
    post = F.concat(F.lit('<div class="clear post"><span class="date">'), stamp, F.lit('</span><div class="post-content">'),
                    F.coalesce(safe, F.lit("")), F.lit("</div></div>"))
    seen = listing.join(posts.select("conv_id", "turn", "day", post.alias("h")), "conv_id").where("day <= date_add(target_date, 1)")
    pages = (seen.groupBy("board_key", "target_date", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "h"))).alias("xs"))
             .select("board_key", "target_date", F.concat(F.lit("https://host.example"), path, F.lit("/")).alias("url"),
                     F.when(F.col("conv_id") % 11 != 0, F.array_join(F.transform("xs", lambda x: x["h"]), "")).alias("html")))
    out = collect_posts(boards, pages)
    return out.select(_d("date"), "board_key", "thread_path", "post_no", "content")


S15_SQL = f"""WITH p AS (
  SELECT 'b' || (conv_id % 3) AS board_key, conv_id, turn, {DAY_SQL} AS day, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS post_no FROM conversations),
crawls AS (SELECT DISTINCT board_key, day AS target_date FROM p),
listing AS (
  SELECT DISTINCT p.board_key, p.conv_id, CAST(p.day + CAST(k AS INTEGER) AS DATE) AS target_date FROM p, range(-1, 3) t(k)
  SEMI JOIN crawls c ON c.board_key = p.board_key AND c.target_date = CAST(p.day + CAST(k AS INTEGER) AS DATE)),
act AS (
  SELECT l.board_key, l.conv_id, l.target_date, bool_or(p.day IN (l.target_date, l.target_date + 1) AND trim(coalesce(p.text, '')) <> '') AS active
  FROM listing l JOIN p ON p.conv_id = l.conv_id WHERE l.conv_id % 11 <> 0 GROUP BY ALL),
cut AS (SELECT board_key, target_date, max(conv_id) AS cutoff FROM act WHERE NOT active GROUP BY ALL)
SELECT strftime(l.target_date, '%Y-%m-%d') AS date, l.board_key, '/test/read.cgi/' || l.board_key || '/' || l.conv_id AS thread_path,
       CAST(p.post_no AS INTEGER) AS post_no, trim(p.text, ' \n\t\r') AS content
FROM listing l JOIN p ON p.conv_id = l.conv_id AND p.day = l.target_date
LEFT JOIN cut c ON c.board_key = l.board_key AND c.target_date = l.target_date
WHERE l.conv_id % 11 <> 0 AND (c.cutoff IS NULL OR l.conv_id > c.cutoff) AND trim(coalesce(p.text, ''), ' \n\t\r') <> ''"""


# ------------------------------------------------------------------ terms


def t5_tokenizer_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: a Python tokenizer that raises on texts of odd length; those posts count as failures, the others go on. Turns 2
    and 3 lose their text (null, empty): no tokens, no failure."""
    def split_words(text):
        if len(text) % 2:
            raise ValueError("odd")
        return text.split(" ")

    tok = safe_udf_tokenizer(split_words)
    posts = A.posts_from_conversations(spark, sf_dir).withColumn(
        "content", F.when(F.col("post_no") == 2, None).when(F.col("post_no") == 3, "").otherwise(F.col("content")))
    res = daily.run_daily(posts, T.empty_terms(spark), tokenizer=tok, materialize=stage)
    return res.metrics.select(_d("date"), "board_key", "parsed_posts", "tokenize_fail_posts", "total_tokens")


T5_SQL = f"""WITH {O.POSTS_CONVERSATIONS},
p AS (SELECT date, board_key, CASE WHEN post_no NOT IN (2, 3) THEN content END AS t FROM posts)
SELECT strftime(date, '%Y-%m-%d') AS date, board_key, count(*) AS parsed_posts,
       count(*) FILTER (WHERE length(t) % 2 = 1) AS tokenize_fail_posts,
       CAST(coalesce(sum(len(string_split(t, ' '))) FILTER (WHERE length(t) % 2 = 0 AND t <> ''), 0) AS BIGINT) AS total_tokens
FROM p GROUP BY ALL"""

TERMS_SQL = DAILY + f""",
dict AS (SELECT DISTINCT t AS normalized FROM (SELECT unnest(nterms) AS t FROM normed) WHERE t <> '')"""


def d5_dictionary_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1/D2/D5 by id sets: terms that start with 'b' or 's' get blocked with a reason, the stop word 'old' is
    unblocked without one, ids nobody has change nothing; then the rows of the touched ids are looked up."""
    terms = P.lineitem_daily(spark, sf_dir).terms
    first = F.substring("normalized", 1, 1)
    block = terms.where(first.isin("b", "s")).select("term_id", F.lit(True).alias("is_blocked"), F.lit("review").alias("blocked_reason"))
    free = T.get_by_normalized(terms, "old").select("term_id", F.lit(False).alias("is_blocked"), F.lit(None).cast("string").alias("blocked_reason"))
    nobody = terms.select((F.col("term_id") + 1_000_000_000).alias("term_id"), F.lit(True).alias("is_blocked"), F.lit("x").alias("blocked_reason"))
    updates = block.unionByName(free).unionByName(nobody)
    edited = T.update_blocked(terms, updates)
    looked = T.get_by_ids(edited, block.unionByName(free).select("term_id"))
    return looked.select("normalized", "is_blocked", "blocked_reason", "needs_review")


D5_SQL = TERMS_SQL + """
SELECT normalized, normalized <> 'old' AS is_blocked, CASE WHEN normalized <> 'old' THEN 'review' END AS blocked_reason, false AS needs_review
FROM dict WHERE substr(normalized, 1, 1) IN ('b', 's') OR normalized = 'old'"""


def d4_append_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4 + I4: rows appended with NULL flags get the defaults, given flags stay; D2 by a set of texts."""
    terms = P.lineitem_daily(spark, sf_dir).terms
    third = F.col("term_id") % 3 == 0
    new = terms.select((F.col("term_id") + 500_000).alias("term_id"), F.concat(F.lit("new "), F.col("normalized")).alias("normalized"),
                       F.when(F.length("normalized") % 2 == 0, F.lit(True)).alias("needs_review"), F.when(third, F.lit(None).cast("boolean")).alias("is_blocked"))
    all_terms = T.append_terms(terms, new)
    return T.get_by_texts(all_terms, new.select("normalized")).select(
        "normalized", "needs_review", "is_blocked", "blocked_reason", F.col("created_at").isNotNull().alias("dated"))


D4_SQL = TERMS_SQL + """
SELECT 'new ' || normalized AS normalized, length(normalized) % 2 = 0 AS needs_review, false AS is_blocked,
       CAST(NULL AS VARCHAR) AS blocked_reason, true AS dated FROM dict"""


# ------------------------------------------------------------------ stored tables


def a7_a11_stored_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 + A11 + J1: stored stats of even months hold doubled hits; the job's rows of 1996 are upserted (updates and
    inserts), other stored rows stay, and rows of 1995's odd months, not stored yet, are appended. With term text."""
    res = P.lineitem_daily(spark, sf_dir)
    stats = res.stats.select("date", "board_key", "term_id", "post_hits", "thread_hits", "created_at")
    even = F.month("date") % 2 == 0
    stored = stats.where(even).withColumn("post_hits", F.col("post_hits") * 2)
    keys = ["date", "board_key", "term_id"]
    out = tables.upsert(stored, stats.where(F.year("date") == 1996), keys, ["post_hits", "thread_hits"])
    out = tables.append(out, stats.where((F.year("date") == 1995) & ~even), keys, "daily_term_stats")
    return tables.with_term_text(out, res.terms).select(_d("date"), "board_key", F.col("normalized").alias("term"), "is_blocked", "post_hits", "thread_hits")


A7_SQL = DAILY + """
SELECT strftime(date, '%Y-%m-%d') AS date, board_key, term, false AS is_blocked,
       CASE WHEN year(date) = 1996 OR month(date) % 2 = 1 THEN post_hits ELSE post_hits * 2 END AS post_hits, thread_hits
FROM stats WHERE month(date) % 2 = 0 OR year(date) IN (1995, 1996)"""


def a8_stored_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored metrics of board A carry a run id and 7 failures; the upsert overwrites them with NULL run ids and the
    job's counts for 1997, inserts the other boards' days of 1997, and leaves the rest."""
    m = P.lineitem_daily(spark, sf_dir).metrics
    stored = m.where("board_key = 'A'").withColumn("run_id", F.lit("stored")).withColumn("tokenize_fail_posts", F.lit(7).cast("long"))
    updates = m.where(F.year("date") == 1997).withColumn("run_id", F.lit(None).cast("string"))
    out = tables.upsert(stored, updates, ["date", "board_key"], ["run_id", "fetched_posts", "tokenize_fail_posts", "total_tokens"])
    return out.select(_d("date"), "board_key", "run_id", "fetched_posts", "tokenize_fail_posts", "total_tokens", "fetched_threads")


A8_SQL = DAILY + """
SELECT strftime(date, '%Y-%m-%d') AS date, board_key, CASE WHEN year(date) <> 1997 THEN 'stored' END AS run_id, fetched_posts,
       CAST(CASE WHEN year(date) = 1997 THEN 0 ELSE 7 END AS BIGINT) AS tokenize_fail_posts, total_tokens, fetched_threads
FROM metrics WHERE board_key = 'A' OR year(date) = 1997"""


def _weekly_against_stored(spark, sf_dir):
    """W22 for the weeks of 1997 against stored rows: the weeks before are history, 1997's own rows are stale (z-score 99)."""
    res = P.lineitem_daily(spark, sf_dir)
    rates = stage(P.weekly_rates(res), "rates")
    stale = F.year("week_start_date") >= 1997
    ci = {c: F.lit(None).cast("double") for c in ("appearance_rate_ci_lower", "appearance_rate_ci_upper")}
    stored = weekly.with_zscore(rates).withColumns(ci).withColumn("zscore", F.when(stale, F.lit(99.0)).otherwise(F.col("zscore")))
    stored = stored.withColumn("appearance_rate", F.when(stale, F.lit(0.5)).otherwise(F.col("appearance_rate")))
    weeks = rates.where(F.year("week_start_date") == 1997).select("week_start_date", "board_key").distinct()
    regs = rates.groupBy("board_key", "term_id").agg(F.lit(999.0).alias("slope"), F.lit(0.0).alias("intercept"))
    regs = tables.align(regs.withColumn("analysis_start_date", F.lit("1990-01-01").cast("date")).withColumn("analysis_end_date", F.lit("1990-02-25").cast("date")),
                        schemas.TERM_REGRESSION_RESULTS)
    out = weekly.run_weekly(weeks, P.runs_of(res), res.stats, res.metrics, tables.align(stored, schemas.WEEKLY_TERM_TRENDS), regs, materialize=stage)
    return out, res


def w13_stored_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W13 + J2: stale rows of the analysed weeks are replaced, also where the new z-score is NULL."""
    out, res = _weekly_against_stored(spark, sf_dir)
    return tables.with_term_text(out.trends, res.terms).select(
        _d("week_start_date"), "board_key", F.col("normalized").alias("term"), "post_hits", "total_posts", _r("appearance_rate"), _r("zscore"))


W13_SQL = WEEKLY + f"""
SELECT {O.iso('week_start_date')} AS week_start_date, board_key, term, post_hits, total_posts, {O.rnd('appearance_rate')} AS appearance_rate,
       {O.rnd('zscore')} AS zscore
FROM trends WHERE year(week_start_date) = 1997"""


def w14_stored_regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W14 + W18 + J3: stored regressions change for the series that have one in 1997, the others keep slope 999."""
    out, res = _weekly_against_stored(spark, sf_dir)
    return tables.with_term_text(out.regressions, res.terms).select(
        "board_key", F.col("normalized").alias("term"), _r("slope"), _d("analysis_end_date"))


W14_SQL = WEEKLY + O.regression_ctes() + f""",
l97 AS (SELECT * FROM regcols WHERE year(week_start_date) = 1997
        QUALIFY row_number() OVER (PARTITION BY board_key, term ORDER BY week_start_date DESC) = 1)
SELECT s.board_key, s.term, {O.rnd('coalesce(l.slope, 999.0)')} AS slope, coalesce({O.iso('l.analysis_end_date')}, '1990-02-25') AS analysis_end_date
FROM (SELECT DISTINCT board_key, term FROM rates) s LEFT JOIN l97 l ON l.board_key = s.board_key AND l.term = s.term"""


def w19_append_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend rows of later years are appended to the stored ones of 1995 and before."""
    trends = stage(P.weekly_trends(spark, sf_dir), "trends")
    early = F.year("week_start_date") <= 1995
    out = tables.append(trends.where(early), trends.where(~early), ["week_start_date", "board_key", "term_id"], "weekly_term_trends")
    return out.groupBy(F.year("week_start_date").cast("long").alias("year"), "board_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("post_hits").alias("post_hits"))


W19_SQL = WEEKLY + """
SELECT year(week_start_date) AS year, board_key, count(*) AS n, CAST(sum(post_hits) AS BIGINT) AS post_hits FROM trends GROUP BY ALL"""


def w20_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid days whose metrics are missing (days of the month divisible by 4) give weeks with more hits than
    posts; such terms are counted as errors and not stored."""
    res = P.lineitem_daily(spark, sf_dir)
    stats = res.stats  # before the metrics, see ``P.weekly_rates``
    metrics = res.metrics.where(F.dayofmonth("date") % 4 != 0)
    out = weekly.run_weekly(P.weeks_of(res), P.runs_of(res), stats, metrics, materialize=stage)
    stored = out.trends.groupBy("week_start_date", "board_key").agg(F.count(F.lit(1)).alias("stored"))
    return out.summary.join(stored, ["week_start_date", "board_key"], "left").select(
        _d("week_start_date"), "board_key", "processed_terms", "error_terms", F.coalesce("stored", F.lit(0)).alias("stored"))


W20_SQL = DAILY + """,
wagg AS (
  SELECT CAST(date_trunc('week', s.date) AS DATE) AS week_start_date, s.board_key, s.term, sum(s.post_hits) AS h
  FROM stats s SEMI JOIN valid v ON s.date = v.date AND s.board_key = v.board_key GROUP BY 1, 2, 3),
wtot AS (
  SELECT CAST(date_trunc('week', m.date) AS DATE) AS week_start_date, m.board_key, sum(m.fetched_posts) AS n
  FROM metrics m SEMI JOIN valid v ON m.date = v.date AND m.board_key = v.board_key WHERE day(m.date) % 4 <> 0 GROUP BY 1, 2),
j AS (SELECT a.*, coalesce(n, 0) = 0 OR h <= n AS ok FROM wagg a LEFT JOIN wtot USING (week_start_date, board_key))
SELECT strftime(w.week_start_date, '%Y-%m-%d') AS week_start_date, w.board_key, count(*) FILTER (WHERE ok) AS processed_terms,
       count(*) FILTER (WHERE NOT ok) AS error_terms, count(*) FILTER (WHERE ok) AS stored
FROM (SELECT DISTINCT CAST(date_trunc('week', date) AS DATE) AS week_start_date, board_key FROM posts) w
LEFT JOIN j USING (week_start_date, board_key) GROUP BY ALL"""


def w20_error_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rows spoilt so that kernels fail (hits that overflow when summed, negative hits, days without metrics):
    per week and board, how many terms were not stored for which reason, and how many were."""
    res = P.lineitem_daily(spark, sf_dir)
    day, first = F.dayofmonth("date"), F.substring("normalized", 1, 1)
    hits = F.when((day == 13) & (first == "g"), F.lit((1 << 63) - 1)).when((day == 17) & (first == "r"), -F.col("post_hits")).otherwise(F.col("post_hits"))
    stats = res.stats.withColumn("post_hits", hits)  # before the metrics, see ``P.weekly_rates``
    metrics = res.metrics.where(day % 4 != 0)
    out = weekly.run_weekly(P.weeks_of(res), P.runs_of(res), stats, metrics, materialize=stage)
    why = out.quarantine.select("week_start_date", "board_key", F.explode("violations").alias("reason"))
    both = why.unionByName(out.trends.select("week_start_date", "board_key", F.lit("stored").alias("reason")))
    return both.groupBy(_d("week_start_date"), "board_key", "reason").agg(F.count(F.lit(1)).alias("n"))


W20_REASONS_SQL = DAILY + """,
spoilt AS (
  SELECT date, board_key, term, CASE WHEN day(date) = 13 AND term[1] = 'g' THEN 9223372036854775807::HUGEINT
    WHEN day(date) = 17 AND term[1] = 'r' THEN -post_hits ELSE post_hits END AS post_hits FROM stats),
wagg AS (
  SELECT CAST(date_trunc('week', s.date) AS DATE) AS week, s.board_key, s.term, sum(s.post_hits) AS h
  FROM spoilt s SEMI JOIN valid v ON s.date = v.date AND s.board_key = v.board_key GROUP BY 1, 2, 3),
wtot AS (
  SELECT CAST(date_trunc('week', m.date) AS DATE) AS week, m.board_key, sum(m.fetched_posts) AS n
  FROM metrics m SEMI JOIN valid v ON m.date = v.date AND m.board_key = v.board_key WHERE day(m.date) % 4 <> 0 GROUP BY 1, 2),
j AS (SELECT a.*, coalesce(n, 0) AS n, h > 9223372036854775807 AS big FROM wagg a LEFT JOIN wtot USING (week, board_key)),
r AS (
  SELECT week, board_key, unnest(CASE WHEN big THEN ['sum: post_hits exceed 64 bits'] ELSE
    list_filter([CASE WHEN n > 0 AND (h < 0 OR h > n) THEN 'interval: post_hits outside 0 to total_posts' END,
                 CASE WHEN h < 0 THEN 'check_weekly_term_trends_post_hits' END,
                 CASE WHEN n > 0 AND (h < 0 OR h > n) THEN 'check_weekly_term_trends_appearance_rate' END,
                 CASE WHEN h >= 0 AND (n = 0 OR h <= n) THEN 'stored' END], lambda x: x IS NOT NULL) END) AS reason FROM j)
SELECT strftime(week, '%Y-%m-%d') AS week_start_date, board_key, reason, count(*) AS n FROM r GROUP BY ALL"""


# ------------------------------------------------------------------ integrity


def i1_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per violated check of all five tables, over rows that are spoilt by rule."""
    res = P.lineitem_daily(spark, sf_dir)
    dom = F.dayofmonth("date")
    # the stats before the runs, see ``P.weekly_rates``
    stats = res.stats.withColumn("post_hits", F.when(dom == 3, -F.col("post_hits")).otherwise(F.col("post_hits"))) \
        .withColumn("thread_hits", F.when(dom == 5, F.lit(-1)).when(dom == 6, F.lit(None)).otherwise(F.col("thread_hits")))
    runs = P.runs_of(res).withColumn("status", F.when(F.dayofmonth("target_date") == 10, "unknown").otherwise(F.col("status")))
    metrics = res.metrics.withColumn("filtered_rate", F.when(dom == 7, F.col("filtered_rate") + 1.5).when(dom == 8, F.lit(float("nan")))
                                     .otherwise(F.col("filtered_rate"))).withColumn("duration_sec", F.when(dom == 9, F.lit(-5)).otherwise(F.col("duration_sec"))) \
        .withColumn("total_tokens", F.when(dom == 9, -F.col("fetched_posts")).otherwise(F.col("total_tokens")))
    rates = P.weekly_rates(res)
    month = F.month("week_start_date")
    trends = rates.withColumns({
        "appearance_rate": F.when(month == 1, F.col("appearance_rate") + 1.25).otherwise(F.col("appearance_rate")),
        "appearance_rate_ci_lower": F.when(month == 2, F.lit(-0.5)).when(month == 3, F.lit(None)).otherwise(F.lit(0.0)),
        "appearance_rate_ci_upper": F.when(month == 2, F.lit(1.5)).otherwise(F.lit(1.0)),
        "total_posts": F.when(month == 4, F.lit(-1)).otherwise(F.col("total_posts"))})
    regs = rates.groupBy("board_key", "normalized").agg(F.lit(1).alias("x")).withColumn(
        "p_value", F.when(F.col("board_key") == "R", F.lit(1.5)).when(F.col("board_key") == "N", F.lit(None)).otherwise(F.lit(0.5)))
    out = [df.select(F.lit(name).alias("table_name"), F.explode(tables.violations(df, name)).alias("check_name")) for name, df in
           (("pipeline_runs", runs), ("daily_term_stats", stats), ("pipeline_metrics_daily", metrics), ("weekly_term_trends", trends),
            ("term_regression_results", regs))]
    return reduce(DataFrame.unionByName, out).groupBy("table_name", "check_name").agg(F.count(F.lit(1)).alias("n_violating"))


def _check_counts(rows):
    parts = [f"SELECT '{t}' AS table_name, 'check_{t}_{c}' AS check_name, count(*) AS n_violating FROM {src} WHERE {cond} HAVING count(*) > 0"
             for t, c, src, cond in rows]
    return "\nUNION ALL\n".join(parts)


I1_SQL = WEEKLY + "\n" + _check_counts([
    ("pipeline_runs", "status", "runs", "day(date) = 10"),
    ("daily_term_stats", "post_hits", "stats", "day(date) = 3"),
    ("daily_term_stats", "thread_hits", "stats", "day(date) = 5"),
    ("pipeline_metrics_daily", "filtered_rate", "metrics", "day(date) IN (7, 8)"),
    ("pipeline_metrics_daily", "duration_sec", "metrics", "day(date) = 9"),
    ("pipeline_metrics_daily", "total_tokens", "metrics", "day(date) = 9"),
    ("weekly_term_trends", "appearance_rate", "rates", "month(week_start_date) = 1"),
    ("weekly_term_trends", "ci_lower", "rates", "month(week_start_date) = 2"),
    ("weekly_term_trends", "ci_upper", "rates", "month(week_start_date) = 2"),
    ("weekly_term_trends", "total_posts", "rates", "month(week_start_date) = 4"),
    ("term_regression_results", "p_value", "(SELECT DISTINCT board_key, term FROM rates)", "board_key = 'R'"),
])


def i3_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stats whose term is gone (texts that start with 's') and metrics whose run is gone (failed runs); metrics
    of board N have no run id and are no orphans."""
    res = P.lineitem_daily(spark, sf_dir)
    terms = res.terms.where(~F.col("normalized").startswith("s"))
    metrics = res.metrics.withColumn("run_id", F.when(F.col("board_key") != "N", F.col("run_id")))
    a = tables.orphans(res.stats, terms, "term_id").groupBy("board_key").agg(F.count(F.lit(1)).alias("n_orphans"))
    b = tables.orphans(metrics, P.runs_of(res).where("status <> 'failed'"), "run_id").groupBy("board_key").agg(F.count(F.lit(1)).alias("n_orphans"))
    return a.select(F.lit("term_id").alias("fk"), "board_key", "n_orphans").unionByName(b.select(F.lit("run_id").alias("fk"), "board_key", "n_orphans"))


I3_SQL = DAILY + """
SELECT 'term_id' AS fk, board_key, count(*) AS n_orphans FROM stats WHERE term LIKE 's%' GROUP BY ALL
UNION ALL
SELECT 'run_id', board_key, count(*) FROM runs WHERE status = 'failed' AND board_key <> 'N' GROUP BY ALL"""


def i4_run_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4 + L1 + L5: runs appended with NULL ids, times and flags get the defaults; an update gives some a status and an end."""
    days = A.posts_from_lineitem(spark, sf_dir).select("date", "board_key").distinct()
    odd = F.dayofmonth("date") % 2 == 1
    bare = days.select(F.when(odd, F.concat_ws("/", "board_key", _d("date"))).alias("run_id"), F.col("date").alias("target_date"), "board_key",
                       F.lit("partial").alias("status"), F.when(F.month("date") == 5, F.lit(True)).alias("is_recovered"))
    runs = stage(ledger.append_runs(spark.createDataFrame([], schemas.PIPELINE_RUNS), stage(tables.with_run_defaults(bare), "bare-runs")), "runs")
    end = F.to_timestamp_ntz(F.concat(_d("target_date"), F.lit(" 18:00:00")))
    upd = runs.where(F.month("target_date") == 6).select(
        "run_id", F.lit("success").alias("status"), F.when(F.dayofmonth("target_date") > 15, end).alias("finished_at"))
    out = ledger.update_status(runs, upd.unionByName(upd.select(F.concat(F.lit("no "), "run_id").alias("run_id"), "status", "finished_at")))
    return out.groupBy("target_date", "board_key").agg(
        F.max("status").alias("status"), F.max("is_recovered").alias("is_recovered"), F.max(F.length("run_id")).cast("long").alias("id_length"),
        F.bool_and(F.col("started_at").isNotNull() & F.col("created_at").isNotNull()).alias("dated"),
        F.date_format(F.max("finished_at"), "yyyy-MM-dd HH:mm:ss").alias("finished_at")).withColumn("target_date", iso(F.col("target_date")))


I4_SQL = DAILY + """
SELECT strftime(date, '%Y-%m-%d') AS target_date, board_key, CASE WHEN month(date) = 6 THEN 'success' ELSE 'partial' END AS status,
       month(date) = 5 AS is_recovered, CAST(CASE WHEN day(date) % 2 = 1 THEN length(board_key) + 11 ELSE 36 END AS BIGINT) AS id_length, true AS dated,
       CASE WHEN month(date) = 6 AND day(date) > 15 THEN strftime(date, '%Y-%m-%d') || ' 18:00:00' END AS finished_at
FROM runs"""


QUERIES = {
    "s4_s6_board_threads": s4_s6_board_threads,
    "s13_latest_posts": s13_latest_posts,
    "s15_crawl_collection": s15_crawl_collection,
    "t5_tokenizer_failures": t5_tokenizer_failures,
    "d5_dictionary_terms": d5_dictionary_terms,
    "d4_append_defaults": d4_append_defaults,
    "a7_a11_stored_stats": a7_a11_stored_stats,
    "a8_stored_metrics": a8_stored_metrics,
    "w13_stored_trends": w13_stored_trends,
    "w14_stored_regressions": w14_stored_regressions,
    "w19_append_trends": w19_append_trends,
    "w20_quarantine": w20_quarantine,
    "w20_error_reasons": w20_error_reasons,
    "i1_checks": i1_checks,
    "i3_orphans": i3_orphans,
    "i4_run_defaults": i4_run_defaults,
}

ORACLE = {
    "s4_s6_board_threads": S4_S6_SQL,
    "s13_latest_posts": S13_SQL,
    "s15_crawl_collection": S15_SQL,
    "t5_tokenizer_failures": T5_SQL,
    "d5_dictionary_terms": D5_SQL,
    "d4_append_defaults": D4_SQL,
    "a7_a11_stored_stats": A7_SQL,
    "a8_stored_metrics": A8_SQL,
    "w13_stored_trends": W13_SQL,
    "w14_stored_regressions": W14_SQL,
    "w19_append_trends": W19_SQL,
    "w20_quarantine": W20_SQL,
    "w20_error_reasons": W20_REASONS_SQL,
    "i1_checks": I1_SQL,
    "i3_orphans": I3_SQL,
    "i4_run_defaults": I4_SQL,
}
