"""Extraction from our own board/thread page fixtures and URL goldens."""

import datetime

from pyspark.sql import functions as F

from wordtide.functions import dates as Dt
from wordtide.functions import urls as U
from wordtide.operators import extraction as X
from wordtide.sources import html as H

BOARD = """<html><body><div>
<p style="margin:0; background:  #BEB;"><a href="/test/read.cgi/news/2000000001/l50">1:  朝の話題 (12)</a></p>
<p style="margin:0; background:#BEB"><a href="/other/link">2: ignored (3)</a><a href="/test/read.cgi/news/2000000002/">2: 昼の話題 (7)</a></p>
<p style="background: #FFF"><a href="/test/read.cgi/news/2000000009/l10">9: wrong style (1)</a></p>
<p style="background:#BEB"><a href="/test/read.cgi/news/2000000003">3: ★ UPLIFT プレミアム・サービスのお知らせ (1)</a></p>
<p style="background:#BEB"><a href="/test/read.cgi/news/2000000004/l300/">4: 夜の話題 (40)</a></p>
<p style="background:#BEB"><a href="/test/read.cgi/news/2000000005//">５：no</a><a href="/x">x</a></p>
<p style="background:#BEB"><a href="/test/read.cgi/news/2000000006/l１0">１２:　全角の話題　(３)</a></p>
<p style="background:#BEB"><a href="/test/read.cgi/news/2000000007">7:　★ UPLIFT プレミアム・サービスのお知らせ　(2)</a></p>
</div></body></html>"""

THREAD = """<!DOCTYPE HTML><html><body>
<div class="clear post"><div class="post-header"><span class="date">2025/03/04(火) 08:00:00.00</span></div>
<div class="post-content">最初の書き込み</div></div>
<div class="clear post"><div class="post-header"><span class="date">2025/03/04(火) 09:30:00.00</span></div>
<div class="post-content">一行目<br>二行目 &amp; 記号</div></div>
<div class="clear post extra"><span class="date">2025/03/04(火) 10:00:00.00</span><div class="post-content">クラス違い</div></div>
<div class="clear post"><span class="date"></span><div class="post-content">日付なし</div></div>
<div class="clear post"><span class="date small">2025/03/04(火) 11:00:00.00</span><div class="post-content x">複数クラス</div></div>
<div class="clear post"><span class="date">2025/03/05(水) 00:01:00.00</span><div class="post-content">   </div></div>
</body></html>"""


def test_board_links_python():
    links = H.board_links(BOARD)
    assert [l["href"] for l in links] == ["/test/read.cgi/news/2000000001/l50", "/test/read.cgi/news/2000000002/",
                                          "/test/read.cgi/news/2000000003", "/test/read.cgi/news/2000000004/l300/",
                                          "/test/read.cgi/news/2000000005//", "/test/read.cgi/news/2000000006/l１0", "/test/read.cgi/news/2000000007"]
    assert links[0]["title"] == "1:  朝の話題 (12)"


def test_board_threads_clean_and_exclude(spark):
    pages = spark.createDataFrame([("news", "2025-03-04", BOARD), ("news", "2025-03-05", None)],
                                  "board_key string, target_date string, html string")
    out = X.board_threads(pages).orderBy("position").collect()
    assert [(r.position, r.thread_path, r.title) for r in out] == [
        (0, "/test/read.cgi/news/2000000001", "朝の話題"),
        (1, "/test/read.cgi/news/2000000002", "昼の話題"),
        (3, "/test/read.cgi/news/2000000004", "夜の話題"),
        (4, "/test/read.cgi/news/2000000005", "５：no"),
        (5, "/test/read.cgi/news/2000000006", "全角の話題"),
    ]


def test_thread_posts(spark):
    posts = H.thread_posts(THREAD)
    assert len(posts) == 5  # the 'clear post extra' div does not match the exact class string
    pages = spark.createDataFrame([("/t", THREAD), ("/empty", ""), ("/broken", "<div class='clear post'><span"),
                                   ("/none", None)], "thread_path string, html string")
    out = X.parse_thread_pages(pages).orderBy("thread_path", "post_no").collect()
    assert [(r.post_no, r.date_text, r.content) for r in out] == [
        (1, "2025/03/04(火) 08:00:00.00", "最初の書き込み"),
        (2, "2025/03/04(火) 09:30:00.00", "一行目\n二行目 & 記号"),
        (4, "2025/03/04(火) 11:00:00.00", "複数クラス"),
    ]


def test_html_text_lines(spark):
    df = spark.createDataFrame([("<p>Line 1<br>Line 2<br>Line 3</p><script>x=1</script>",)], "html string")
    assert df.select(H.html_text(F.col("html")).alias("t")).collect()[0].t == "Line 1\nLine 2\nLine 3"


def test_unclosed_paragraphs_nest_like_a_browser():
    root = H.parse("<article><p>one<p>two</article>")
    ps = [n for n in root.iter() if n.tag == "p"]
    assert [p.text() for p in ps] == ["one", "two"]


BASES = ["http://forum.test", "http://forum.test/", "https://forum.test/board/list", "https://forum.test/board/list/", "https://forum.test/b/l?p=2#top",
         "https://forum.test/a/../b/c", "https://forum.test?p=2", "https://u@forum.test:81/x/y", "https://forum.test/x;v=1/y", "HTTP://forum.test/x",
         "ftp://files.test/a/b", "board/list", "//forum.test/x", ""]
PATHS = ["", "/", "/t/7", "/t/7?s=1#p3", "t7", "t/7", "t7?u=/a/..", "../t7", "./t7", "a/../t7", "..", ".", "?s=1", "#p3", "?", "#", "//cdn.test/i", "http://o.test/z",
         "mailto:a@b.test", "t;v=1", "/t//7", "k:v", "é/ü", " t7", "t/."]


def test_build_url_follows_the_standard(spark):
    """Every base with every path against the standard library; an empty path ends with '/'."""
    from urllib.parse import urljoin

    rows = [(b, p) for b in BASES for p in PATHS] + [(None, "x"), ("http://forum.test", None)]
    df = spark.createDataFrame(rows, "base string, path string")
    for r in df.select("base", "path", U.build_url(F.col("base"), F.col("path")).alias("got")).collect():
        if r.base is None or r.path is None:
            assert r.got is None
            continue
        want = urljoin(r.base, r.path)
        assert r.got == (want + "/" if not r.path and not want.endswith("/") else want), (r.base, r.path)


def test_thread_id_and_validity(spark):
    cases = [
        ("https://forum.test/test/read.cgi/news/2000000007/", "2000000007", True),
        ("https://forum.test/test/read.cgi/news/2000000007?x=/1#y", "2000000007", True),
        ("/test/read.cgi/news/2000000008/l50", "2000000008", False),
        ("/test//read.cgi//news/2000000009", "2000000009", False),
        ("https://forum.test/test/other/news/3", None, True),
        ("https://forum.test/test/read.cgi/news", None, True),
        ("https://forum.test?read.cgi/a/b", None, True),
        ("forum.test", None, False), ("https://", None, False), ("two words", None, False), ("", None, False),
    ]
    df = spark.createDataFrame([(u,) for u, _, _ in cases], "url string")
    got = df.select(U.thread_id(F.col("url")).alias("id"), U.is_valid_url(F.col("url")).alias("ok")).collect()
    assert [(r.id, r.ok) for r in got] == [(i, ok) for _, i, ok in cases]


def test_dates(spark):
    df = spark.createDataFrame([("2024-01-08 02:00:00",), ("2024-01-09 20:00:00",)], "ts string")
    df = df.withColumn("ts", F.to_timestamp("ts"))
    ws, we = Dt.previous_week(F.to_date("ts"))
    out = df.select(Dt.target_date_jst(F.col("ts")).alias("t"), ws.alias("ws"), we.alias("we"),
                    Dt.day_prefix(F.col("ts")).alias("p"), Dt.post_date_text(F.col("ts")).alias("txt")).collect()
    assert [str(r.t) for r in out] == ["2024-01-07", "2024-01-09"]
    assert [(str(r.ws), str(r.we)) for r in out] == [("2024-01-01", "2024-01-07")] * 2
    assert out[0].p == "2024/01/08(" and out[0].txt == "2024/01/08(月) 02:00:00.00"


def test_crawl_cutoff(spark):
    # Board order T1 (target), T2 (next day only), T3 (neither), T4 (target), T5 page missing before T3.
    listing = spark.createDataFrame(
        [("b", "2025-03-04", 0, "/T1", True), ("b", "2025-03-04", 1, "/T2", True), ("b", "2025-03-04", 2, "/T5", False),
         ("b", "2025-03-04", 3, "/T3", True), ("b", "2025-03-04", 4, "/T4", True)],
        "board_key string, target_date string, position int, thread_path string, page_ok boolean",
    ).withColumn("target_date", F.col("target_date").cast("date"))
    posts = spark.createDataFrame(
        [("/T1", 1, "2025/03/04(火) 10:00:00.00", "a"), ("/T1", 2, "2025/03/03(月) 10:00:00.00", "old"),
         ("/T2", 1, "2025/03/05(水) 01:00:00.00", "b"), ("/T3", 1, "2025/03/01(土) 01:00:00.00", "c"),
         ("/T4", 1, "2025/03/04(火) 11:00:00.00", "d")],
        "thread_path string, post_no int, date_text string, content string")
    out = X.collect_target_posts(listing, posts).collect()
    assert [(r.thread_path, r.content) for r in out] == [("/T1", "a")]


def test_latest_posts(spark):
    df = spark.createDataFrame([("/t", i) for i in range(1, 11)], "thread_path string, post_no int")
    assert sorted(r.post_no for r in X.latest_posts(df, 3).collect()) == [8, 9, 10]
    many = spark.range(1, 1001).select(F.lit("/t").alias("thread_path"), F.col("id").cast("int").alias("post_no"))
    assert X.latest_posts(many).count() == 1000  # no limit unless asked for


def _thread_page(posts):
    body = "".join(f'<div class="clear post"><span class="date">{d}</span><div class="post-content">{c}</div></div>'
                   for d, c in posts)
    return f"<html><body>{body}</body></html>"


def test_collect_posts_end_to_end(spark, tmpdir_path):
    import os

    from wordtide.plans.collect import collect_posts
    from wordtide.sources.pages import read_page_files

    board = ("<html><body>"
             + "".join(f'<p style="background:#BEB"><a href="/test/read.cgi/news/{i}/l50">{i}: t{i} ({i})</a></p>'
                       for i in range(1, 6)) + "</body></html>")
    d0, d1, dx = "2025/03/04(火) 10:00:00.00", "2025/03/05(水) 01:00:00.00", "2025/03/01(土) 01:00:00.00"
    threads = {
        1: [(d0, "一"), (dx, "古い")],
        2: [(d1, "翌日だけ")],
        # 3 is missing (not fetched): skipped, does not stop the scan
        4: [(d0, "四"), (d0, "四の二")],
        5: [(dx, "止まる")],
    }
    folder = os.path.join(tmpdir_path, "pages")
    os.makedirs(folder)
    for i, posts in threads.items():
        with open(os.path.join(folder, f"{i}.html"), "wb") as f:
            f.write(_thread_page(posts).encode("shift_jis"))
    files = read_page_files(spark, folder, glob="*.html")
    thread_pages = files.select(
        F.lit("news").alias("board_key"), F.lit("2025-03-04").cast("date").alias("target_date"),
        F.concat(F.lit("https://host.example/test/read.cgi/news/"),
                 F.regexp_extract("url", r"/(\d+)\.html$", 1), F.lit("/l300")).alias("url"), "html")
    boards = spark.createDataFrame([("news", "2025-03-04", board)], "board_key string, target_date string, html string") \
        .withColumn("target_date", F.col("target_date").cast("date"))
    out = collect_posts(boards, thread_pages).orderBy("thread_path", "post_no").collect()
    assert [(r.thread_path, r.content) for r in out] == [
        ("/test/read.cgi/news/1", "一"), ("/test/read.cgi/news/4", "四"), ("/test/read.cgi/news/4", "四の二")]
    assert str(out[0].date) == "2025-03-04"


def test_refetched_threads_are_not_counted_twice(spark):
    """One thread fetched on two days: each crawl reads its own copy, numbered from its own first post."""
    from wordtide.plans.collect import collect_posts

    d1, d2 = "2025/03/04(火) 10:00:00.00", "2025/03/05(水) 10:00:00.00"
    board = '<p style="background:#BEB"><a href="/test/read.cgi/news/1/l50">1: t (3)</a></p>'
    boards = spark.createDataFrame([("news", "2025-03-04", board), ("news", "2025-03-05", board)], "board_key string, target_date string, html string") \
        .withColumn("target_date", F.col("target_date").cast("date"))
    url = "https://host.example/test/read.cgi/news/1/"
    pages = spark.createDataFrame(
        [("news", "2025-03-04", url, _thread_page([(d1, "a"), (d1, "b")])), ("news", "2025-03-05", url, _thread_page([(d1, "b"), (d2, "c"), (d2, "d")]))],
        "board_key string, target_date string, url string, html string").withColumn("target_date", F.col("target_date").cast("date"))
    got = sorted((str(r.date), r.post_no, r.content) for r in collect_posts(boards, pages).collect())
    assert got == [("2025-03-04", 1, "a"), ("2025-03-04", 2, "b"), ("2025-03-05", 2, "c"), ("2025-03-05", 3, "d")]
    newest = sorted((str(r.date), r.post_no) for r in collect_posts(boards, pages, max_posts=1).collect())
    assert newest == [("2025-03-04", 2), ("2025-03-05", 3)]


def test_crawl_meets_only_the_days_it_asks_for(spark):
    """A long thread crawled on many days: the join sees (thread, day) pairs, not days x posts."""
    posts = spark.range(600).select(F.lit("/T").alias("thread_path"), F.col("id").cast("int").alias("post_no"),
                                    Dt.post_date_text(F.date_add(F.lit("2025-01-01"), (F.col("id") / 20).cast("int")).cast("timestamp")).alias("date_text"),
                                    F.lit("x").alias("content"))
    listing = spark.range(30).select(F.lit("b").alias("board_key"), F.date_add(F.lit("2025-01-01"), F.col("id").cast("int")).alias("target_date"),
                                     F.lit(0).alias("position"), F.lit("/T").alias("thread_path"), F.lit(True).alias("page_ok"))
    out = X.collect_target_posts(listing, posts)
    assert out.count() == 600 and out.groupBy("date").count().where("count <> 20").count() == 0


def test_listing_of_days_equals_listing_of_rows(spark):
    from wordtide.functions import dates as Dt

    base = F.lit("2025-01-01").cast("date")
    day = F.date_add(base, (F.col("id") * 7 % 11).cast("int"))
    posts = spark.range(60).select(F.concat(F.lit("/"), F.col("id") % 9).alias("thread_path"), F.col("id").cast("int").alias("post_no"),
                                   Dt.post_date_text(day.cast("timestamp")).alias("date_text"), F.lit("x").alias("content"))
    rows = spark.range(9).select(F.lit("b").alias("board_key"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(12)), lambda i: F.date_add(base, i))).alias("target_date"),
                                 F.col("id").alias("position"), F.concat(F.lit("/"), F.col("id")).alias("thread_path"),
                                 (F.col("id") % 4 != 3).alias("page_ok"))
    packed = rows.groupBy("board_key", "position", "thread_path", "page_ok").agg(F.collect_list("target_date").alias("target_dates"))
    kept = [sorted(map(tuple, X.collect_target_posts(x, posts).collect())) for x in (rows, packed)]
    assert kept[0] == kept[1] and kept[0]
    # by the rule itself: per crawl the fetched threads in order until one has no post of the day or the next
    have = {(p.thread_path, p.date_text[:10].replace("/", "-")) for p in posts.collect()}
    want = 0
    for i in range(13):
        d, e = (str(datetime.date(2025, 1, 1) + datetime.timedelta(days=i + k)) for k in (0, 1))
        for t in range(9):
            if t % 4 == 3:
                continue
            if (f"/{t}", d) not in have and (f"/{t}", e) not in have:
                break
            want += sum(p.thread_path == f"/{t}" and p.date_text[:10].replace("/", "-") == d for p in posts.collect())
    assert want == len(kept[0])


def test_listing_of_rows_that_repeat(spark):
    posts = spark.createDataFrame([("/T", 1, "2025/03/04(火) 10:00:00.00", "a")], "thread_path string, post_no int, date_text string, content string")
    row = ("b", datetime.date(2025, 3, 4), 0, "/T", True)
    listing = spark.createDataFrame([row, row], "board_key string, target_date date, position int, thread_path string, page_ok boolean")
    assert X.collect_target_posts(listing, posts).count() == 2
