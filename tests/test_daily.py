"""Daily counting (FIXTURES §4) with an exact token list per post."""

from pyspark.sql import functions as F

from wordtide.operators import daily, terms as T


def pipe_tokens(c):
    """Test tokenizer: tokens separated by '|'; NULL content = tokenizer failure."""
    return F.filter(F.split(c, r"\|"), lambda x: x != "")


def run(spark, posts, block=(), terms=None):
    df = spark.createDataFrame(posts, "date string, board_key string, thread_path string, post_no int, content string")
    df = df.withColumn("date", F.col("date").cast("date"))
    prep = (lambda t: T.block_by_text(t, list(block), "spam")) if block else None
    targets = df.select("date", "board_key").distinct().unionByName(
        spark.createDataFrame([("2025-01-02", "prog")], "date string, board_key string")
        .withColumn("date", F.col("date").cast("date"))).distinct()
    res = daily.run_daily(df, terms if terms is not None else T.empty_terms(spark), targets=targets,
                          tokenizer=pipe_tokens, prepare_terms=prep)
    stats = {r.normalized: (r.post_hits, r.thread_hits) for r in res.stats.collect()}
    metrics = {(str(r.date), r.board_key): r for r in res.metrics.collect()}
    return res, stats, metrics


D = "2025-01-01"


def test_repeats_in_one_post_count_once(spark):
    _, stats, m = run(spark, [(D, "prog", "/t1", 1, "Python|Python|Python")])
    assert stats == {"python": (1, 1)}
    assert m[(D, "prog")].total_tokens == 3


def test_same_thread_two_posts(spark):
    _, stats, m = run(spark, [(D, "prog", "/t1", 1, "Python|プログラミング"), (D, "prog", "/t1", 2, "Python|開発")])
    assert stats["python"] == (2, 1)
    assert m[(D, "prog")].fetched_threads == 1 and m[(D, "prog")].fetched_posts == 2


def test_two_threads(spark):
    _, stats, m = run(spark, [(D, "prog", "/t1", 1, "alpha|beta"), (D, "prog", "/t2", 1, "gamma|delta")])
    assert len(stats) == 4 and m[(D, "prog")].fetched_threads == 2


def test_filtered_short_and_blocked(spark):
    _, stats, m = run(spark, [(D, "prog", "/t1", 1, "Python|a")])
    assert m[(D, "prog")].filtered_tokens == 1 and m[(D, "prog")].filtered_rate == 0.5
    _, stats, m = run(spark, [(D, "prog", "/t1", 1, "Python|blocked")], block=["blocked"])
    assert stats == {"python": (1, 1)} and m[(D, "prog")].filtered_tokens == 1


def test_empty_and_failed_posts(spark):
    _, stats, m = run(spark, [(D, "prog", "/t1", 1, ""), (D, "prog", "/t1", 2, None)])
    r = m[(D, "prog")]
    assert stats == {} and r.parsed_posts == 2 and r.tokenize_fail_posts == 1 and r.total_tokens == 0
    assert r.filtered_rate == 0.0 and r.parse_fail_posts == 0


def test_target_without_posts_gets_zero_metrics(spark):
    _, _, m = run(spark, [(D, "prog", "/t1", 1, "Python")])
    r = m[("2025-01-02", "prog")]
    assert (r.fetched_posts, r.fetched_threads, r.total_tokens, r.filtered_rate) == (0, 0, 0, 0.0)


def test_identical_copies_count_separately(spark):
    posts = [(D, "prog", "/t1", 1, "Python|Java")] * 3 + [(D, "prog", "/t1", 2, "python")]
    _, stats, m = run(spark, posts)
    assert stats["python"] == (4, 1) and stats["java"] == (3, 1)
    assert m[(D, "prog")].fetched_posts == 4 and m[(D, "prog")].total_tokens == 7


def test_two_surfaces_same_term_in_one_post(spark):
    _, stats, _ = run(spark, [(D, "prog", "/t1", 1, "Python|PYTHON|Ｐｙｔｈｏｎ")])
    assert stats == {"python": (1, 1)}


def test_dictionary_ids_dense_and_stable(spark):
    res, _, _ = run(spark, [(D, "prog", "/t1", 1, "alpha|beta|gamma|delta")])
    t1 = res.terms
    ids = sorted(r.term_id for r in t1.collect())
    assert ids == [1, 2, 3, 4]
    # Same term twice -> same id; a new one -> next id; blocks are not retroactive.
    res2, _, _ = run(spark, [(D, "prog", "/t1", 1, "alpha|epsilon")], terms=t1)
    t2 = {r.normalized: r.term_id for r in res2.terms.collect()}
    assert t2["alpha"] == {r.normalized: r.term_id for r in t1.collect()}["alpha"] and t2["epsilon"] == 5


def test_assign_ids_parallel_buckets(spark):
    df = spark.range(1000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("normalized"))
    out = T.assign_term_ids(df, F.lit(10).cast("long"), buckets=7)
    ids = sorted(r.term_id for r in out.collect())
    assert ids == list(range(11, 1011))


def test_update_blocked_overwrites_reason(spark):
    res, _, _ = run(spark, [(D, "prog", "/t1", 1, "spamword|fine")])
    t = T.block_by_text(res.terms, ["spamword"], "spam")
    row = T.get_by_normalized(t, "spamword").collect()[0]
    assert row.is_blocked and row.blocked_reason == "spam"
    upd = t.where("normalized = 'spamword'").select("term_id", F.lit(False).alias("is_blocked"))
    row = T.get_by_id(T.update_blocked(t, upd), row.term_id).collect()[0]
    assert row.is_blocked is False and row.blocked_reason is None


def test_lexicon_keeps_only_nouns(spark):
    df = spark.createDataFrame([(D, "prog", "/t1", 1, "猫|走る|犬")],
                               "date string, board_key string, thread_path string, post_no int, content string")
    df = df.withColumn("date", F.col("date").cast("date"))
    lex = spark.createDataFrame([("猫", "名詞"), ("犬", "名詞"), ("走る", "動詞")], "surface string, pos string")
    res = daily.run_daily(df, T.empty_terms(spark), tokenizer=pipe_tokens, lexicon=lex)
    # Single-character nouns are filtered by normalisation but still counted as tokens.
    m = res.metrics.collect()[0]
    assert m.total_tokens == 2 and m.filtered_tokens == 2 and res.stats.count() == 0


def test_top_terms_limit_offset(spark):
    res, _, _ = run(spark, [(D, "prog", "/t1", i, "aa|bb" if i < 3 else "aa") for i in range(5)])
    top = daily.top_terms_of_day(res.stats, limit=1, offset=1, tie_col="normalized").collect()
    assert [r.normalized for r in top] == ["bb"]
    assert daily.top_terms_of_day(res.stats, limit=0, offset=5).count() == 2


def test_one_pass_over_the_posts_and_no_join_on_tokens(spark):
    """With all broadcasts off, no exchange is keyed by a token and the counts scan the posts once."""
    import re

    posts = spark.range(1000).select(F.lit(D).cast("date").alias("date"), F.lit("b").alias("board_key"), F.col("id").cast("string").alias("thread_path"),
                                     F.lit(1).alias("post_no"), F.concat(F.lit("every post has "), F.col("id")).alias("content"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = daily.term_counts(T.tokenize_posts(posts))
        plan = counts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    # (date, board, term) and (date, board, thread, term); date and board are literals here
    assert len(keys) == 2 and "thread_path" in keys[1] and "Join" not in plan
    got = {r.term: (r.post_hits, r.thread_hits, r.occurrences) for r in counts.where("term IN ('every', 'post')").collect()}
    assert got == {"every": (1000, 1000, 1000), "post": (1000, 1000, 1000)}


def test_counts_beyond_32_bits(spark):
    counts = spark.createDataFrame([(D, "b", None, 5_000_000_000, 3, 0), (D, "b", "word", 4_000_000_000, 2, 6_000_000_000), (D, "b", "", 1, 1, 7)],
                                   "date string, board_key string, term string, post_hits long, thread_hits long, occurrences long")
    terms = spark.createDataFrame([(1, "word", False)], "term_id long, normalized string, is_blocked boolean")
    m = daily.daily_metrics(counts.select("date", "board_key").distinct(), daily.day_metrics(counts, terms)).collect()[0]
    assert (m.fetched_posts, m.total_tokens, m.filtered_tokens) == (5_000_000_000, 6_000_000_007, 7)
    assert daily.term_stats(counts, terms).collect()[0].post_hits == 4_000_000_000


def test_noun_list_is_not_multiplied(spark):
    # copies made in the plan are missing from Spark's size estimate, so the broadcast outgrew the driver
    posts = spark.createDataFrame([("b", "t", 1, "alpha beta alpha")], "board_key string, thread_path string, post_no int, content string")
    tok = T.tokenize_posts(posts.withColumn("date", F.lit("2025-01-01").cast("date")))
    words = spark.createDataFrame([("alpha", "alp", 2), ("alpha", "ha", 1)], "surface string, noun string, times long")
    out = daily.thread_counts(tok, words)
    assert "Generate explode" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.term, r.hit, r.occ) for r in out.collect()} == {(None, 1, 0), ("alp", 1, 4), ("ha", 1, 2)}


def test_posts_are_unrolled_in_compiled_code(spark):
    rows = [(D, "prog", "/t1", ["cd", "ab", "cd"]), (D, "prog", "/t1", ["ab"]), (D, "prog", "/t2", []), (D, "prog", "/t3", None)]
    tok = spark.createDataFrame(rows, "date string, board_key string, thread_path string, tokens array<string>")
    counts = daily.thread_counts(tok)
    got = {(r.thread_path, r.term): (r.hit, r.occ) for r in counts.collect()}
    assert got == {("/t1", None): (2, 0), ("/t1", "ab"): (2, 2), ("/t1", "cd"): (1, 2), ("/t2", None): (1, 0), ("/t3", None): (1, 1)}
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate posexplode" in plan and "inline" not in plan, plan


def test_posts_are_dealt_over_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    from wordtide.session import path_bytes
    from wordtide.sources import adapters as A

    spark.range(5000).selectExpr("id AS conv_id", "0 AS turn", "'user' AS role", "uuid() AS text").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    size, cores = path_bytes(spark, f"{tmp_path}/conversations.parquet"), spark.sparkContext.defaultParallelism
    monkeypatch.setattr(A, "TASK_BYTES", size // (3 * cores) + 1)
    posts = A.posts_from_conversations(spark, str(tmp_path))
    assert 2 * cores < posts.rdd.getNumPartitions() <= 3 * cores and posts.count() == 5000
    monkeypatch.setattr(A, "MOST_WAVES", 2)
    assert A.posts_from_conversations(spark, str(tmp_path)).rdd.getNumPartitions() == 2 * cores


def test_posts_are_shuffled_by_thread_and_lone_threads_need_no_key_per_term(spark):
    """The counts equal those of (thread, term) rows, on threads with one post, several posts, copies and NULL keys."""
    rows = [(D, "b", "t1", ["x1", "y1", "x1"]), (D, "b", "t1", ["x1"]), (D, "b", "t1", ["x1"]), (D, "b", "t2", ["x1", ""]), (D, "c", "t1", ["x1", "x1"]),
            ("2025-01-02", "b", "t1", ["X1", "x1"]), (D, "b", None, ["y1"]), (D, "b", None, ["y1"]), (D, None, "t4", ["z1"]), (None, "b", "t5", ["z1", None]),
            (D, "b", "t6", None), (D, "b", "t7", []), (D, "b", "t8", None), (D, "b", "t8", ["ｘ１"])] + [(D, "b", "hot", ["x1", "w%d" % (i % 3)]) for i in range(6000)]
    tok = spark.createDataFrame(rows, "date string, board_key string, thread_path string, tokens array<string>")
    counts = daily.term_counts(tok)
    assert sorted(map(str, counts.collect())) == sorted(map(str, daily.by_day(daily.thread_counts(tok)).collect()))
    got = {(r.date, r.board_key, r.term): (r.post_hits, r.thread_hits, r.occurrences) for r in counts.collect()}
    assert got[D, "b", "x1"] == (6005, 4, 6006) and got[D, "b", None] == (6009 + 1, 7, 2) and got[D, "b", "y1"] == (3, 2, 3)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("posexplode") < plan.rindex("hashpartitioning(thread_path_bucket"), plan  # posts cross the shuffle, not tokens


def test_terms_are_made_once_per_part(spark):
    from wordtide.sources import adapters as A

    sf = "/root/testdata/sf0.001"
    posts = A.posts_from_lineitem(spark, sf, terms=True)
    counts = daily.term_counts(*daily.tokens_of(posts))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Join") < plan.index("regexp_extract_all") and plan.index("Join") < plan.index("ArrowEvalPython"), plan
    plain = daily.term_counts(*daily.tokens_of(A.posts_from_lineitem(spark, sf)))
    assert counts.exceptAll(plain).isEmpty() and plain.exceptAll(counts).isEmpty()
    # a tokenizer that is given decides, whatever terms the posts bring
    tok, _ = daily.tokens_of(posts, tokenizer=pipe_tokens)
    assert "terms" not in tok.columns


def test_a_large_part_table_is_not_broadcast(spark, monkeypatch):
    from wordtide.sources import adapters as A

    monkeypatch.setattr(A, "MOST_BROADCAST", 0)
    plan = A.posts_from_lineitem(spark, "/root/testdata/sf0.001", terms=True)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan, plan
