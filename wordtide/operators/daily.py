"""Daily aggregation (A1-A12): posts -> daily term stats and per-run metrics.

One pass over the posts makes the counts of every (date, board, term):

  1. tokens are normalised inside their array, so no token row is joined to a vocabulary;
  2. each post yields a row per token, of which the first of its kind in the sorted array is the hit;
  3. posts are brought together by (date, board, thread); the terms of a thread with one post that day are its thread's
     hits already, so they are summed per (date, board, term) at once, map-side;
  4. (date, board, thread, term) -> posts, occurrences        (the threads with several posts that day)
  5. (date, board, term)         -> post_hits, thread_hits, occurrences

The term NULL stands for the posts themselves: its post_hits are the posts, its thread_hits the threads
and its occurrences the tokenizer failures (A1). The term '' collects the tokens that normalise to nothing.
The dictionary is joined at the (date, board, term) grain, where a word has one row per day and board however
often it occurs, and the metrics (A4) are sums over the same table.

Where only the metrics are asked for, no term is counted: sizes of the posts' arrays are summed per thread and day
(``day_totals``), with the blocked words as a filter inside the array.
"""

from __future__ import annotations

from functools import cached_property
from typing import Callable, Iterable, Optional

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordtide.functions.text import nfkc, normalize_after_nfkc, normalize_tokens
from wordtide.operators import segment, tables, terms as T

DAY = ["date", "board_key"]
# Blocked words up to this many are a filter inside the token array; more are joined to the counts.
BLOCKED_LITERALS = 10_000


def _entries(rows: DataFrame, items: Column, name: str, keep: list[str]) -> DataFrame:
    """Per post: one row per item (occ 1; hit 1 where it is the first of its kind), and NULL for the post itself
    (occ 1 if the tokenizer failed). ``items`` NULL is a failure; its elements are not NULL. Equal items stand together in
    the sorted array, after the NULL. A row is made when the array is unrolled: arrays of structs would be interpreted.
    The array is never empty; with ``_outer`` Spark does not send a filter that says so below the joins."""
    none = F.array().cast("array<string>")
    found = F.sort_array(F.concat(F.array(F.lit(None).cast("string")), F.coalesce("_s", none)))
    rows = rows.select(*keep, items.alias("_s")).select(*keep, F.col("_s").isNull().alias("_failed"), found.alias("_s"))
    rows = rows.select(*keep, "_failed", "_s", F.posexplode_outer("_s").alias("_i", name))
    post, again = F.col("_i") == 0, F.col(name).eqNullSafe(F.get("_s", F.col("_i") - 1))
    return rows.select(*keep, name, F.when(post | ~again, 1).otherwise(0).cast("long").alias("hit"),
                       F.when(~post | F.col("_failed"), 1).otherwise(0).cast("long").alias("occ"))


def _terms_of(tok: DataFrame) -> DataFrame:
    """(date, board_key, thread_path, terms): normalised tokens per post, NULL after a tokenizer failure. Posts that bring
    their ``terms`` (``terms.text_terms`` made where a text is stored once for many posts) keep them."""
    terms = F.col("terms") if "terms" in tok.columns else normalize_tokens(F.col("tokens"))
    return tok.select(*DAY, "thread_path", terms.alias("terms"))


def by_day(per_thread: DataFrame) -> DataFrame:
    """(date, board, term) counts of (date, board, thread, term) rows, at most one a key."""
    return per_thread.groupBy(*DAY, "term").agg(
        F.sum("hit").alias("post_hits"), F.count_if(F.col("hit") > 0).alias("thread_hits"), F.sum("occ").alias("occurrences"))


def merge_counts(parts: DataFrame) -> DataFrame:
    """One row per (date, board, thread, term): the counts of any posts add up, whichever batch they came in."""
    return parts.groupBy(*DAY, "thread_path", "term").agg(F.sum("hit").alias("hit"), F.sum("occ").alias("occ"))


def term_counts(tok: DataFrame, words: Optional[DataFrame] = None) -> DataFrame:
    """(date, board_key, term, post_hits, thread_hits, occurrences); see the module text for the terms NULL and ''.

    Posts are shuffled, not their tokens, by a bucket of their thread and day. A key per (thread, term) is made only for
    threads with several posts on a day; the buckets keep it in the task that has the thread, without a second shuffle."""
    if words is not None:
        return by_day(thread_counts(tok, words))
    bucket = F.pmod(F.xxhash64(*DAY, "thread_path"), F.lit(T.id_buckets(tok.sparkSession)))
    rows = _terms_of(tok).withColumn("thread_path_bucket", bucket).repartition("thread_path_bucket")
    posts = F.count(F.lit(1)).over(Window.partitionBy(*DAY, "thread_path", "thread_path_bucket"))
    rows = rows.withColumn("_lone", posts == 1).withColumn("thread_path", F.when(~F.col("_lone"), F.col("thread_path")))
    key = ["thread_path_bucket", *DAY, "thread_path", "_lone"]
    rows = _entries(rows, F.col("terms"), "term", key)
    rows = rows.groupBy(*key, "term").agg(F.sum("hit").alias("hit"), F.sum("occ").alias("occ"))
    threads = F.when(F.col("_lone"), F.col("hit")).otherwise((F.col("hit") > 0).cast("long"))
    return rows.groupBy(*DAY, "term").agg(
        F.sum("hit").alias("post_hits"), F.sum(threads).alias("thread_hits"), F.sum("occ").alias("occurrences"))


def thread_counts(tok: DataFrame, words: Optional[DataFrame] = None) -> DataFrame:
    """(date, board_key, thread_path, term, hit, occ): posts that hold the term and its occurrences, per thread.

    A post counts once for a term however often it holds it; identical posts count separately (A2/A3).
    ``words`` (surface, noun, times) says which nouns a surface stands for (T2): itself where a noun list
    tags it, or the nouns that it is segmented into. Other surfaces are no tokens.
    """
    if words is not None:
        return _word_counts(tok, words)
    rows = _terms_of(tok)
    rows = _entries(rows, F.col("terms"), "term", [*DAY, "thread_path"])
    return merge_counts(rows)


def noun_list(lexicon: DataFrame) -> DataFrame:
    """(surface, noun, times) of a (surface, pos) lexicon: its nouns stand for themselves."""
    return T.nouns(lexicon).select("surface", F.col("surface").alias("noun"), F.lit(1).cast("long").alias("times"))


def _word_counts(tok: DataFrame, words: DataFrame) -> DataFrame:
    """``thread_counts`` where surfaces are joined to ``words``: posts are reduced to (post, surface) first. A surface that
    most posts hold is split by AQE's skew join. The list is joined as it is: copies of it made here would not be in
    the size Spark estimates, so it would send many times its broadcast limit through the driver."""
    post = [*DAY, "thread_path", "post_key"]
    rows = _entries(tok, F.filter("tokens", lambda t: t != ""), "surface", post)
    rows = rows.groupBy(*post, "surface").agg(F.sum("hit").alias("hit"), F.sum("occ").alias("occ"))
    found = rows.where("surface IS NOT NULL").join(words, "surface")
    found = found.select(*post, normalize_after_nfkc(nfkc(F.col("noun"))).alias("term"), "hit", (F.col("occ") * F.col("times")).alias("occ"))
    # two spellings of a term in one post count once; identical posts share the key and have the same spellings
    found = found.groupBy(*post, "term").agg(F.max("hit").alias("hit"), F.sum("occ").alias("occ"))
    posts = rows.where("surface IS NULL").select(*post, F.lit(None).cast("string").alias("term"), "hit", "occ")
    return merge_counts(found.unionByName(posts).drop("post_key"))


def is_term() -> Column:
    return F.col("term").isNotNull() & (F.col("term") != "")


def term_stats(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """A2/A3: (date, board_key, term_id, normalized, post_hits, thread_hits) of the terms that are not blocked."""
    t = terms.where(~F.coalesce("is_blocked", F.lit(False))).select("normalized", "term_id")
    return counts.where(is_term()).withColumnRenamed("term", "normalized").join(t, "normalized").select(
        *DAY, "term_id", "normalized", "post_hits", "thread_hits")


TOTALS = ["fetched_threads", "fetched_posts", "parsed_posts", "tokenize_fail_posts", "total_tokens", "filtered_tokens"]


def day_metrics(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """A1 and A4 per (date, board): threads, posts, failures, tokens, filtered tokens (empty or blocked)."""
    blocked = terms.where("is_blocked").select(F.col("normalized").alias("term"), F.lit(True).alias("_blocked"))
    c = counts.join(blocked, "term", "left")
    post, token = F.col("term").isNull(), F.col("term").isNotNull()

    def total(cond, col):
        return F.coalesce(F.sum(F.when(cond, F.col(col))), F.lit(0).cast("long"))

    sums = [total(post, "thread_hits"), total(post, "post_hits"), total(post, "post_hits"), total(post, "occurrences"), total(token, "occurrences"),
            total(token & ((F.col("term") == "") | F.col("_blocked")), "occurrences")]
    return c.groupBy(*DAY).agg(*[x.alias(n) for x, n in zip(sums, TOTALS)])


def day_totals(tok: DataFrame, blocked: Iterable[str] = ()) -> DataFrame:
    """``day_metrics`` straight from the posts, for blocked words given as a list: no token becomes a row."""
    blocked = list(blocked)
    rows = _terms_of(tok)
    none = F.lit(0).cast("long")
    drop = F.filter("terms", lambda t: (t == "") | t.isin(blocked) if blocked else t == "")
    rows = rows.groupBy(*DAY, "thread_path").agg(
        F.count(F.lit(1)).alias("posts"), F.count_if(F.col("terms").isNull()).alias("failed"),
        F.coalesce(F.sum(F.size(F.filter("terms", lambda t: t.isNotNull()))), none).alias("tokens"), F.coalesce(F.sum(F.size(drop)), none).alias("dropped"))
    sums = [F.count(F.lit(1)), F.sum("posts"), F.sum("posts"), F.sum("failed"), F.sum("tokens"), F.sum("dropped")]
    return rows.groupBy(*DAY).agg(*[x.alias(n) for x, n in zip(sums, TOTALS)])


def filtered_rate(filtered: Column, total: Column) -> Column:
    """A5: filtered / total, 0.0 when total = 0."""
    return F.coalesce(F.try_divide(filtered.cast("double"), total.cast("double")), F.lit(0.0))


def duration_sec(start: Column, end: Column) -> Column:
    """Whole seconds between two timestamps, 0 when either is missing."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.coalesce(F.floor(micros / 1_000_000).cast("int"), F.lit(0))


def daily_metrics(targets: DataFrame, metrics: DataFrame) -> DataFrame:
    """A8 rows: one per target (date, board) even without posts (zeros).

    ``targets`` holds (date, board_key[, run_id, started_at, finished_at]).
    """
    t = targets
    for c, typ in (("run_id", "string"), ("started_at", "timestamp_ntz"), ("finished_at", "timestamp_ntz")):
        if c not in t.columns:
            t = t.withColumn(c, F.lit(None).cast(typ))
    j = t.select(*DAY, "run_id", "started_at", "finished_at").join(metrics, DAY, "left")

    def z(c):
        return F.coalesce(F.col(c), F.lit(0)).cast("long")

    return j.select(
        *DAY, "run_id",
        z("fetched_threads").alias("fetched_threads"),
        z("fetched_posts").alias("fetched_posts"),
        z("parsed_posts").alias("parsed_posts"),
        F.lit(0).cast("long").alias("parse_fail_posts"),
        z("tokenize_fail_posts").alias("tokenize_fail_posts"),
        z("filtered_tokens").alias("filtered_tokens"),
        z("total_tokens").alias("total_tokens"),
        filtered_rate(z("filtered_tokens"), z("total_tokens")).alias("filtered_rate"),
        duration_sec(F.col("started_at"), F.col("finished_at")).alias("duration_sec"),
        F.localtimestamp().alias("created_at"),
    )


class DailyResult:
    """Outputs of one daily job, each made when it is first asked for: the counts at (date, board, term) grain, the
    updated dictionary, term stats and metrics. See ``run_daily`` for the parameters."""

    def __init__(self, tok, stored, targets, words, prepare, keep, block_words, block_reason):
        self._tok, self._stored, self._targets, self._words = tok, stored, targets, words
        self._prepare, self._keep, self._block, self._reason = prepare, keep, list(block_words), block_reason

    @cached_property
    def counts(self) -> DataFrame:
        return self._keep(term_counts(self._tok, self._words), "term-counts")

    @cached_property
    def terms(self) -> DataFrame:
        new = T.get_or_create_terms(self._stored, self.counts.where(is_term()).select(F.col("term").alias("normalized")))
        if self._block:
            new = T.block_by_text(new, self._block, self._reason)
        if self._prepare is not None:
            new = self._prepare(new)
        return self._keep(new, "dictionary")

    @cached_property
    def stats(self) -> DataFrame:
        return term_stats(self.counts, self.terms).withColumn("created_at", F.localtimestamp())

    def _blocked_words(self) -> Optional[list[str]]:
        """The blocked words as a list, if they are known without the dictionary and few."""
        if self._words is not None or self._prepare is not None:
            return None
        rows = self._stored.where("is_blocked").select("normalized").limit(BLOCKED_LITERALS + 1).collect()
        return [r.normalized for r in rows] + self._block if len(rows) <= BLOCKED_LITERALS else None

    @cached_property
    def totals(self) -> DataFrame:
        """A1/A4 per (date, board): from the counts where they are made anyway, else from the posts."""
        if "counts" not in self.__dict__ and (blocked := self._blocked_words()) is not None:
            return self._keep(day_totals(self._tok, blocked), "day-totals")
        return day_metrics(self.counts, self.terms)

    @cached_property
    def metrics(self) -> DataFrame:
        t = self._targets
        return daily_metrics(self.days() if t is None else t(self.days()) if callable(t) else t, self.totals)

    def days(self) -> DataFrame:
        """The (date, board) pairs that have posts."""
        if "counts" in self.__dict__:
            return self.counts.where("term IS NULL").select(*DAY)
        return self.totals.select(*DAY)


def run_daily(posts: DataFrame, terms: DataFrame, targets: Optional[Callable[[DataFrame], DataFrame] | DataFrame] = None,
              lexicon: Optional[DataFrame] = None,
              tokenizer: Optional[Callable[[Column], Column]] = None,
              prepare_terms: Optional[Callable[[DataFrame], DataFrame]] = None,
              materialize: Optional[Callable[[DataFrame, str], DataFrame]] = None,
              segmenter: Optional[Callable[[DataFrame], DataFrame]] = None,
              block_words: Iterable[str] = (), block_reason: Optional[str] = None) -> DailyResult:
    """T1 -> T3 -> D3 -> D6 -> A2/A3 and A4 for every (date, board) at once.

    ``stats`` has (date, board_key, term_id, normalized, post_hits, thread_hits,
    created_at); drop ``normalized`` before writing the declared table.
    ``targets`` are the (date, board) pairs that get metrics, or a function of the pairs with posts.
    ``block_words`` are blocked in the grown dictionary before it is applied; ``prepare_terms`` edits it in any way.
    ``materialize(df, name)`` (e.g. ``session.stage``) is applied to the day-grain counts and to the dictionary, so
    the posts are read once however many results are used.
    Posts with a column ``terms`` are not tokenised again, unless a tokenizer, lexicon or segmenter is given.
    ``lexicon`` keeps the surfaces it tags as nouns; ``segmenter`` (e.g. ``segment.segment`` with a lexicon and connection
    costs) cuts runs of letters into words, (run) -> (run, words), and the nouns among them count.
    """
    keep = materialize or (lambda df, name: df)
    tok, words = tokens_of(posts, lexicon, tokenizer, segmenter, keep)
    return DailyResult(tok, terms, targets, words, prepare_terms, keep, block_words, block_reason)


def tokens_of(posts: DataFrame, lexicon=None, tokenizer=None, segmenter=None, keep=lambda df, name: df) -> tuple[DataFrame, Optional[DataFrame]]:
    """(posts with tokens, the nouns that surfaces stand for or None), see ``run_daily``."""
    if tokenizer is not None:
        posts = posts.drop("terms")
    if segmenter is not None:
        tok = T.tokenize_posts(posts, segment.runs)
        runs = tok.select(F.explode("tokens").alias("run")).distinct()
        return tok, keep(segment.nouns_of_runs(segmenter(runs)), "segmented-runs")
    return T.tokenize_posts(posts, tokenizer), None if lexicon is None else noun_list(lexicon)


def run_merged(parts: DataFrame, terms: DataFrame, targets=None, prepare_terms=None, materialize=None,
               block_words: Iterable[str] = (), block_reason: Optional[str] = None) -> DailyResult:
    """A12 from stored ``thread_counts`` of any number of batches; parameters as in ``run_daily``."""
    keep = materialize or (lambda df, name: df)
    res = DailyResult(None, terms, targets, None, prepare_terms, keep, block_words, block_reason)
    res.counts = keep(by_day(merge_counts(parts)), "term-counts")
    return res


def top_terms_of_day(stats: DataFrame, limit: Optional[int] = None, offset: int = 0,
                     tie_col: str = "term_id") -> DataFrame:
    """A9 for every (date, board): ``post_hits`` desc, ``term_id`` asc as tie-break.

    ``limit`` None or 0 means all rows, and then the offset is ignored (as in the
    reference). See ``tables.ranked`` for how either is planned.
    """
    order = [F.desc("post_hits"), F.asc(tie_col)]
    if not limit:
        return tables.ranked(stats, DAY, order)
    return tables.ranked(stats, DAY, order, offset + limit).where(F.col("rank") > offset)


def metrics_lookup(metrics: DataFrame, date, board_key: str) -> DataFrame:
    """A10."""
    return metrics.where((F.col("date") == F.lit(date).cast("date")) & (F.col("board_key") == board_key)).limit(1)
