"""Dictionary segmentation of unspaced text with parts of speech (T1, T2), in DataFrame functions.

A lexicon (surface, pos, cost) and a table of connection costs (left_pos, right_pos, cost) give every way to cut a run of
letters into words a cost: the words' costs and those of neighbouring parts of speech, sentence ends
included. The cheapest way is taken, so one surface can be a noun after one word and a verb after another. Code points that no
word covers are unknown words of one code point each; those that end up side by side become one word, a noun.

Plan. Only distinct runs are segmented. Their substrings up to the longest surface are joined to the lexicon; the
hits of a run, gathered in one array in order of their ends, are folded by ``aggregate``: the state of a word is the least cost
of reaching it and the index of its predecessor. A second fold walks back from the end. Everything stays in
the JVM. A run has at most ``MAX_RUN`` code points (longer stretches of letters are cut there), so the
array of a run is bounded by that and by the number of surfaces that can begin at one place.

Ties: of equal costs the predecessor that ends the same and begins first (the longest word) wins, then the one whose
tag comes first (unknown, then the lexicon's tags in order of their names).
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordtide.functions.beta import let
from wordtide.operators.terms import NOUN_POS

#: A run is cut after so many code points (RE2, the oracle's engine, repeats no more often).
MAX_RUN = 1000
#: Letters that form one run: Japanese scripts together, Latin letters with digits.
RUN_PATTERN = rf"[\p{{IsLatin}}\p{{Nd}}]{{1,{MAX_RUN}}}|[\p{{IsHan}}\p{{IsHiragana}}\p{{IsKatakana}}ー]{{1,{MAX_RUN}}}"
RUN_PATTERN_RE2 = rf"[\p{{Latin}}\p{{Nd}}]{{1,{MAX_RUN}}}|[\p{{Han}}\p{{Hiragana}}\p{{Katakana}}ー]{{1,{MAX_RUN}}}"
UNKNOWN_COST = 4000
#: Name of the sentence ends in the connection table, and of unknown words.
EDGE, UNKNOWN = "BOS/EOS", "UNKNOWN"


def runs(content: Column) -> Column:
    """Runs of letters in text order; null and empty texts have none."""
    return F.coalesce(F.regexp_extract_all(content, F.lit(RUN_PATTERN), F.lit(0)), F.array().cast("array<string>"))


class Tags:
    """Tags of a lexicon numbered from 2 (0 are the sentence ends, 1 unknown words) with their connection costs.

    Both tables are small: one row per part of speech and one per pair of them.
    """

    LIMIT = 1024

    def __init__(self, lexicon: DataFrame, connections: Optional[DataFrame], default: int = 0):
        found = [r.pos for r in lexicon.select("pos").where("pos IS NOT NULL").distinct().limit(self.LIMIT + 1).collect()]
        if len(found) > self.LIMIT:
            raise ValueError(f"a lexicon has at most {self.LIMIT} parts of speech")
        self.names = [EDGE, UNKNOWN, *sorted(found)]
        number = {n: i for i, n in enumerate(self.names)}
        self.costs = [default] * len(self.names) ** 2
        if connections is not None:
            rows = connections.where(F.col("left_pos").isin(self.names) & F.col("right_pos").isin(self.names))
            for r in rows.groupBy("left_pos", "right_pos").agg(F.min("cost").alias("cost")).collect():
                self.costs[number[r.left_pos] * len(self.names) + number[r.right_pos]] = r.cost

    def number(self, pos: Column) -> Column:
        out = F.lit(None).cast("int")
        for i, n in reversed(list(enumerate(self.names))):
            out = F.when(pos == n, i).otherwise(out)
        return out

    def cost(self, left: Column, right: Column) -> Column:
        table = F.array(*[F.lit(c).cast("long") for c in self.costs])
        return F.element_at(table, left * len(self.names) + right + 1)

    def spoken(self, tag: Column, unknown_pos: str) -> Column:
        """The name of a tag number; unknown words have ``unknown_pos``."""
        return F.element_at(F.array(*[F.lit(unknown_pos if n == UNKNOWN else n) for n in self.names]), tag + 1)


def candidates(texts: DataFrame, lexicon: DataFrame, tags: Tags) -> DataFrame:
    """(run, known): the lexicon's words in each run as structs (e, s, t, cost), positions from 1, ``e`` one past the end."""
    words = lexicon.where((F.length("surface") > 0) & F.col("pos").isNotNull()).groupBy("surface", "pos").agg(F.min("cost").alias("cost"))
    words = words.select("surface", tags.number(F.col("pos")).alias("t"), F.col("cost").cast("long").alias("cost"))
    longest = words.agg(F.max(F.length("surface")).alias("m")).first().m or 0
    at = texts.select("run", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("s"))
    sizes = F.sequence(F.lit(1), F.least(F.lit(max(longest, 1)), F.length("run") - F.col("s") + 1))
    parts = at.select("run", "s", F.explode(sizes).alias("n")).select("run", "s", "n", F.expr("substring(run, s, n)").alias("surface"))
    hits = parts.join(words, "surface").groupBy("run").agg(
        F.collect_list(F.struct((F.col("s") + F.col("n")).alias("e"), F.col("s").alias("s"), "t", "cost")).alias("known"))
    return texts.join(hits, "run", "left")


def segment(texts: DataFrame, lexicon: DataFrame, connections: Optional[DataFrame] = None, unknown_cost: int = UNKNOWN_COST,
            unknown_pos: str = NOUN_POS, default_connection: int = 0) -> DataFrame:
    """(run, words array<struct<surface, pos>>) for every distinct ``run`` of ``texts`` that is not empty."""
    tags = Tags(lexicon, connections, default_connection)
    texts = texts.select("run").where(F.length("run") > 0).distinct()
    # rows are small and the folds dear: a fixed number of tasks, whatever the bytes
    spark = texts.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = candidates(texts, lexicon, tags).repartition(tasks, "run")
    n = F.length("run")
    unknown = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(
        (i + 1).alias("e"), i.alias("s"), F.lit(1).alias("t"), F.lit(unknown_cost).cast("long").alias("cost")))
    empty = F.array().cast("array<struct<e: int, s: int, t: int, cost: bigint>>")
    rows = rows.select("run", F.array_sort(F.concat(F.coalesce("known", empty), unknown)).alias("spans"))

    def state(e, t, total, prev):
        return F.struct(e.cast("int").alias("e"), t.cast("int").alias("t"), total.cast("long").alias("total"), prev.cast("int").alias("prev"))

    def reach(states, x):
        """Append the cheapest way to reach the word x."""
        ways = F.transform(states, lambda a, i: F.when(a["e"] == x["s"], F.struct((a["total"] + tags.cost(a["t"], x["t"])).alias("total"), i.alias("prev"))))
        # of equal totals the lowest index
        return let(F.array_min(ways), lambda best: F.concat(states, F.array(state(x["e"], x["t"], best["total"] + x["cost"], best["prev"]))))

    none = F.array().cast("array<struct<s: int, e: int, t: int>>")

    def words(states):
        """Walk back from the end, join unknown words side by side, name the rest."""
        ends = F.transform(states, lambda a, i: F.when(
            a["e"] == F.length("run") + 1, F.struct((a["total"] + tags.cost(a["t"], F.lit(0))).alias("total"), i.alias("prev"))))

        def back(walk, i):
            def push(a):
                word = F.struct(F.get(states, a["prev"])["e"].alias("s"), a["e"].alias("e"), a["t"].alias("t"))
                return F.struct(a["prev"].alias("at"), F.concat(F.array(word), walk["path"]).alias("path"))
            return F.when(i == walk["at"], let(F.get(states, i), push)).otherwise(walk)

        walk = F.aggregate(F.sequence(F.size(states) - 1, F.lit(1), F.lit(-1)), F.struct(F.array_min(ends)["prev"].alias("at"), none.alias("path")), back)

        def merge(path, x):
            def put(last):
                both = F.coalesce((last["t"] == 1) & (x["t"] == 1), F.lit(False))
                grown = F.struct(last["s"].alias("s"), x["e"].alias("e"), x["t"].alias("t"))
                return F.when(both, F.concat(F.slice(path, 1, F.greatest(F.size(path) - 1, F.lit(0))), F.array(grown))).otherwise(F.concat(path, F.array(x)))
            return let(F.try_element_at(path, F.lit(-1)), put)

        return F.transform(F.aggregate(walk["path"], none, merge), lambda x: F.struct(
            F.col("run").substr(x["s"], x["e"] - x["s"]).alias("surface"), tags.spoken(x["t"], unknown_pos).alias("pos")))

    # one expression: a filter that Spark infers from a later explode repeats it, but never inside a lambda
    start = F.array(state(F.lit(1), F.lit(0), F.lit(0), F.lit(-1)))
    return rows.select("run", let(F.aggregate("spans", start, reach), words).alias("words"))


def nouns_of_runs(segmented: DataFrame, pos: str = NOUN_POS) -> DataFrame:
    """(surface, noun, times): the nouns of each run and how often it holds them; ``surface`` is the run."""
    # outer: no filter on the words' number is inferred, which would segment twice
    words = segmented.select(F.col("run").alias("surface"), F.explode_outer("words").alias("w"))
    return words.where(F.col("w.pos") == pos).groupBy("surface", F.col("w.surface").alias("noun")).agg(F.count(F.lit(1)).alias("times"))
