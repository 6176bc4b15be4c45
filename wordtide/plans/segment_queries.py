"""Registered queries of dictionary segmentation (T1, T2) with their DuckDB SQL.

The lexicon of the given tables: the short words of ``conversations`` (one to four letters; its longer words are made
of them without spaces, as in a script without spaces), and the words of part names, the last one a noun, the first one an
adjective. A short word's tags follow its letters: those that end in a vowel are nouns, the others verbs, and words of two letters
are both, so that only their neighbours decide.

The SQL is a dynamic programme of its own: one row per state, by recursion over the end position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.functions.dates import iso
from wordtide.functions.text import TOKEN_PATTERN_RE2
from wordtide.operators import segment as S
from wordtide.operators.terms import NOUN_POS
from wordtide.plans import oracle as O
from wordtide.plans import pipeline as P
from wordtide.session import stage
from wordtide.sources import adapters as A

# --- fixed values: parts of speech (verb, adjective) and what it costs that one follows another -------------------
VERB, ADJECTIVE = "動詞", "形容詞"
CONNECTIONS = [
    (S.EDGE, NOUN_POS, 100), (S.EDGE, VERB, 700), (S.EDGE, ADJECTIVE, 200),
    (NOUN_POS, NOUN_POS, 900), (NOUN_POS, VERB, 100), (NOUN_POS, ADJECTIVE, 700), (NOUN_POS, S.EDGE, 300),
    (VERB, NOUN_POS, 200), (VERB, VERB, 1200), (VERB, ADJECTIVE, 300), (VERB, S.EDGE, 100),
    (ADJECTIVE, NOUN_POS, 50), (ADJECTIVE, VERB, 900), (ADJECTIVE, ADJECTIVE, 400), (ADJECTIVE, S.EDGE, 800),
]
DEFAULT = 500  # beside unknown words
VOWELS = "aeiouéèêà"
# ------------------------------------------------------------------------------------------------------------------


def connections(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CONNECTIONS, "left_pos string, right_pos string, cost int")


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(surface, pos, cost): see the module text; longer words cost less per letter."""
    text = A.spread(A.table(spark, sf_dir, "conversations")).select(F.lower("text").alias("t"))
    word = text.select(F.explode(F.regexp_extract_all("t", F.lit(r"\p{IsLatin}+"), F.lit(0))).alias("surface")).where("length(surface) <= 4").distinct()
    vowel = F.substring("surface", -1, 1).isin(*VOWELS)
    both = F.length("surface") == 2
    cost = F.lit(1500) + 300 * F.length("surface")
    tags = F.filter(F.array(F.when(vowel | both, F.struct(F.lit(NOUN_POS).alias("pos"), cost.alias("cost"))),
                            F.when(~vowel | both, F.struct(F.lit(VERB).alias("pos"), cost.alias("cost")))), lambda x: x.isNotNull())
    short = word.select("surface", F.inline(tags))
    name = F.split("p_name", " ")
    part = A.table(spark, sf_dir, "part").select(F.explode(F.array(
        F.struct(F.element_at(name, -1).alias("surface"), F.lit(NOUN_POS).alias("pos"), F.lit(2000).alias("cost")),
        F.struct(F.element_at(name, 1).alias("surface"), F.lit(ADJECTIVE).alias("pos"), F.lit(2000).alias("cost")))).alias("x")).select("x.*")
    # nouns of part names are also used as verbs
    verbs = part.where(F.col("pos") == NOUN_POS).withColumn("pos", F.lit(VERB))
    return stage(short.unionByName(part).unionByName(verbs).groupBy("surface", "pos").agg(F.min("cost").alias("cost")), "lexicon")


def _segment(spark: SparkSession, sf_dir: str):
    return lambda runs: S.segment(runs, lexicon(spark, sf_dir), connections(spark), default_connection=DEFAULT)


def _shown(words):
    return F.array_join(F.transform(words, lambda w: F.concat(w["surface"], F.lit("/"), w["pos"])), " ")


def t1_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct run of letters of ``documents``, cut into words by the cheapest path."""
    docs = A.spread(A.table(spark, sf_dir, "documents")).select(F.lower("text").alias("t"))
    runs = docs.select(F.explode(S.runs(F.col("t"))).alias("run"))
    return _segment(spark, sf_dir)(runs).select("run", _shown("words").alias("words"))


def t2_pos_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names without the space, forwards and backwards: how often a word has which part of speech after which word's."""
    name = F.split("p_name", " ")
    runs = A.table(spark, sf_dir, "part").select(F.explode(F.array(
        F.array_join(name, ""), F.array_join(F.reverse(name), ""), F.array_join(F.concat(F.reverse(name), name), ""))).alias("run"))
    cut = _segment(spark, sf_dir)(runs)
    words = cut.select("run", "words", F.posexplode("words").alias("i", "w"))
    before = F.when(F.col("i") > 0, F.get("words", F.col("i") - 1)["pos"]).otherwise(S.EDGE)
    return words.groupBy(F.col("w.surface").alias("surface"), F.col("w.pos").alias("pos"), before.alias("after_pos")).agg(F.count(F.lit(1)).alias("n"))


def t1_segmented_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + T2 + A2/A3: daily counts of the nouns that segmentation finds in the posts of ``conversations``."""
    posts = A.posts_from_conversations(spark, sf_dir).withColumn("content", F.lower("content"))
    res = P.daily_for_posts(spark, posts, segmenter=_segment(spark, sf_dir))
    return res.stats.select(iso(F.col("date")).alias("date"), "board_key", F.col("normalized").alias("term"), "post_hits", "thread_hits")


QUERIES = {
    "t1_segmentation": t1_segmentation,
    "t2_pos_context": t2_pos_context,
    "t1_segmented_stats": t1_segmented_stats,
}


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


#: tags by number, ties go to the smaller one: unknown words, then the names in order
TAGS = [S.EDGE, S.UNKNOWN, *sorted([NOUN_POS, VERB, ADJECTIVE])]


def _pair_cost(left: str, right: str) -> int:
    return next((c for a, b, c in CONNECTIONS if (a, b) == (left, right)), DEFAULT)


LEXICON_SQL = f"""
word AS (
  SELECT DISTINCT w AS surface FROM (SELECT unnest(regexp_extract_all(lower(text), '[\\p{{Latin}}]+')) AS w FROM conversations) WHERE length(w) <= 4),
lex0 AS (
  SELECT surface, {_quoted(NOUN_POS)} AS pos, 1500 + 300 * length(surface) AS cost FROM word
  WHERE length(surface) = 2 OR contains('{VOWELS}', right(surface, 1))
  UNION ALL SELECT surface, {_quoted(VERB)}, 1500 + 300 * length(surface) FROM word
  WHERE length(surface) = 2 OR NOT contains('{VOWELS}', right(surface, 1))
  UNION ALL SELECT split_part(p_name, ' ', -1), {_quoted(NOUN_POS)}, 2000 FROM part
  UNION ALL SELECT split_part(p_name, ' ', -1), {_quoted(VERB)}, 2000 FROM part
  UNION ALL SELECT split_part(p_name, ' ', 1), {_quoted(ADJECTIVE)}, 2000 FROM part),
lex AS MATERIALIZED (SELECT surface, list_position([{', '.join(map(_quoted, TAGS))}], pos) - 1 AS t, min(cost) AS cost FROM lex0 GROUP BY ALL),
conn AS (SELECT * FROM (VALUES {', '.join(f'({i}, {j}, {_pair_cost(a, b)})' for i, a in enumerate(TAGS) for j, b in enumerate(TAGS))}) v(l, r, c)),
longest AS (SELECT max(length(surface)) AS m FROM lex)"""


def path_sql(run_cte: str) -> str:
    """CTEs up to ``cut(run, i, surface, pos)``, the words of every run; ``run_cte`` defines run(run)."""
    return f"""WITH RECURSIVE {run_cte},{LEXICON_SQL},
starts AS (SELECT run, unnest(range(1, length(run) + 1)) AS s FROM run),
spans AS MATERIALIZED (
  SELECT p.run, p.s, p.s + length(p.sub) AS e, lex.t, lex.cost
  FROM (SELECT run, s, substring(run, CAST(s AS INTEGER), CAST(k AS INTEGER)) AS sub
        FROM starts, longest, range(1, 64) g(k) WHERE k <= m AND s + k - 1 <= length(run)) p JOIN lex ON lex.surface = p.sub
  UNION ALL SELECT run, s, s + 1, 1, {S.UNKNOWN_COST} FROM starts),
reach AS (
  SELECT run, 1::BIGINT AS done, 1::BIGINT AS e, 0::BIGINT AS s, 0::BIGINT AS t, 0::BIGINT AS total, NULL::BIGINT AS ps, NULL::BIGINT AS pt FROM run
  UNION ALL
  SELECT run, done, e, s, t, total, ps, pt FROM (
    SELECT run, done + 1 AS done, e, s, t, total, ps, pt FROM reach WHERE done <= length(run)
    UNION ALL
    SELECT x.run, r.done + 1, x.e, x.s, x.t, r.total + conn.c + x.cost, r.s, r.t
    FROM reach r JOIN spans x ON x.run = r.run AND x.e = r.done + 1 AND x.s = r.e JOIN conn ON conn.l = r.t AND conn.r = x.t)
  QUALIFY row_number() OVER (PARTITION BY run, done, e, s, t ORDER BY total, ps, pt) = 1),
best AS MATERIALIZED (SELECT run, e, s, t, total, ps, pt FROM reach WHERE e = done),
final AS (
  SELECT b.run, b.e, b.s, b.t, b.ps, b.pt FROM best b JOIN conn ON conn.l = b.t AND conn.r = 0 WHERE b.e = length(b.run) + 1
  QUALIFY row_number() OVER (PARTITION BY b.run ORDER BY b.total + conn.c, b.s, b.t) = 1),
walk AS (
  SELECT run, e, s, t, ps, pt FROM final
  UNION ALL
  SELECT b.run, b.e, b.s, b.t, b.ps, b.pt FROM walk w JOIN best b ON b.run = w.run AND b.e = w.s AND b.s = w.ps AND b.t = w.pt WHERE w.ps > 0),
isle AS (
  SELECT run, s, e, t, sum(CASE WHEN t = 1 AND before = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY run ORDER BY s) AS i
  FROM (SELECT *, lag(t) OVER (PARTITION BY run ORDER BY s) AS before FROM walk)),
cut AS (
  SELECT run, i, substring(run, CAST(min(s) AS INTEGER), CAST(max(e) - min(s) AS INTEGER)) AS surface,
         CASE WHEN any_value(t) = 1 THEN {_quoted(NOUN_POS)} ELSE [{', '.join(map(_quoted, TAGS))}][any_value(t) + 1] END AS pos
  FROM isle GROUP BY run, i)"""


ORACLE = {
    "t1_segmentation": path_sql(
        f"run AS MATERIALIZED (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{S.RUN_PATTERN_RE2}')) AS run FROM documents)") + """
SELECT run, string_agg(surface || '/' || pos, ' ' ORDER BY i) AS words FROM cut GROUP BY run""",
    "t2_pos_context": path_sql("""run AS MATERIALIZED (
  SELECT DISTINCT unnest([replace(p_name, ' ', ''), r, r || replace(p_name, ' ', '')]) AS run
  FROM (SELECT p_name, array_to_string(list_reverse(string_split(p_name, ' ')), '') AS r FROM part))""") + f"""
SELECT surface, pos, after_pos, count(*) AS n FROM (
  SELECT surface, pos, coalesce(lag(pos) OVER (PARTITION BY run ORDER BY i), {_quoted(S.EDGE)}) AS after_pos FROM cut) GROUP BY ALL""",
    "t1_segmented_stats": path_sql(f"""{O.POSTS_CONVERSATIONS.strip()},
post AS MATERIALIZED (SELECT row_number() OVER () AS id, date, board_key, thread_path, regexp_extract_all(lower(content), '{S.RUN_PATTERN_RE2}') AS runs FROM posts),
run AS MATERIALIZED (SELECT DISTINCT unnest(runs) AS run FROM post)""") + f""",
hit AS (
  SELECT DISTINCT p.id, p.date, p.board_key, p.thread_path, {O.norm_sql('c.surface')} AS term
  FROM (SELECT id, date, board_key, thread_path, unnest(runs) AS run FROM post) p JOIN cut c ON c.run = p.run WHERE c.pos = {_quoted(NOUN_POS)})
SELECT strftime(date, '%Y-%m-%d') AS date, board_key, term, count(*) AS post_hits, count(DISTINCT thread_path) AS thread_hits
FROM hit WHERE term <> '' AND term NOT IN {O.BLOCKED_SQL} GROUP BY date, board_key, term""",
}
