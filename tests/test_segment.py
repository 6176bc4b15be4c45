"""Segmentation against a brute-force search over all ways to cut, and its parts of speech by context."""

import itertools
import random

import pytest

from wordtide.operators import daily, segment as S, terms as T
from wordtide.operators.terms import NOUN_POS
from wordtide.plans.segment_queries import ADJECTIVE, CONNECTIONS, VERB, connections

LEX = [("a", NOUN_POS, 1000), ("ab", VERB, 1200), ("abc", NOUN_POS, 2500), ("b", VERB, 900), ("bc", ADJECTIVE, 1500), ("c", NOUN_POS, 1100),
       ("ca", NOUN_POS, 1300), ("c", ADJECTIVE, 1000), ("ab", VERB, 1800), (None, NOUN_POS, 1), ("", NOUN_POS, 1), ("b", None, 1)]


def frames(spark, runs, lex=LEX):
    return (spark.createDataFrame([(r,) for r in runs], "run string").repartition(3),
            spark.createDataFrame(lex, "surface string, pos string, cost int"))


def brute(run, default=0):
    """The cheapest way, unknown words of one letter each; words (surface, tag)."""
    conn = {(a, b): c for a, b, c in CONNECTIONS}
    words = [(s, p, c) for s, p, c in LEX if s and p]
    best = None

    def go(at, path, total):
        nonlocal best
        if at == len(run):
            total += conn.get((path[-1][1] if path else S.EDGE, S.EDGE), default)
            if best is None or total < best[0]:
                best = (total, path)
            return
        left = path[-1][1] if path else S.EDGE
        for s, p, c in [*words, (run[at], S.UNKNOWN, S.UNKNOWN_COST)]:
            if run.startswith(s, at):
                go(at + len(s), [*path, (s, p)], total + c + conn.get((left, p), default))

    go(0, [], 0)
    out = []
    for tag, group in itertools.groupby(best[1], key=lambda w: w[1] if w[1] == S.UNKNOWN else object()):
        group = list(group)
        out += [("".join(w[0] for w in group), NOUN_POS)] if tag == S.UNKNOWN else group
    return best[0], out


def cost(words, default=0):
    """Total of a cut with unknown words taken letter by letter."""
    conn = {(a, b): c for a, b, c in CONNECTIONS}
    known = {}
    for s, p, c in LEX:
        if s and p:
            known[s, p] = min(c, known.get((s, p), c))
    total, left = 0, S.EDGE
    for s, p in words:
        parts = [(s, p)] if (s, p) in known else [(ch, S.UNKNOWN) for ch in s]
        for w in parts:
            total += known.get(w, S.UNKNOWN_COST) + conn.get((left, w[1]), default)
            left = w[1]
    return total + conn.get((left, S.EDGE), default)


@pytest.mark.parametrize("default", [0, 500])
def test_cheapest_path(spark, default):
    rng = random.Random(default)
    texts = {"".join(rng.choice("aabbccx") for _ in range(rng.randrange(1, 9))) for _ in range(120)}
    runs, lex = frames(spark, [*texts, "abc", "abc"])
    out = {r.run: [tuple(w) for w in r.words] for r in S.segment(runs, lex, connections(spark), default_connection=default).collect()}
    assert set(out) == texts | {"abc"}
    for run, words in out.items():
        assert "".join(w[0] for w in words) == run
        assert cost(words, default) == brute(run, default)[0], run


def test_a_surface_is_noun_or_verb_by_its_neighbour(spark):
    lex = [("big", ADJECTIVE, 1000), ("ring", NOUN_POS, 1000), ("ring", VERB, 1000), ("bell", NOUN_POS, 1000)]
    runs, lex = frames(spark, ["bigring", "bellring", "ring", "ringbell"], lex)
    out = {r.run: [w.pos for w in r.words] for r in S.segment(runs, lex, connections(spark)).collect()}
    assert out["bigring"] == [ADJECTIVE, NOUN_POS] and out["bellring"] == [NOUN_POS, VERB]
    assert out["ring"] == [NOUN_POS] and out["ringbell"] == [VERB, NOUN_POS]


def test_cases(spark):
    runs, lex = frames(spark, ["xyz", "", None, "a" * S.MAX_RUN, "東京都に"], [*LEX, ("東京", NOUN_POS, 500), ("京都", NOUN_POS, 500), ("東", NOUN_POS, 2000), ("都", NOUN_POS, 900)])
    out = {r.run: [tuple(w) for w in r.words] for r in S.segment(runs, lex, connections(spark)).collect()}
    assert out["xyz"] == [("xyz", NOUN_POS)] and len(out["a" * S.MAX_RUN]) == S.MAX_RUN
    assert out["東京都に"] == [("東京", NOUN_POS), ("都", NOUN_POS), ("に", NOUN_POS)]
    assert len(out) == 3
    none = spark.createDataFrame([], "surface string, pos string, cost int")
    assert [tuple(w) for w in S.segment(runs.where("run = 'xyz'"), none).first().words] == [("xyz", NOUN_POS)]
    assert S.segment(runs.limit(0), lex).collect() == []


def test_runs_and_daily_counts(spark):
    texts = spark.createDataFrame([("東京タワーへ行く、abc 12!",), (None,), ("",), ("z" * 1500,)], "t string")
    assert [r[0] for r in texts.select(S.runs(texts.t)).collect()] == [["東京タワーへ行く", "abc", "12"], [], [], ["z" * 1000, "z" * 500]]
    posts = spark.createDataFrame([("2025-01-01", "b", "/t", i, c) for i, c in enumerate(["東京都 東京都", "京都", None])],
                                  "date string, board_key string, thread_path string, post_no int, content string").selectExpr(
        "cast(date as date) date", "board_key", "thread_path", "post_no", "content")
    lex = spark.createDataFrame([("東京", NOUN_POS, 500), ("京都", NOUN_POS, 500), ("都", NOUN_POS, 900)], "surface string, pos string, cost int")
    res = daily.run_daily(posts, T.empty_terms(spark), segmenter=lambda r: S.segment(r, lex))
    assert {r.normalized: (r.post_hits, r.thread_hits) for r in res.stats.collect()} == {"東京": (1, 1), "京都": (1, 1)}
    (m,) = res.metrics.collect()
    assert (m.fetched_posts, m.tokenize_fail_posts, m.total_tokens, m.filtered_tokens) == (3, 0, 5, 2)  # the single 都 is too short
