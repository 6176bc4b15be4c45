"""The trie against brute force over Python tuples, against the SQL, and its list ranking by itself."""

import hashlib
import zlib

import numpy as np
import pytest

from tests.harness import compare, duckdb_con
from wordtide.llm import prefix_trie

SF = "/root/testdata/sf0.01"


def ordered(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = (turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest())
            convs.setdefault(c, []).append((key, role, text))
    return {c: [(r, x) for _, r, x in sorted(v)] for c, v in convs.items()}


def rebuild(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = {}
    for c, v in convs.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])),
                    sum(q not in children for q in below), sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def rows_of(spark, sf):
    return [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]


def test_query_against_sql(spark):
    r = compare(spark, duckdb_con(SF), "op11_prefix_trie", prefix_trie.op11_prefix_trie, prefix_trie.SQL, SF)
    assert r["status"] == "ok" and r["spark_rows"] > 100, r


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    assert got(prefix_trie.op11_prefix_trie(spark, sf)) == brute(rebuild(ordered(rows_of(spark, sf))))


CASES = ([(c, t, "u" if t % 2 else "a", f"text {t}") for c in range(3) for t in range(12)]          # equal conversations
         + [(c, t, "u", f"t{t % 3}é😀" if t < 4 + c % 4 else f"own {c}") for c in range(101, 110) for t in range(7)]  # shared beginnings
         + [(200, None, None, None), (200, None, "u", None), (200, 3, "u", "b"), (200, 3, "u", "a"), (200, 3, "u", "a")]  # nulls, ties, repeats
         + [(-7, 0, "u", ""), (-100, 0, "u", "x"), (301, 0, "u", "alone"), (None, 0, "u", "nobody's")]
         + [(150, t, "u", "same") for t in range(40)])                                                          # a deep one


@pytest.mark.parametrize("base, fan, block", [(2048, 4096, 1024), (8, 4, 3)])
def test_cases(spark, base, fan, block, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    df = spark.createDataFrame([(*r, 1, "x") for r in CASES], "conv_id long, turn long, role string, text string, id int, pos string").repartition(5)
    turns = prefix_trie.numbered_turns(df)
    convs = ordered(CASES)
    assert got(prefix_trie.trie(turns, turns.select("c").distinct(), base, fan)) == brute(convs)
    assert got(prefix_trie.trie(*prefix_trie.rebuilt(turns), base, fan)) == brute(rebuild(convs))


def test_texts_and_empty(spark):
    df = spark.createDataFrame(CASES, "conv_id long, turn long, role string, text string")
    nodes = prefix_trie.prefix_trie(df)
    convs = ordered(CASES)
    for r in prefix_trie.with_turns(nodes, df).collect():
        assert (r.role, r.text) == (convs[r.conv_id][r.depth - 1] if r.depth else (None, None))
    assert prefix_trie.prefix_trie(df.limit(0)).collect() == []
    assert prefix_trie.prefix_trie(df.where("conv_id IS NULL")).collect() == []


def test_another_seed_after_a_collision(spark, monkeypatch):
    df = spark.createDataFrame([(c, t, "u", f"{c % 5} {t}") for c in range(10) for t in range(3)], "conv_id long, turn long, role string, text string")
    whole, tried = prefix_trie._prefixes, []

    def blunt(turns, seed):  # the first seed gives all prefixes of a depth one key
        tried.append(seed)
        out = whole(turns, seed)
        return out if len(tried) > 1 else out.withColumns({k: out["d"] for k in prefix_trie.KEY} | {f"p{k}": out["d"] - 1 for k in range(1, 5)})

    monkeypatch.setattr(prefix_trie, "_prefixes", blunt)
    assert got(prefix_trie.prefix_trie(df)) == brute(ordered([(c, t, "u", f"{c % 5} {t}") for c in range(10) for t in range(3)]))
    assert len(tried) == 2 and tried[0] != tried[1]


def test_rank_of_a_random_list(spark):
    rng = np.random.default_rng(3)
    order = rng.permutation(3000).tolist()
    df = spark.createDataFrame([(a, b) for a, b in zip(order, [*order[1:], None])], "arc long, nxt long").repartition(4)
    assert {r.arc: r["at"] for r in prefix_trie.rank(df, order[0], base=100).collect()} == {a: k for k, a in enumerate(order)}


def test_sums_before(spark):
    v = np.random.default_rng(4).integers(0, 9, 1000)
    df = spark.createDataFrame([(k, int(x), "y") for k, x in enumerate(v)], "at long, x long, other string")
    out = {r["at"]: r.x for r in prefix_trie.sums_before(df, 1000, ["x"], fan=7).collect()}
    assert out == {k: int(v[:k].sum()) for k in range(1000)}
