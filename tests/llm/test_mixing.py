"""Mixing against a word-by-word replay of its plan and the contract's limits."""

from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from wordtide.llm import mixing

SF = "/root/testdata/sf0.001"


def brute_targets(sizes, weights):
    """Reshare step by step with plain fractions."""
    fixed = {}
    while True:
        open_ = [s for s in sizes if s not in fixed]
        rest = Fraction(sum(sizes.values())) - sum(fixed.values())
        want = {s: rest * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = [s for s in open_ if want[s] > 3 * sizes[s]]
        if not over:
            return fixed | want
        fixed |= {s: Fraction(3 * sizes[s]) for s in over}


def replay(rows, plan):
    """Words taken per document, by walking every slot of every source."""
    taken = defaultdict(int)
    words = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r._part, r._row)):
        words[r._source] += [(r._part, r._row)] * r._size
    for i, s in enumerate(plan.order):
        for j in range(plan.slots[i]):
            turn, idx = divmod(j, plan.blocks[i])
            b = int(mixing.permute(np.array([idx]), plan.blocks[i], plan.key(i, turn))[0])
            block = words[s][b * plan.words:(b + 1) * plan.words]
            if plan.trim[i] and j == plan.slots[i] - 1:
                block = block[:plan.trim[i]]
            for d in block:
                taken[d] += 1
    return taken


def test_query_on_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    out = mixing.op4_mixing(spark, SF).collect()
    text = {r.doc_id: r for r in df.collect()}
    sizes, taken = defaultdict(int), defaultdict(int)
    for d in text.values():
        sizes[d.source] += len((d.text or "").encode().split())
    goal = brute_targets(sizes, {s: i % 3 + 1 for i, s in enumerate(sorted(sizes))})
    assert len(out) == len(text)
    for r in out:
        src = text[r.doc_id].source
        assert r.size == len((text[r.doc_id].text or "").encode().split())
        assert r.source_size == sizes[src] and r.target == pytest.approx(float(goal[src]))
        assert 0 <= r.taken <= 3 * r.size
        taken[src] += r.taken
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 1
    assert sorted(out) == sorted(mixing.op4_mixing(spark, SF).collect())


def test_against_replay(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join("w" * int(x) for x in rng.integers(1, 5, rng.integers(0, 60))), s)
            for i, s in enumerate(rng.choice(["a", "b", "c", "ü"], 80, p=[.7, .1, .1, .1]).tolist())]
    rows += [(900, None, "a"), (901, "", None), (902, "one two three", None), (902, "one two three", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    docs, spans, plan = mixing.mix(df, block_words=8, shard_blocks=20)
    want = replay(docs.collect(), plan)
    got = mixing.taken_words(docs, spans, plan).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.taken == want.get((r._part, r._row), 0) <= 3 * r._size
    by_shard = defaultdict(set)
    for r in spans.collect():
        by_shard[r.shard].add((r.source, r.slot))
    sizes = [len(x) for _, x in sorted(by_shard.items())]
    assert all(n == 20 for n in sizes[:-1]) and sum(sizes) == sum(plan.slots)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000])
def test_permutation(n):
    for key in (0, 5, 99):
        assert sorted(mixing.permute(np.arange(n), n, key).tolist()) == list(range(n))


def test_targets_cap_and_empty(spark):
    sizes = {"a": 1000, "b": 10, "c": 20, None: 5}
    assert mixing.targets(sizes) == brute_targets(sizes, {"a": 1, "b": 2, "c": 3, None: 1})
    df = spark.createDataFrame([], "doc_id long, text string, source string, size int, taken int")
    assert mixing.taken_words(*mixing.mix(df)).collect() == []
    df = spark.createDataFrame([(1, None, "a", 1), (2, " \n", None, 1)], "doc_id long, text string, source string, _size int")
    assert [r.taken for r in mixing.taken_words(*mixing.mix(df)).collect()] == [0, 0]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 65, 1000, 4097])
def test_place_inverts_permute(n):
    for key in (0, 5, 0x3FFFFFFFFFFFFFFF):
        to = mixing.permute(np.arange(n), n, key)
        assert [mixing.place(int(v), n, key) for v in to[:300]] == list(range(min(n, 300)))


def test_plan_of_a_huge_source_does_not_walk_its_slots():
    """10^13 words: the short block is found without trying 10^11 slots."""
    plan = mixing.Plan({"a": 10**13 + 1}, {"a": 2 * 10**13 // 3}, 64, 1)
    n, key = plan.blocks[0], plan.key(0, 0)
    at = mixing.place(n - 1, n, key)
    assert mixing.permute(np.array([at]), n, key)[0] == n - 1
    assert (plan.part[0] - 1) * 64 + plan.trim[0] - (63 if at < plan.part[0] - 1 else 0) == plan.goal["a"]
