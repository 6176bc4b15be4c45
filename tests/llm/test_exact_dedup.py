"""Exact dedup: small cases against plain grouping; the table itself is checked by the SQL oracle."""

from collections import defaultdict

import pytest

from wordtide.llm import exact_dedup


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[low(t)].append(i)
    return sorted((i, max(groups[low(t)]), len(groups[low(t)]), i == max(groups[low(t)])) for i, t in rows)


def test_cases(spark):
    long = "Lorem ÄÖ ipsum 日本 " * 900
    rows = [(1, "A"), (2, "a"), (3, "Ä"), (4, "ä"), (5, None), (6, ""), (7, long), (8, long.replace("L", "l")), (9, long + "x"),
            (10, long + "y"), (11, "x" * 4096), (12, "X" * 4096), (13, "x" * 4097), (14, "x" * 8192), (15, "x" * 8192),
            (16, "y" * 4096 + "x" * 4096), (17, "x" * 4096 + "y" * 4096)]
    df = spark.createDataFrame([(i, t, t, 0) for i, t in rows], "doc_id long, text string, _text string, keep_id int")
    for block in (16384, 4096, 7):
        out = exact_dedup.exact_dedup(df, block_bytes=block)
        assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in out.collect()) == brute(rows)
    kept = exact_dedup.keep_rows(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, _, k in brute(rows) if k]


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a"), (None, "q"), (1, "a"), (2, "r"), (2, "r"), (2, "s")], "doc_id long, text string")
    out = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(df).collect()), key=str)
    assert out == sorted([(None, 1, 2, False), (None, None, 1, True), (1, 1, 2, True), (2, 2, 2, True), (2, 2, 2, True), (2, 2, 1, True)], key=str)
    assert exact_dedup.exact_dedup(df.limit(0)).collect() == []
    assert exact_dedup.keep_rows(df).count() == 4


@pytest.mark.parametrize("block", [1, 2, 5])
def test_names_match_contents(spark, block):
    texts = ["ab", "abab", "abba", "abab", "a", "", "b" * 9, "b" * 8 + "a", "b" * 9]
    df = spark.createDataFrame([(i, str(i), len(t), t) for i, t in enumerate(texts)], "_id long, _sha string, _n int, _text string")
    name = {r._id: (r._n, r._name) for r in exact_dedup.block_names(df, block).collect()}
    assert len(name) == len(texts)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert (name[i] == name[j]) == (a == b)
