"""Near-duplicates against all pairs compared by brute force."""

import re

import numpy as np
import pytest

from wordtide.llm import near_dedup

SF = "/root/testdata/sf0.001"


def shingle_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(s), low[find(i)], d == low[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_on_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(near_dedup.op8_minhash_near_dedup(spark, sf)) == brute(rows)


@pytest.mark.parametrize("block", [None, 7])
def test_groups_chains_and_edge_cases(spark, monkeypatch, block):
    if block:
        monkeypatch.setattr(near_dedup, "SKETCH_BLOCK", block)
        monkeypatch.setattr(near_dedup, "SHINGLE_BLOCK", block * 100)
    rng = np.random.default_rng(5)
    word = lambda: "w" + str(rng.integers(10_000))
    rows, base = [], [word() for _ in range(120)]
    for i in range(60):  # one large group of near copies, each with its own edit
        t = list(base)
        t[int(rng.integers(120))] = word()
        rows.append((i, " ".join(t)))
    chain = [word() for _ in range(150)]
    for i in range(60, 80):  # a chain: neighbours are linked, the ends are not
        rows.append((i, " ".join(chain)))
        at = (i - 60) * 7
        chain[at:at + 2] = [word(), word()]
    half = [word() for _ in range(60)]
    for i in range(80, 110):  # share a passage but are not similar enough
        rows.append((i, " ".join(half + [word() for _ in range(60)])))
    rows += [(200, None), (201, ""), (202, " \n\t"), (203, "A b C"), (204, "a B c"), (205, "a b c d"), (206, "a\x0bb\x0cc\rd"),
             (207, "É x"), (208, "é x"), (209, "a b c d e"), (210, "a b c d e " * 20000), (211, "a\xa0b c")]
    order = rng.permutation(len(rows))
    df = spark.createDataFrame([(*rows[i], 1, "x") for i in order], "doc_id long, text string, node int, _sig string").repartition(3)
    assert got(near_dedup.near_dedup(df)) == brute(rows)
    kept = near_dedup.keep_rows(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [r[0] for r in brute(rows) if r[3]]
    assert near_dedup.near_dedup(df.limit(0)).collect() == []


def test_repeated_and_null_ids(spark):
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(None, t), (None, t + " z"), (5, "q r"), (5, "q r"), (5, t)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_dedup(df).collect()), key=str)
    assert out == sorted([(None, 36, 5, False), (None, 37, 5, False), (5, 1, 5, True), (5, 1, 5, True), (5, 36, 5, True)], key=str)


def test_pigeonhole_guarantee():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 16, (300, near_dedup.SYMBOLS)).astype("<u2")
    y = x.copy()
    for row in y:
        at = rng.choice(near_dedup.SYMBOLS, near_dedup.RADIUS, replace=False)
        row[at] = rng.integers(0, 1 << 16, len(at))
    assert (near_dedup.chunk_keys(x) == near_dedup.chunk_keys(y)).any(axis=1).all()
    (a0, a1), (b0, b1) = near_dedup.sketches(x), near_dedup.sketches(y)
    ones = np.ones(len(x), np.int64)
    assert near_dedup.near(a0, a1, ones, b0, b1, ones).all()


def test_owned_pairs_and_intersections():
    """Every pair within the radius is owned by exactly one of the keys that both rows have."""
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 16, near_dedup.SYMBOLS).astype("<u2")
    sig = np.stack([np.where(rng.random(near_dedup.SYMBOLS) < p, rng.integers(0, 1 << 16, near_dedup.SYMBOLS), base).astype("<u2")
                    for p in rng.uniform(0, .6, 40)])
    keys, n, comp = near_dedup.chunk_keys(sig), np.full(40, 9), np.arange(40)
    owners = {}
    for key in np.unique(keys):
        rows = np.flatnonzero((keys == key).any(axis=1))
        i, j = near_dedup.owned_pairs(int(key), sig[rows], n[rows], comp[rows], sig[rows], n[rows], comp[rows], 75)
        for a, b in zip(rows[i], rows[j]):
            owners.setdefault((a, b), []).append(key)
    want = {(a, b) for a in range(40) for b in range(40) if a != b and (sig[a] != sig[b]).sum() <= near_dedup.RADIUS}
    assert set(owners) == want and all(len(v) == 1 for v in owners.values())
    sets = [np.unique(rng.integers(0, 400, 200).astype(np.uint64)) for _ in range(40)]
    i, j = np.divmod(np.arange(1600), 40)
    assert near_dedup.intersections(sets, i, j).tolist() == [len(set(sets[a]) & set(sets[b])) for a, b in zip(i, j)]
    assert near_dedup.intersections(sets, i[:9], j[:9]).tolist() == near_dedup.intersections(sets, i, j)[:9].tolist()


def test_buckets_of_any_size_across_batches(spark):
    """Star, small pairs and kept-aside rows together cover every bucket, however batches fall."""
    rng = np.random.default_rng(1)
    rows = [(int(k), i, 0, 0, 10) for i, k in enumerate(rng.choice(40, 300, p=[.3] + [.7 / 39] * 39))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        out = near_dedup.meet(spark.createDataFrame(rows, "key long, node long, s0 long, s1 long, n long"), 75).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    pairs, aside = {(r.a, r.b) for r in out if r.kind == 0}, {(r.a, r.b) for r in out if r.kind == 1}
    by_key = {}
    for k, i, *_ in rows:
        by_key.setdefault(k, []).append(i)
    for k, ids in by_key.items():
        if len(ids) > near_dedup.SMALL:
            assert {(k, i) for i in ids} <= aside and {(ids[0], i) for i in ids[1:]} <= pairs
        else:
            assert {(i, j) for i in ids for j in ids if i < j} <= pairs
