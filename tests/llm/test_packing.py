"""Packing against the contract: every id once, sequences gapless, no padding, shares kept."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from wordtide.llm import packing
from wordtide.llm._common import make_encoder, tokenizer_path

SF = "/root/testdata/sf0.001"


def brute_ids(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    return [[*tok.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def check(rows, ids):
    """rows: pieces; ids: {doc_id: token ids}. Returns sequences as {id: [pieces]}."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id])
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length > 0
        assert r.ids_crc32 == zlib.crc32(np.array(part, dtype="<u4").tobytes())
        by_doc[r.doc_id].append((r.start, r.length))
        by_seq[r.sequence_id].append((r.offset, r.length, r.doc_id))
    assert set(by_doc) == set(ids)
    for d, parts in by_doc.items():
        at = 0
        for s, n in sorted(parts):
            assert s == at
            at += n
        assert at == len(ids[d])
    for parts in by_seq.values():
        at = 0
        for o, n, _ in sorted(parts):
            assert o == at
            at += n
        assert at == 2048 or at & (at - 1) == 0
    return by_seq


def test_query_on_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    ids = dict(zip([r.doc_id for r in docs], brute_ids([r.text for r in docs])))
    seqs = check(packing.op2_packing(spark, SF).collect(), ids)
    source = {r.doc_id: r.source for r in docs}
    total, by_source = sum(map(len, ids.values())), defaultdict(int)
    for d, x in ids.items():
        by_source[source[d]] += len(x)
    for parts in seqs.values():
        if sum(n for _, n, _ in parts) == 2048:
            got = defaultdict(int)
            for _, n, d in parts:
                got[source[d]] += n
            for s, t in by_source.items():
                assert abs(got[s] - 2048 * t / total) < 3


def test_cases(spark):
    rows = [(1, "one two three", "a", 1), (2, None, "a", 2), (3, "", None, 3), (4, "tok " * 9000, "b", 4),
            (5, "x <|endoftext|> y", "b", 5), (6, "naïve ﬀ 日本 " + "z" * 700, None, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, ids int")
    out = packing.pieces_digest(packing.pack(df, windows=2)).collect()
    check(out, dict(zip([r[0] for r in rows], brute_ids([r[1] for r in rows]))))
    assert packing.pack(df.limit(0)).collect() == []


def test_repeated_rows_pack_twice(spark):
    df = spark.createDataFrame([(7, "a b c", "s")] * 2, "doc_id long, text string, source string")
    out = packing.pack(df).collect()
    assert sum(r.length for r in out) == 2 * len(brute_ids(["a b c"])[0])


@pytest.mark.parametrize("targets", [None, {"a": 1.0, "b": 3.0, "c": 0.5}])
def test_schedule_and_deficits(targets):
    plan = packing.Schedule({"a": 1000, "b": 5000, "c": 3}, targets, 512)
    for s in range(3):
        cuts = [plan.served(s, p) for p in range(plan.parts + 1)]
        assert cuts[0] == 0 and cuts[-1] == plan.total[s] and cuts == sorted(cuts)
        for x in range(0, plan.total[s], 7):
            p = plan.step(s, x)
            assert cuts[p] <= x < cuts[p + 1]


def test_round_robin_empties_queues():
    rng = np.random.default_rng(3)
    for _ in range(30):
        amount = rng.integers(1, 3000, rng.integers(1, 9))
        sizes = packing.window_sizes(int(amount.sum()), 256)
        takes = packing.round_robin(amount, rng.random(len(amount)), sizes)
        assert (takes >= 0).all() and (takes.sum(0) == amount).all() and (takes.sum(1) == sizes).all()


def test_fast_and_slow_encoders_agree(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += ["", " ", "  a  b ", "don't we'll I'M", "1234567890 12,5", "tab\t\n\r\n x", "é" * 20, "“q” – … ‘s’", "a" * 499, " x­", "²³¼"]
    assert make_encoder(tokenizer_path())(texts) == [x[:-1] for x in brute_ids(texts)]


def test_vocabulary_over_16_bits(spark, tmp_path):
    """Ids from 100,000 on travel whole."""
    import json

    spec = {"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"},
            "post_processor": None, "decoder": None,
            "model": {"type": "WordLevel", "vocab": {"?": 0, **{f"w{i}": i for i in range(2, 100_002)}}, "unk_token": "?"}}
    path = tmp_path / "wide.json"
    path.write_text(json.dumps(spec))
    rng = np.random.default_rng(0)
    rows = [(d, " ".join(f"w{i}" for i in rng.integers(60_000, 100_000, 50 + 900 * (d % 7)))) for d in range(20)]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string").repartition(3)
    out = packing.pieces_digest(packing.pack(df, tokenizer=str(path))).collect()
    check(out, {d: [*(int(w[1:]) for w in t.split()), 1] for d, t in rows})
