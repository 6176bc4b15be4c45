"""Grammar files: ids equal the tokenizers library's, files decode to them in whole and in part."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wordtide.llm import repair
from wordtide.session import new_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(repair.vocabulary())
    return lambda text: [*tok.encode(text or "", add_special_tokens=False).ids, repair.EOD]


def digest(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def brute(rows, library):
    out, at = [], 0
    for i, text in rows:
        ids = library(text)
        out.append((i, at, len(ids), digest(ids)))
        at += len(ids)
    return out


def got(df, key="doc_id"):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1], r[2]))


def test_query_on_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    assert got(repair.op13_repair(spark, SF)) == brute([(r.doc_id, r.text) for r in docs], library)


def test_cases_and_documents_over_many_shards(spark, library):
    long = "Über die Brücke, it's 1,234 cafés " * 400
    rows = [(5, "b"), (3, None), (3, ""), (4, long), (None, "first"), (7, "<|endoftext|> don't <|startoftext|>x"), (9, "a a a a " * 300), (9, "a a a a " * 300)]
    df = spark.createDataFrame([(*r, 0, "x", 1) for r in rows], "doc_id long, text string, part int, _text string, n long").repartition(3)
    want = brute([rows[4], rows[1], rows[2], rows[3], rows[0], rows[5], *rows[6:]], library)
    for shard in (64, 1 << 20):
        files = repair.write_files(df, new_path(spark, "grammar-test"), shard_ids=shard)
        assert got(repair.documents(files)) == want
        assert files.agg({"n_ids": "max"}).first()[0] <= shard
    whole = [i for r in sorted(want, key=lambda r: r[1]) for i in library(dict(rows)[r[0]])]
    # any range of a file decodes by itself
    rng, at = np.random.default_rng(0), 0
    for f in sorted(files.collect(), key=lambda f: (f.part, f.shard)):
        ids = whole[at:at + f.n_ids]
        for start in rng.integers(0, f.n_ids, 20):
            n = int(rng.integers(0, 300))
            assert repair.read_ids(f.path, int(start), n).tolist() == ids[start:start + n]
        at += f.n_ids
    assert at == len(whole)
    none = repair.write_files(df.limit(0), new_path(spark, "grammar-test"))
    assert none.count() == 0 and repair.documents(none).collect() == []


def test_other_id_types(spark, library):
    df = spark.createDataFrame([("b", "two words"), ("a", "one")], "name string, body string")
    files = repair.write_files(df, new_path(spark, "grammar-test"), "name", "body")
    assert got(repair.documents(files, "string")) == brute([("a", "one"), ("b", "two words")], library)


WORDS = st.one_of(st.text(max_size=12), st.text("abcXYZ'sd tre<|>-_.,09 \n\t\x1c\x7f\x00", max_size=30), st.text("ÀéßÿŸ×÷İıſ̸̈=<Å 　 \u0085ñ", max_size=12))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), WORDS, st.just("<|endoftext|>"), st.just("it's we're"), st.just("Ünïcode Ärger x²")), min_size=1, max_size=6), st.sampled_from([4, 16, 1 << 20]))
def test_encoder_equals_library(library, texts, part):
    repair_part, repair.PART_BYTES = repair.PART_BYTES, part
    try:
        out, cur = [], []
        for ids, lengths, closed in ENCODER.encode(pa.array(texts, pa.string())):
            at = 0
            for k, n in enumerate(lengths.tolist()):
                cur += ids[at:at + n].tolist()
                at += n
                if closed or k < len(lengths) - 1:
                    out, cur = [*out, cur], []
    finally:
        repair.PART_BYTES = repair_part
    assert out == [library(t)[:-1] for t in texts]


ENCODER = repair.WordEncoder(repair.vocabulary())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=400), st.integers(1, 30), st.sampled_from([4, 300, 70000, 65530]))
def test_grammar_round_trip(ids, repeat, base):
    ids = np.array(ids * repeat, np.uint32)
    rules, symbols = repair.compress(ids, base, 2)
    lengths = repair.rule_lengths(rules, base)
    assert (repair.expand(symbols, rules, lengths, base) == ids).all()
    assert len(symbols) + len(rules) <= max(1, len(ids))
    if base < 1 << 16:
        assert base + len(rules) <= 1 << 16


def test_grammar_shrinks_repeats():
    ids = np.tile(np.random.default_rng(1).integers(0, 49000, 1000), 200).astype(np.uint32)
    rules, symbols = repair.compress(ids, 49408)
    assert len(symbols) + 4 * len(rules) < len(ids) / 15
    ones = np.ones(100_000, np.uint32)
    rules, symbols = repair.compress(ones, 49408)
    assert len(symbols) < 20


def test_joined_crc():
    data = np.random.default_rng(2).integers(0, 256, 5000, np.uint8).tobytes()
    for cuts in ([0, 5000], [0, 1, 4999, 5000], [0, 0, 1200, 1200, 5000]):
        pieces = [(zlib.crc32(data[a:b]), b - a) for a, b in zip(cuts, cuts[1:])]
        assert repair.joined_crc(pieces) == zlib.crc32(data)
