"""Separator scan against the tokenizer and against a byte-wise brute force."""

import os

import numpy as np
import pytest

from wordtide.llm import token_count
from wordtide.llm._common import make_encoder, new_path, open_fs, tokenizer_path

SF = "/root/testdata/sf0.001"


def counts(texts):
    return [len(x) for x in make_encoder(tokenizer_path(), special_as_text=True)([t or "" for t in texts])]


def test_query_on_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = dict(zip([r.doc_id for r in docs], counts([r.text for r in docs])))
    assert {r.doc_id: r.n_tokens for r in token_count.op6_token_counts(spark, SF).collect()} == want


def test_cases_small_blocks(spark):
    rows = [(1, "a b c", 0), (2, None, 0), (3, "", 0), (3, "", 0), (4, "<|endoftext|>", 0), (5, "word " * 500, 0), (None, "x", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ordinal int")
    out = token_count.token_counts(df, block_bytes=16).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in out) == sorted((r[0] or 0, n) for r, n in zip(rows, counts([r[1] for r in rows])))
    assert token_count.token_counts(df.limit(0)).collect() == []


@pytest.mark.parametrize("block", [2, 6, 64, 1 << 20])
def test_scan_against_brute_force(spark, block):
    rng = np.random.default_rng(block)
    folder = new_path(spark, "flat-test")
    fs, root = open_fs(folder)
    fs.create_dir(root, recursive=True)
    files, want = [], set()
    for k in range(4):
        ids = rng.choice([9, 9, 9, 7], 200 if k else 0).astype("<u2")
        ids[50:150] = 9
        path = os.path.join(root, f"f{k}")
        with fs.open_output_stream(path) as f:
            f.write(ids.tobytes())
        files.append((path, len(ids) * 2))
        first = ordinal = 0
        for i, x in enumerate(ids):
            if x == 7:
                want.add((path, ordinal, first, i - first, True))
                first, ordinal = i + 1, ordinal + 1
        if first < len(ids):
            want.add((path, ordinal, first, len(ids) - first, False))
    df = spark.createDataFrame(files, "path string, bytes long")
    got = [tuple(r) for r in token_count.scan_flat(df, folder, eod=7, block_bytes=block).collect()]
    assert len(got) == len(set(got)) and set(got) == want
