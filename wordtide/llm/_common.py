"""Helpers shared by the operators: Arrow batches, prefix sums, null-safe joins, tokenizers, file access."""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordtide.session import new_path, stage  # noqa: F401 - shared by the operators


#: Arrow batches of this size keep several Python workers within an executor's memory.
BATCH_BYTES = 16 << 20


def modest_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by ``BATCH_BYTES`` where the session has Spark's default of 64 MB."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key).rstrip("b") == str(64 << 20):
        spark.conf.set(key, str(BATCH_BYTES))


def prefix_sums(df: DataFrame, keys: Sequence[str], block: str, value: str, out: str) -> DataFrame:
    """Start offset of every (keys, block): the sum of ``value`` over smaller blocks of the same keys.

    The window sees one row per block, never the rows themselves.
    """
    sums = df.groupBy(*keys, block).agg(F.sum(value).alias("_sum"))
    w = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*keys, block, F.coalesce(F.sum("_sum").over(w), F.lit(0).cast("long")).alias(out))


def join_null_safe(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``names`` where nulls match nulls; keeps the left side's columns of these names."""
    right = right.select(*[F.col(n).alias(f"_right_{n}") if n in names else n for n in right.columns])
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[f"_right_{n}"])
    return left.join(right, cond, how).drop(*[f"_right_{n}" for n in names])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as keep it apart from the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def tokenizer_path(path: Optional[str] = None) -> str:
    """Path of the byte-level BPE vocabulary (``tokenizers`` JSON); a parameter everywhere."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def make_encoder(path: str, special_as_text: bool = False):
    """``encode(list[str]) -> list[list[int]]`` with the ids of ``tokenizers`` for ``path``.

    ``tiktoken`` gives the same ids about four times faster when the folder also has the
    vocabulary as ranks (``*.tiktoken``). It is used for ordinary texts only: texts with
    letters beyond Latin Extended-B (Unicode tables may differ between the libraries),
    special tokens, or over a million characters, go to ``tokenizers``.
    """
    import os
    import re

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = special_as_text
    specials = [t.content for t in tok.get_added_tokens_decoder().values()]
    ranks = path[: -len(".json")] + ".tiktoken"
    fast = None
    if os.path.exists(ranks):
        import base64

        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                 special_tokens={}).encode_ordinary
    odd = re.compile("[^\x00-ɏ‐-‧]")

    def slow(text: str):
        return tok.encode(text, add_special_tokens=False).ids

    def encode(texts):
        out = []
        for t in texts:
            plain = (fast is not None and len(t) <= 1_000_000 and (t.isascii() or not odd.search(t))
                     and not any(s in t for s in specials))
            out.append(fast(t) if plain else slow(t))
        return out

    encode.size = tok.get_vocab_size()
    return encode


def open_fs(path: str):
    """(filesystem, path) for a URI or plain path of the shared folder, through ``pyarrow.fs``."""
    from pyarrow import fs

    if path.startswith("file:"):
        rest = path[len("file:"):]
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path
