"""Token counts by scanning flat token files for the end-of-document id.

A flat token file is nothing but token ids (little-endian, fixed width), documents one after
the other, each closed by ``eod``; there is no index. The scan cuts every file into byte blocks
of ``block_bytes``, reads each block on its own, finds the separators of the block in one
vectorised comparison, and keeps their positions. Documents that cross blocks are stitched
with a prefix scan over block summaries: the number of separators in earlier blocks gives the
ordinal of the block's first document, and the last separator before the block gives where
that document began. The scan sees one row per block, so a document longer than many blocks
costs nothing extra, and no task holds more than a block.

Writer: each scan partition writes its own files in the shared folder; the file list and a side
table (path, ordinal, id) come back as rows, so files of a lost attempt are never read.

Defined cases: null and empty texts are documents of 0 tokens; special tokens in a text are
ordinary text, so ``eod`` never occurs within a document; a file that does not end with
``eod`` has its rest as an open document (``closed`` false); an empty file has no documents; rows
that repeat an id are separate documents; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from typing import Optional

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordtide.llm._common import make_encoder, modest_batches, new_path, open_fs, stage, tokenizer_path
from wordtide.session import delete_on_exit

EOD = 50256
BLOCK_BYTES = 4 << 20
MAX_FILE_BYTES = 1 << 30


def write_flat(df: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: Optional[str] = None,
               eod: int = EOD, dtype: str = "<u2", max_file_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Tokenise and write flat files into ``folder``; returns the staged side table (_id, path, ordinal, file_bytes).

    ``file_bytes`` is set on the last row of each file.
    """
    modest_batches(df.sparkSession)
    path = tokenizer_path(tokenizer)
    src = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = src.schema["_id"].dataType.simpleString()

    def write(batches):
        from pyspark import TaskContext

        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)
        part, encode, out = TaskContext.get().partitionId(), make_encoder(path, special_as_text=True), None
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                b = batch.slice(a, 256)
                if out is None:
                    name = f"{root}/part-{part:06d}-{uuid.uuid4().hex}.bin"
                    out, ordinal, written, held = fs.open_output_stream(name), 0, 0, None
                for ids in encode([t or "" for t in b.column("_text").to_pylist()]):
                    data = np.array([*ids, eod], dtype=dtype).tobytes()
                    out.write(data)
                    written += len(data)
                if held:
                    yield side(*held, None)
                held = (b.column("_id"), name, ordinal)
                ordinal += b.num_rows
                if written >= max_file_bytes:
                    out.close()
                    out = None
                    yield side(*held, written)
        if out is not None:
            out.close()
            yield side(*held, written)

    def side(ids, name, first, size):
        n = len(ids)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([name] * n), pa.array(np.arange(first, first + n)), pa.array([None] * (n - 1) + [size], pa.int64())],
            ["_id", "path", "ordinal", "file_bytes"])

    return stage(src.mapInArrow(write, f"_id {id_type}, path string, ordinal long, file_bytes long"), "flat-side")


def scan_flat(files: DataFrame, folder: str, eod: int = EOD, dtype: str = "<u2", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents of flat files: (path, ordinal, first_token, n_tokens, closed).

    ``files`` has (path, bytes). ``first_token`` counts tokens from the file's start.
    """
    width = np.dtype(dtype).itemsize
    per = max(1, block_bytes // width)
    blocks = files.where("bytes > 0").select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("bytes") - 1) / (per * width)))).alias("block"))

    def search(batches):
        fs, _ = open_fs(folder)
        for b in batches:
            for path, size, k in zip(*(b.column(c).to_pylist() for c in ("path", "bytes", "block"))):
                if size % width:
                    raise ValueError(f"{path}: {size} bytes are not whole tokens")
                with fs.open_input_file(path) as f:
                    ids = np.frombuffer(f.read_at(min(per * width, size - k * per * width), k * per * width), dtype)
                at = np.flatnonzero(ids == eod) + k * per
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([k]), pa.array([size // width]), pa.array([at.tolist()], pa.list_(pa.int64()))],
                    ["path", "block", "tokens", "seps"])

    found = blocks.repartition("path", "block").mapInArrow(search, "path string, block long, tokens long, seps array<long>")
    # the prefix scan needs the summaries only; positions stay in the staged table
    found = stage(found, "separators")
    order = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    seen = found.select("path", "block", F.size("seps").alias("n"), F.try_element_at("seps", F.lit(-1)).alias("last")).select(
        "path", "block", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"),
        F.coalesce(F.max("last").over(order), F.lit(-1)).alias("open"))
    joined = found.join(seen, ["path", "block"])
    docs = joined.select("path", "before", "open", "seps", F.posexplode("seps").alias("i", "sep")).select(
        "path", (F.col("before") + F.col("i")).alias("ordinal"),
        F.when(F.col("i") == 0, F.col("open")).otherwise(F.try_element_at("seps", F.greatest(F.col("i"), F.lit(1)))).alias("prev"), "sep")
    closed = docs.select("path", "ordinal", (F.col("prev") + 1).alias("first_token"),
                         (F.col("sep") - F.col("prev") - 1).alias("n_tokens"), F.lit(True).alias("closed"))
    ends = found.groupBy("path").agg(F.max("tokens").alias("t"), F.sum(F.size("seps")).alias("ordinal"),
                                     F.coalesce(F.max(F.try_element_at("seps", F.lit(-1))), F.lit(-1)).alias("last"))
    rest = ends.where("last < t - 1").select("path", "ordinal", (F.col("last") + 1).alias("first_token"),
                                             (F.col("t") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(rest)


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, **options) -> DataFrame:
    """Write ``df`` as flat files, scan them, and name each document: (id, path, ordinal, first_token, n_tokens)."""
    folder = new_path(df.sparkSession, "tokens")
    side = write_flat(df, folder, id_col, text_col, **options)
    delete_on_exit(df.sparkSession, folder)
    scan = {k: v for k, v in options.items() if k in ("eod", "dtype")}
    files = side.where("file_bytes IS NOT NULL").select("path", F.col("file_bytes").alias("bytes"))
    docs = scan_flat(files, folder, block_bytes=block_bytes, **scan)
    return side.drop("file_bytes").join(docs.drop("closed"), ["path", "ordinal"]).select(
        F.col("_id").alias(id_col), "path", "ordinal", "first_token", "n_tokens")


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    out = token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_tokens", F.regexp_extract("path", r"part-(\d+)", 1).cast("long").alias("file"), "ordinal", "first_token")
