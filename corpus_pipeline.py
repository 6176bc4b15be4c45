"""The corpus pipeline: documents -> kept, deduplicated, mixed and packed training sequences.

STAGES lists (name, function). A function takes (spark, docs, sf_dir) and returns a DataFrame; each result is
written as Parquet and read again as the next stage's ``docs``. All but the last return the columns of
``documents``:

  quality       documents that the classifier rejects go (labels and sites from the tables in ``sf_dir``)
  exact_dedup   one document of equal texts stays, the one with the largest id
  near_dedup    one document of a group of near copies stays, the one with the smallest id
  mixing        texts become the words that the mix takes of them, repeats counted; untaken ones go
  packing       pieces of sequences of 2048 tokens

SQL cannot express the classifier, the mix and the tokens, so ORACLE_SQL is None; the tests replay each stage by
brute force on its own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.llm import exact_dedup, mixing, near_dedup, packing, quality
from wordtide.llm._common import stage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_rows(docs, labels, host=F.col("source"), path=F.col("lang"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_rows(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_rows(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pieces_digest(packing.pack(docs))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
