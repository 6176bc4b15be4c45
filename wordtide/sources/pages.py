"""Crawled pages as a table.

The reference fetches pages over HTTP one by one; here the crawl output is read as
data: either a Parquet table ``(url, html)`` or a folder of raw page files read
with the ``binaryFile`` source and decoded with their charset (Shift_JIS by
default).
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.sources.html import decode


def read_page_files(spark: SparkSession, path: str, charset: Optional[str] = None,
                    glob: Optional[str] = None) -> DataFrame:
    """Raw page files -> (url, body, html, fetched_at).

    ``url`` is the file path, ``fetched_at`` its modification time; ``charset``
    (default Shift_JIS) decodes the bytes, with undecodable bytes replaced.
    """
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.load(path)
    cs = F.lit(charset).cast("string")
    return files.select(F.col("path").alias("url"), F.col("content").alias("body"),
                        decode(F.col("content"), cs).alias("html"),
                        F.col("modificationTime").cast("timestamp_ntz").alias("fetched_at"))
