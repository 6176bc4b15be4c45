"""Raw page files as a data source (``spark.read.format("pagefiles")``).

A crawl leaves one file per page. The source lists a folder once, drops what the query's filters exclude, and plans partitions of
``partition_bytes`` (large files alone), so a million small pages are a few thousand tasks and not a million. Filters on
``path`` (equal, in, prefix, suffix) and on ``modified`` and ``size`` (comparisons) are applied to the listing, before any file is opened.
``path`` is relative to the folder. A file that is gone when it is read gives a row with a null body and the error; the others go on.

Options: ``path``; ``pattern``, a glob over relative paths; ``partition_bytes`` (default 64 MB); ``max_file_bytes`` (default 1 GB):
larger files give a null body and an error instead of more memory than a task has.
"""

from __future__ import annotations

import datetime
import fnmatch
from dataclasses import dataclass
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition,
                                    LessThan, LessThanOrEqual, StringEndsWith, StringStartsWith)

from wordtide.sources.html import decode

SCHEMA = "path string, size bigint, modified timestamp, body binary, error string"
PARTITION_BYTES = 64 << 20
MAX_FILE_BYTES = 1 << 30
#: What opening a file costs, in bytes of reading, when files are dealt to partitions.
OPEN_BYTES = 64 << 10
BATCH_BYTES = 16 << 20


def open_folder(path: str):
    """(file system, folder) of a URI or plain path."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].strip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.rstrip("/")


@dataclass
class Files(InputPartition):
    """Files of one task: (relative path, bytes, modification time)."""

    files: tuple


class PageFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pagefiles"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "PageReader":
        return PageReader(dict(self.options))


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        # option names arrive in lower case
        self.folder = options["path"]
        self.pattern = options.get("pattern", "*")
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.max_file_bytes = int(options.get("max_file_bytes", MAX_FILE_BYTES))
        self.tests: list[tuple] = []  # (column, operation, value)

    def pushFilters(self, filters):
        """Take the filters that the listing decides; Spark keeps the others."""
        kinds = {EqualTo: "=", In: "in", StringStartsWith: "prefix", StringEndsWith: "suffix", GreaterThan: ">", GreaterThanOrEqual: ">=",
                 LessThan: "<", LessThanOrEqual: "<="}
        on_path = {"=", "in", "prefix", "suffix"}
        for f in filters:
            kind, column = kinds.get(type(f)), ".".join(getattr(f, "attribute", ()))
            if kind and (column == "path" and kind in on_path or column in ("size", "modified") and kind not in ("prefix", "suffix")):
                self.tests.append((column, kind, f.value))
            else:
                yield f

    def _wanted(self, path: str, size: int, modified: datetime.datetime) -> bool:
        row = {"path": path, "size": size, "modified": modified}
        holds = {"=": lambda x, v: x == v, "in": lambda x, v: x in v, "prefix": lambda x, v: x.startswith(v), "suffix": lambda x, v: x.endswith(v),
                 ">": lambda x, v: x > v, ">=": lambda x, v: x >= v, "<": lambda x, v: x < v, "<=": lambda x, v: x <= v}
        return fnmatch.fnmatch(path, self.pattern) and all(holds[k](row[c], v) for c, k, v in self.tests)

    def listing(self):
        from pyarrow import fs

        system, root = open_folder(self.folder)
        for info in system.get_file_info(fs.FileSelector(root, recursive=True)):
            name = info.path[len(root):].lstrip("/")
            if info.type == fs.FileType.File and not any(p[:1] in "._" for p in name.split("/")):
                if self._wanted(name, info.size, info.mtime):
                    yield name, info.size, info.mtime

    def partitions(self):
        """Files in order of their paths, cut where a partition is full."""
        out, lot, held = [], [], 0
        for f in sorted(self.listing()):
            if lot and held + f[1] + OPEN_BYTES > self.partition_bytes:
                out.append(Files(tuple(lot)))
                lot, held = [], 0
            lot.append(f)
            held += f[1] + OPEN_BYTES
        return out + [Files(tuple(lot))] if lot or not out else out

    def read(self, partition: Files):
        import pyarrow as pa

        names = ["path", "size", "modified", "body", "error"]
        kinds = [pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.binary(), pa.string()]
        system, root = open_folder(self.folder)
        rows, held = [], 0
        for path, size, modified in partition.files:
            body = error = None
            if size > self.max_file_bytes:
                error = f"{size} bytes"
            else:
                try:
                    with system.open_input_stream(f"{root}/{path}") as f:
                        body = f.read()
                except OSError as e:
                    error = type(e).__name__
            rows.append((path, size, modified, body, error))
            held += len(body or b"")
            if held >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read_pages(spark: SparkSession, folder: str, charset: Optional[str] = None, **options) -> DataFrame:
    """Pages of a folder: (path, size, modified, body, html, error); ``charset`` (default Shift_JIS) decodes the bytes."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PageFiles)
    files = spark.read.format("pagefiles").options(path=folder, **options).load()
    return files.select("path", "size", "modified", "body", decode(F.col("body"), F.lit(charset).cast("string")).alias("html"), "error")


def write_pages(df: DataFrame, folder: str, path: str, body: str) -> DataFrame:
    """Write the bytes of ``body`` to the file ``path`` in ``folder``, one file a row; returns (files, bytes) per task, when it is run.

    A file is written under another name and then renamed, so a task that is tried again leaves whole files only.
    """
    def write(batches):
        import uuid

        import pyarrow as pa

        system, root = open_folder(folder)
        made, n, size = set(), 0, 0
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                target = f"{root}/{name}"
                parent = target.rpartition("/")[0]
                if parent not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                draft = f"{parent}/.{uuid.uuid4().hex}"
                with system.open_output_stream(draft) as f:
                    f.write(data or b"")
                system.move(draft, target)
                n, size = n + 1, size + len(data or b"")
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([size])], ["files", "bytes"])

    return df.select(F.col(path).alias("path"), F.col(body).alias("body")).mapInArrow(write, "files long, bytes long")
