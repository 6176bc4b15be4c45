"""WARC archives: a writer and a sequential reader.

Writer: one gzip member per record. A record with a payload of at least ``min_revisit_bytes``
that equals others is written once in full (``response``, the row with the largest id); the
others become ``revisit`` records without payload that name it. Each scan partition writes its
own files into the shared folder, at most ``max_file_bytes`` each; the list of files comes back
as rows, so files of a task attempt that was lost are never read.

Reader: one task per file, in order from its first byte. Compressed bytes are inflated
incrementally with zlib, member by member; headers are split off, the block is framed by
Content-Length and the SHA-1 digests of block and payload are computed while reading. A
record's block is held only when ``with_payload`` asks for it; otherwise memory is bounded by
the chunk size whatever the record's length.

Plan: equal payloads are found by SHA-256 with a partial aggregate; only groups of two or more
come back, staged, in a join whose skew (a third of all pages may be one payload) AQE splits.

Defined cases: null html is the empty payload; empty payloads equal each other; rows that repeat
the largest id of a group are all ``response``; a null id counts as smaller than any other and
is ``response`` when all ids of its group are null; null urls are left out of the header; an
empty table gives no files; other columns are ignored. A truncated file or wrong framing raises;
wrong digests are reported in ``digest_ok``.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from typing import Iterator, Optional

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.llm._common import modest_batches, new_path, open_fs, stage
from wordtide.session import delete_on_exit

CHUNK = 1 << 16
MAX_FILE_BYTES = 1 << 30
MIN_REVISIT_BYTES = 0
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    return " ".join(value.split())


def record_urn(ident) -> str:
    return f"<urn:wordtide:page:{'null' if ident is None else ident}>"


def record_bytes(kind: str, ident, url: Optional[str], payload: bytes, refers_to=None) -> bytes:
    """One uncompressed WARC record of type ``response`` or ``revisit``."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_urn(ident)}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_urn(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class Inflater:
    """Bytes of a multi-member gzip stream, inflated as they are asked for."""

    def __init__(self, raw):
        self.raw, self.z, self.out, self.read, self.member_end = raw, None, bytearray(), 0, False

    def _more(self) -> bool:
        """Inflate some more of the current member; False at the end of the file or member."""
        if self.z is not None and self.z.eof:
            return False
        data = b""
        if self.z is None:
            data = self.rest if hasattr(self, "rest") and self.rest else self.raw.read(CHUNK)
            if not data:
                return False
            self.z = zlib.decompressobj(31)
        elif self.z.unconsumed_tail:
            data = self.z.unconsumed_tail
        else:
            data = self.raw.read(CHUNK)
            if not data:
                raise EOFError("the file ends within a gzip member")
        self.out += self.z.decompress(data, CHUNK)
        return True

    def next_member(self) -> bool:
        """Step past the end of the current member."""
        if self.z is not None:
            while not self.z.eof:
                if not self._more():
                    break
            self.rest, self.z = self.z.unused_data, None
        self.out.clear()
        return self._more()

    def line(self) -> bytes:
        while (at := self.out.find(b"\r\n")) < 0:
            if not self._more():
                raise ValueError("a header line has no end")
        got = bytes(self.out[:at])
        del self.out[:at + 2]
        return got

    def blocks(self, n: int) -> Iterator[bytes]:
        """Exactly n bytes, in pieces."""
        while n:
            if not self.out and not self._more():
                raise ValueError("a record is shorter than its Content-Length")
            got = bytes(self.out[:n])
            del self.out[:len(got)]
            n -= len(got)
            if got:
                yield got


def read_records(raw, with_payload: bool = False) -> Iterator[dict]:
    """Records of one WARC file in order; ``raw`` is a binary stream."""
    src = Inflater(raw)
    while src.next_member():
        if not src.line().startswith(b"WARC/"):
            raise ValueError("a gzip member does not begin with a WARC record")
        head = {}
        while line := src.line():
            key, _, value = line.decode("utf-8").partition(":")
            head[key.strip().lower()] = value.strip()
        block, payload = hashlib.sha1(), hashlib.sha1()
        http, in_http, size, kept = b"", head.get("content-type", "").startswith("application/http"), 0, []
        for piece in src.blocks(int(head["content-length"])):
            block.update(piece)
            if in_http:  # the payload begins after the HTTP header
                http += piece
                end = http.find(b"\r\n\r\n")
                if end < 0:
                    continue
                piece, http, in_http = http[end + 4:], http[:end], False
            payload.update(piece)
            size += len(piece)
            if with_payload:
                kept.append(piece)
        if b"".join(src.blocks(4)) != b"\r\n\r\n":
            raise ValueError("a record does not end where its Content-Length says")
        code = lambda h: "sha1:" + base64.b32encode(h.digest()).decode()
        ok = head.get("warc-block-digest", code(block)) == code(block)
        if head["warc-type"] != "revisit":
            ok &= head.get("warc-payload-digest", code(payload)) == code(payload)
        full = [int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        yield {"record_type": head["warc-type"], "record_id": head.get("warc-record-id"), "url": head.get("warc-target-uri"),
               "refers_to": head.get("warc-refers-to"), "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha1:"),
               "payload_bytes": full[0] if head["warc-type"] == "revisit" and full else size, "digest_ok": ok,
               "payload": b"".join(kept) if with_payload else None}


def with_revisits(df: DataFrame, id_col: str, url_col: str, body_col: str, min_revisit_bytes: int) -> DataFrame:
    """(_id, _url, _body, _refers): ``_refers`` is the id of the response that a revisit names."""
    rows = df.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"),
                     F.coalesce(F.col(body_col).cast("binary"), F.lit(b"")).alias("_body"))
    rows = rows.withColumn("_key", F.sha2("_body", 256))
    same = rows.where(F.octet_length("_body") >= min_revisit_bytes).groupBy("_key").agg(
        F.max("_id").alias("_refers"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    same = stage(same, "same-payload")
    out = rows.join(same, "_key", "left").drop("_key")
    return out.withColumn("_refers", F.when(~F.col("_id").eqNullSafe(F.col("_refers")), F.col("_refers")))


def write_warc(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
               min_revisit_bytes: int = MIN_REVISIT_BYTES, max_file_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """Write archives into ``folder``; returns the staged list of files (path, records, bytes)."""
    modest_batches(df.sparkSession)
    rows = with_revisits(df, id_col, url_col, body_col, min_revisit_bytes)

    def write(batches):
        from pyspark import TaskContext

        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)
        part, out, files, path = TaskContext.get().partitionId(), None, [], None

        def close():
            out.close()
            files.append((path, records, written))

        for b in batches:
            for ident, url, body, refers in zip(*(b.column(c) for c in ("_id", "_url", "_body", "_refers"))):
                if out is None:
                    path = f"{root}/part-{part:06d}-{uuid.uuid4().hex}.warc.gz"
                    out, records, written = fs.open_output_stream(path), 0, 0
                refers = refers.as_py()
                data = gzip_member(record_bytes("response" if refers is None else "revisit", ident.as_py(), url.as_py(),
                                                body.as_py(), refers))
                out.write(data)
                records, written = records + 1, written + len(data)
                if written >= max_file_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        if files:
            p, r, w = zip(*files)
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(r, pa.int64()), pa.array(w, pa.int64())], ["path", "records", "bytes"])

    return stage(rows.mapInArrow(write, "path string, records long, bytes long"), "warc-files")


def read_warc(files: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Read the archives listed in ``files`` (column ``path``) record by record.

    ``folder`` names the file system the paths belong to.
    """
    def read(batches):
        fs, _ = open_fs(folder)
        for b in batches:
            for path in b.column("path").to_pylist():
                rows = []
                with fs.open_input_stream(path, buffer_size=CHUNK) as raw:
                    for rec in read_records(raw, with_payload):
                        rows.append({"path": path, **rec})
                        if len(rows) == (64 if with_payload else 4096):
                            yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    n = max(1, min(files.count(), 100_000))
    return files.select("path").repartition(n, "path").mapInArrow(
        read, "path string, record_type string, record_id string, url string, refers_to string, payload_digest string, "
              "payload_bytes long, digest_ok boolean, payload binary")


SCHEMA = pa.schema([("path", pa.string()), ("record_type", pa.string()), ("record_id", pa.string()), ("url", pa.string()),
                    ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                    ("digest_ok", pa.bool_()), ("payload", pa.binary())])


def urn_id(col: str):
    """The id that ``record_urn`` wrote."""
    return F.regexp_extract(F.col(col), r"^<urn:wordtide:page:(.*)>$", 1).try_cast("long")


def archive_round_trip(df: DataFrame, with_payload: bool = False, **options) -> DataFrame:
    """Write ``df`` as archives in the shared folder and read them back."""
    spark: SparkSession = df.sparkSession
    folder = new_path(spark, "warc")
    files = write_warc(df, folder, **options)
    delete_on_exit(spark, folder)
    return read_warc(files, folder, with_payload)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    out = archive_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    checked = F.when(F.col("digest_ok"), F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("wrong digest: "), F.col("record_id"))))
    return out.select(urn_id("record_id").alias("page_id"), "payload_bytes", checked.alias("payload_digest"), "record_type",
                      urn_id("refers_to").alias("refers_to"))


# SHA-1 is not in DuckDB, so the query is tested against hashlib instead.
