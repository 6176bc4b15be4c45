"""Repeated byte strings by sparse prefix doubling.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier (smaller id, or same
document, earlier start) is removed. Strings are judged on the input and never cross documents.

Method. Positions get ranks for prefixes of growing length, 32, 64 and 100 bytes: the rank of a
longer prefix is the pair of the ranks at the position and at an offset, (r32(p), r32(p+32)) and
(r64(p), r64(p+36)). A rank is a 64-bit name of the pair, so equal prefixes have equal ranks
wherever they are found, and offsets need no join. At each length Spark sorts the (rank,
position) pairs; positions whose rank is unique drop out, the others go on to the next
length until the threshold is passed.

Sparse positions. Ranking every byte would move many times the input. Instead each window of
100 bytes is represented by its anchor, the 32-byte prefix with the smallest rank in it
(leftmost on ties), which depends on the window's bytes alone. Consecutive windows with one
anchor form a run (about 32 windows), and two equal windows lie in runs with equal anchors
at equal distance.

  32 bytes: runs are sorted by (anchor rank, name of the run's bytes, position). A run equal to
     an earlier one is repeated as a whole. Runs that share the anchor only are open.
  64 bytes: windows of an open run contain the 64 bytes from the anchor on, or the 64 from 32
     before it. Each half of the run is sorted by that rank; unique ones drop out.
  100 bytes: the windows left are compared by (distance to the anchor, rank).

Skew. Each map task sorts its own rows first and sends one row per distinct run, so copies that
hold a third of all rows become one row per 8 MB of text. An anchor with many different runs in one
task is known to be open there: one row is sent on its behalf, and the others go straight to
the next length. At 64 bytes groups over ``HOT`` rows send their windows, deduplicated per batch,
to a sort by the 100-byte rank. All sorted streams are read with constant memory.

The text itself is exchanged once, by id, in the last job (both joins share the exchange).

Defined cases: null text is empty; texts under 100 bytes lose nothing; rows that repeat an id
count in order of their text, and equal rows in arbitrary order; null ids come first; ids that are
not integers are compared as their type sorts; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.llm._common import modest_batches, stage

LENGTH = 100
ANCHOR = 32
WIDE = 64
PER_WINDOW = LENGTH - ANCHOR + 1  # anchors that a window can have
SPLIT = LENGTH - WIDE - 2         # windows up to this distance contain the 64 bytes from the anchor on
SEGMENT = 1 << 20
LOT = 8 << 20
LOCAL_OPEN = 64
HOT = 4096

_M, _G = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Name of the pair (a, b) of ranks."""
    x = (a * _M) ^ (b + (b << np.uint64(31)))
    x = (x ^ (x >> np.uint64(32))) * _G
    return x ^ (x >> np.uint64(29))


def ranks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the 32-byte and 64-byte prefixes at every position that has them."""
    r, h, r32 = (data.astype(np.uint64) + np.uint64(1)) * _G, 1, None
    while h < WIDE:
        if len(r) <= h:
            empty = np.zeros(0, np.uint64)
            return (r if h == ANCHOR else r32 if r32 is not None else empty), empty
        r = pair(r[:-h], r[h:])
        h *= 2
        if h == ANCHOR:
            r32 = r
    return r32, r


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        a = np.minimum(a[:-span], a[span:])
        span *= 2
    return np.minimum(a[:len(a) - (width - span)], a[width - span:]) if width > span else a


def runs(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, windows, anchor distance, anchor rank, name) of the runs of one text segment."""
    r32, r64 = ranks(data)
    place = np.uint64((1 << 21) - 1)
    low = sliding_min((r32 & ~place) | np.arange(len(r32), dtype=np.uint64), PER_WINDOW)
    start = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
    n = np.diff(np.concatenate((start, [len(low)])))
    at = (low[start] & place).astype(np.int64)
    end = start + n + LENGTH - 1
    middle = np.minimum(start + WIDE - 12, end - WIDE)
    name = pair(pair(r64[start], r64[middle]), pair(r64[end - WIDE], ((at - start) * 128 + n).astype(np.uint64)))
    return start, n, at - start, r32[at], name


def cover(start: np.ndarray, n: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge intervals [start, start + n + gap): (begins, ends) of the maximal ones."""
    order = np.argsort(start, kind="stable")
    begin, end = start[order], np.maximum.accumulate(start[order] + n[order] + gap)
    first = np.concatenate(([True], begin[1:] > end[:-1]))
    return begin[first], end[np.concatenate((first[1:], [True]))]


def packed(start, n, dist):
    """start, windows and anchor distance of a run in one integer."""
    return (start << 14) | (n << 7) | dist


def unpacked(x):
    return x >> 14, (x >> 7) & 127, x & 127


# kinds of rows in the first exchange
SENT, SENT_OPEN, REPEATED, OPEN = 0, 1, 2, 3


def _run_rows(batches):
    """Documents -> runs (kind, rank, name, key, run), deduplicated within lots of about 8 MB."""
    def flush(lot):
        key, start, n, dist, rank, name = (np.concatenate(x) for x in zip(*lot))
        order = np.lexsort((start, key, name, rank))
        key, run, rank, name = key[order], packed(start, n, dist)[order], rank[order], name[order]
        same = np.concatenate(([False], (rank[1:] == rank[:-1]) & (name[1:] == name[:-1])))
        kind = np.where(same, REPEATED, SENT)
        group = np.cumsum(np.concatenate(([True], rank[1:] != rank[:-1]))) - 1
        distinct = np.bincount(group, weights=~same)
        first = np.concatenate(([True], group[1:] != group[:-1]))
        many = (distinct > LOCAL_OPEN)[group] & ~same
        kind[many & ~first] = OPEN
        kind[many & first] = SENT_OPEN
        done = kind >= REPEATED  # needs no meeting: spread by position
        rank = np.where(done, pair(key.astype(np.uint64), run.astype(np.uint64)), rank)
        for i in range(0, len(key), 1 << 17):
            s = slice(i, i + (1 << 17))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind[s]), pa.array(rank[s].view(np.int64)), pa.array(name[s].view(np.int64)), pa.array(key[s]), pa.array(run[s])],
                ["kind", "rank", "name", "key", "run"])

    lot, size = [], 0
    for b in batches:
        for key, text in zip(b.column("key").to_pylist(), b.column("text")):
            if not text.is_valid:
                continue
            data = np.frombuffer(text.as_buffer(), np.uint8)
            for a in range(0, len(data) - LENGTH + 1, SEGMENT):
                start, n, dist, rank, name = runs(data[a:a + SEGMENT + LENGTH - 1])
                lot.append((np.full(len(start), key), start + a, n, dist, rank, name))
            size += len(data)
            if size >= LOT and lot:
                yield from flush(lot)
                lot, size = [], 0
    if lot:
        yield from flush(lot)


def _meet_runs(batches):
    """Runs sorted by (rank, name, key, run) -> (open, key, run): repeated runs and open runs.

    A run whose name the row before has is repeated. The first run of a name is open when the rank has another name;
    for the first name of a rank that shows later, so one row is held back.
    """
    last, held = None, None  # rank and name of the row before; first row of the rank, while it may be unique
    for b in batches:
        kind, rank, name, key, run = (b.column(c).to_numpy() for c in ("kind", "rank", "name", "key", "run"))
        if not len(kind):
            continue
        pass_on = kind >= REPEATED
        out = [np.stack((kind[pass_on] == OPEN, key[pass_on], run[pass_on]), axis=1).astype(np.int64)]
        kind, rank, name, key, run = (x[~pass_on] for x in (kind, rank, name, key, run))
        if len(kind):
            before = last or (~rank[0], 0)
            same_rank = np.concatenate(([rank[0] == before[0]], rank[1:] == rank[:-1]))
            same = same_rank & np.concatenate(([name[0] == before[1]], name[1:] == name[:-1]))
            other = same_rank & ~same
            group = np.cumsum(~same_rank)  # 0: the rank of the row before
            several = np.bincount(group, weights=other | (kind == SENT_OPEN), minlength=group[-1] + 1) > 0
            if held is not None and several[0]:
                out.append(np.array([[1, *held]], dtype=np.int64))
                held = None
            if group[-1] > 0:
                held = None
            first = ~same_rank
            opened = other | (first & several[group])
            out.append(np.stack((np.zeros(same.sum(), np.int64), key[same], run[same]), axis=1))
            out.append(np.stack((np.ones(opened.sum(), np.int64), key[opened], run[opened]), axis=1))
            if group[-1] > 0 and not several[-1]:
                i = np.flatnonzero(first)[-1]
                held = (key[i], run[i])
            last = (rank[-1], name[-1])
        rows = np.concatenate(out)
        if len(rows):
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, i].copy()) for i in range(3)], ["open", "key", "run"])


def _half_rows(batches):
    """Documents with their open runs -> halves of runs (rank, key, first, dist, bytes) by 64-byte rank."""
    for b in batches:
        lot, size = [], 0
        for key, text, want in zip(b.column("key"), b.column("text"), b.column("want")):
            if not want.is_valid:
                continue
            body, key = text.as_buffer(), key.as_py()
            start, n, dist = unpacked(want.values.to_numpy(zero_copy_only=False))
            for s, m, d in zip(start.tolist(), n.tolist(), dist.tolist()):
                cut = max(0, min(m, d - SPLIT))  # the first `cut` windows are further than SPLIT from the anchor
                if cut:
                    lot.append((key, s, d, 0, body[s:s + cut + LENGTH - 1].to_pybytes()))
                if cut < m:
                    lot.append((key, s + cut, d - cut, 1, body[s + cut:s + m + LENGTH - 1].to_pybytes()))
            size += len(want)
            if size > 20_000:
                yield _halves(lot)
                lot, size = [], 0
        if lot:
            yield _halves(lot)


def _halves(lot):
    key, first, dist, right, text = zip(*lot)
    at = np.cumsum([0, *map(len, text)])[:-1]
    dist, right = np.array(dist), np.array(right)
    _, r64 = ranks(np.frombuffer(b"".join(text), np.uint8))
    rank = pair(r64[at + dist - np.where(right, 0, ANCHOR)], right.astype(np.uint64))
    return pa.RecordBatch.from_arrays([pa.array(rank.view(np.int64)), pa.array(key, pa.int64()), pa.array(first, pa.int64()),
                                       pa.array(dist, pa.int64()), pa.array(text, pa.binary())], ["rank", "key", "first", "dist", "bytes"])


def _windows(rank, key, first, dist, text):
    """All windows of half-run rows: row index, start, distance to the anchor, 100-byte rank."""
    size = np.array([len(t) for t in text])
    at = np.cumsum(size) - size
    _, r64 = ranks(np.frombuffer(b"".join(text), np.uint8))
    n = size - LENGTH + 1
    row = np.repeat(np.arange(len(n)), n)
    j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    p = at[row] + j
    return row, first[row] + j, dist[row] - j, pair(r64[p], r64[p + LENGTH - WIDE])


def _meet_halves(batches):
    """Halves sorted by (rank, key, first) -> (hot, key, start, n, rank, name).

    hot 0: n repeated windows from start; their name only spreads them. hot 1: a window of a rank with very
    many rows, for the last sort.
    """
    def compare(rows, hot):
        rank, key, first, dist, text = rows
        row, start, d, name = _windows(*rows)
        name = pair(name, d.astype(np.uint64))
        order = np.lexsort((start, key[row], name, rank[row]))
        r, m = rank[row][order], name[order]
        again = np.concatenate(([False], (r[1:] == r[:-1]) & (m[1:] == m[:-1])))
        repeated = np.zeros(len(row), bool)
        repeated[order[again]] = True
        i = np.flatnonzero(repeated)
        if len(i):  # neighbouring windows of a row in one piece
            new = np.concatenate(([True], (row[i][1:] != row[i][:-1]) | (np.diff(i) != 1)))
            n = np.diff(np.concatenate((np.flatnonzero(new), [len(i)])))
            i = i[new]
            spread = pair(key[row[i]].astype(np.uint64), start[i].astype(np.uint64)).view(np.int64)
            yield _found(0, key[row[i]], start[i], n, np.zeros(len(i), np.int64), spread)
        if hot:
            i = np.flatnonzero(~repeated)
            yield _found(1, key[row[i]], start[i], np.ones(len(i), np.int64), rank[row[i]], name[i].view(np.int64))

    held, hot_rank = None, None
    for last, b in _with_last(batches):
        if b is not None:
            cols = [b.column(c).to_numpy() for c in ("rank", "key", "first", "dist")] + [np.array(b.column("bytes").to_pylist(), dtype=object)]
            held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
        if held is None or not len(held[0]):
            continue
        rank = held[0]
        if hot_rank is not None:  # rows that go on with a hot rank
            more = int(np.searchsorted(rank != hot_rank, True))
            if more:
                yield from compare([c[:more] for c in held], True)
                held = [c[more:] for c in held]
                rank = held[0]
            if not len(rank):
                continue
            hot_rank = None
        begin = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1])))
        size = np.diff(np.concatenate((begin, [len(rank)])))
        ready = np.ones(len(size), bool)
        hot = size > HOT
        if not last and not hot[-1]:
            ready[-1] = False  # may go on
        elif not last:
            hot_rank = rank[-1]
        several = np.flatnonzero(np.repeat(ready & ~hot & (size > 1), size))
        if len(several):
            yield from compare([c[several] for c in held], False)
        for g in np.flatnonzero(hot):
            yield from compare([c[begin[g]:begin[g] + size[g]] for c in held], True)
        held = None if ready[-1] else [c[begin[-1]:] for c in held]


def _found(hot, key, start, n, rank, name):
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), hot)), *(pa.array(x) for x in (key, start, n, rank, name))],
                                      ["hot", "key", "start", "n", "rank", "name"])


def _with_last(batches):
    for b in batches:
        yield False, b
    yield True, None


def _meet_windows(batches):
    """Rows of ``_meet_halves`` sorted by (name, rank, key, start) -> repeated windows (key, start, n).

    All but the first of a (name, rank) are repeated; rows that were decided before pass through.
    """
    last = None
    for b in batches:
        hot, name, rank, key, start, n = (b.column(c).to_numpy() for c in ("hot", "name", "rank", "key", "start", "n"))
        out = [np.stack((key[hot == 0], start[hot == 0], n[hot == 0]), axis=1)]
        name, rank, key, start, n = (x[hot == 1] for x in (name, rank, key, start, n))
        if len(name):
            before = last or (~name[0], 0)
            same = np.concatenate(([(name[0], rank[0]) == before], (name[1:] == name[:-1]) & (rank[1:] == rank[:-1])))
            last = (name[-1], rank[-1])
            out.append(np.stack((key[same], start[same], n[same]), axis=1))
        rows = np.concatenate(out)
        if len(rows):
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, i].copy()) for i in range(3)], ["key", "start", "n"])


def _keyed(df: DataFrame, id_col: str, text_col: str):
    """((key, text), ids): a unique integer key that sorts like the id, and (key, id) where they differ."""
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    if dict(docs.dtypes)["id"] in ("tinyint", "smallint", "int", "bigint"):
        repeats = docs.groupBy("id").count().where("id IS NULL OR count > 1")
        if repeats.isEmpty():
            return docs.select(F.col("id").cast("long").alias("key"), "text"), None
    # number the rows: ids repeat, or are not integers
    rows = stage(docs.orderBy("id", "text").withColumn("key", F.monotonically_increasing_id()), "numbered")
    return rows.select("key", "text"), rows.select("key", "id")


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, starts): the UTF-8 text and the packed starts (start << 8 | windows) of its repeated windows."""
    modest_batches(df.sparkSession)
    docs, ids = _keyed(df, id_col, text_col)
    sent = docs.mapInArrow(_run_rows, "kind long, rank long, name long, key long, run long")
    met = sent.repartition("rank").sortWithinPartitions("rank", "name", "key", "run").mapInArrow(_meet_runs, "open long, key long, run long")
    met = stage(met, "runs")
    opened = met.where("open = 1").groupBy("key").agg(F.collect_list("run").alias("want"))
    # a left join, so both joins of the texts share one exchange; the function skips documents without open runs
    halves = docs.join(opened.hint("merge"), "key", "left").mapInArrow(
        _half_rows, "rank long, key long, first long, dist long, bytes binary")
    found = halves.repartition("rank").sortWithinPartitions("rank", "key", "first").mapInArrow(
        _meet_halves, "hot long, key long, start long, n long, rank long, name long")
    found = found.repartition("name").sortWithinPartitions("name", "rank", "key", "start").mapInArrow(
        _meet_windows, "key long, start long, n long")
    run = F.col("run")
    starts = met.where("open = 0").select("key", F.shiftright(run, 14).alias("start"), F.shiftright(run, 7).bitwiseAND(F.lit(127)).alias("n"))
    starts = starts.unionByName(found)
    starts = starts.groupBy("key").agg(F.collect_list((F.shiftleft(F.col("start"), 8) + F.col("n"))).alias("starts"))
    out = docs.join(starts.hint("merge"), "key", "left")
    out = out.withColumn("id", F.col("key").cast(df.schema[id_col].dataType)) if ids is None else out.join(ids, "key")
    return out.select("id", "text", "starts")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_output: bool = True) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, spans, kept]): spans are (start, end) byte offsets removed,
    kept the remaining bytes."""
    rows = repeated_spans(df, id_col, text_col)
    id_type = dict(rows.dtypes)["id"]
    extra = ", spans array<struct<start: bigint, end: bigint>>, kept binary" if with_output else ""

    def remove(batches):
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "spans": [], "kept": []}
            for text, starts in zip(b.column("text"), b.column("starts")):
                body, sha, cuts = text.as_buffer(), hashlib.sha256(), []
                if starts.is_valid:
                    x = starts.values.to_numpy(zero_copy_only=False)
                    cuts = list(zip(*(c.tolist() for c in cover(x >> 8, x & 255, LENGTH - 1))))
                at, kept = 0, []
                for s, e in [*cuts, (len(body), len(body))]:
                    sha.update(memoryview(body)[at:s])
                    if with_output:
                        kept.append(body[at:s].to_pybytes())
                    at = e
                out["n_bytes"].append(len(body))
                out["n_removed"].append(sum(e - s for s, e in cuts))
                out["n_spans"].append(len(cuts))
                out["kept_sha256"].append(sha.hexdigest())
                out["spans"].append([{"start": s, "end": e} for s, e in cuts])
                out["kept"].append(b"".join(kept))
            cols = [b.column("id"), *(pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")), pa.array(out["kept_sha256"], pa.string())]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_output:
                cols += [pa.array(out["spans"], span), pa.array(out["kept"], pa.binary())]
                names += ["spans", "kept"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return rows.mapInArrow(remove, f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string{extra}").withColumnRenamed("id", id_col)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_output=False)
