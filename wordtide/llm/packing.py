"""Mixture-controlled packing by deficit round-robin.

Every source is a queue of documents (their token ids and an end id). A window is one
sequence of ``seq_len`` tokens. Each window adds every source's share to that source's
deficit counter, serves whole tokens up to the counter, gives the tokens left over to the
largest counters, and carries what remains to the next window. Without explicit targets
the proportions are the sources' own token shares, so all queues run dry together; with
targets, a source that runs dry leaves its share to the others.

Distribution. The queues are cut into partitions of about ``windows`` sequences at equal
steps of virtual time: by step p source s has been owed ``w_s * p * V / P`` tokens, of which
the whole part is served before the step and the fraction is the deficit that partition p
starts with. So deficits cross partitions without a sequential pass, and any task can
compute the cuts from one integer per source. A document's place in its queue is the
offset of its scan partition (prefix sum over one row per partition and source) plus the
place within it, found while tokenising; no window runs over the rows of a hot source.

The rest of a partition, less than one window, is cut into sequences whose lengths are powers
of two, so no sequence is padded. Token ids travel once, as 16-bit integers where the
vocabulary allows, in groups of bounded size. The driver holds one row per source.

Defined cases: null text counts as empty and gives the end id alone; null sources form one
queue of their own, last in order; rows that repeat an id are packed as separate documents;
an empty table gives no pieces; targets must be positive for every source present; other
columns are ignored.
"""

from __future__ import annotations

from typing import Optional

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtide.llm._common import join_null_safe, make_encoder, modest_batches, prefix_sums, stage, tokenizer_path

SEQ_LEN = 2048
EOD = 1
WINDOWS = 128  # sequences per partition


def token_queues(df: DataFrame, id_col: str, text_col: str, source_col: str,
                 tokenizer: Optional[str] = None, eod: int = EOD) -> DataFrame:
    """Tokenised rows: (_id, _source, _n, _part, _loc, _ids).

    ``_loc`` counts the tokens of the same source before the row in its scan partition
    ``_part``; ``_ids`` holds the ids as little-endian unsigned integers, of 16 bits where the
    vocabulary allows, else 32.
    """
    modest_batches(df.sparkSession)
    path = tokenizer_path(tokenizer)
    src = df.select(F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("_source"),
                    F.col(text_col).alias("_text"))
    id_type = src.schema["_id"].dataType.simpleString()

    def tokenise(batches):
        from array import array

        from pyspark import TaskContext

        part, encode, seen = TaskContext.get().partitionId(), make_encoder(path), {}
        kind = "H" if max(encode.size - 1, eod) < 1 << 16 else "I"
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                b = batch.slice(a, 256)
                sources = b.column("_source").to_pylist()
                ids, loc = [], []
                for s, enc in zip(sources, encode([t or "" for t in b.column("_text").to_pylist()])):
                    arr = array(kind, enc)
                    arr.append(eod)
                    loc.append(seen.get(s, 0))
                    seen[s] = loc[-1] + len(arr)
                    ids.append(arr.tobytes())
                n = np.array([len(x) for x in ids], dtype=np.int64) // array(kind).itemsize
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id"), pa.array(sources, pa.string()), pa.array(n), pa.array(np.full(len(n), part)),
                     pa.array(loc, pa.int64()), pa.array(ids, pa.binary())],
                    ["_id", "_source", "_n", "_part", "_loc", "_ids"])

    schema = f"_id {id_type}, _source string, _n long, _part long, _loc long, _ids binary"
    return stage(src.mapInArrow(tokenise, schema), "tokens")


class Schedule:
    """Virtual-time cuts of the queues; exact integers, one entry per source."""

    def __init__(self, totals: dict, targets: Optional[dict], tokens_per_partition: int):
        order = sorted(totals, key=lambda s: (s is None, s or ""))
        self.rank = {s: i for i, s in enumerate(order)}
        self.total = [totals[s] for s in order]
        if targets is None:
            weight = list(self.total)
        else:
            weight = [max(1, round(targets[s] * 1_000_000_000)) for s in order]
        self.parts = -(-sum(self.total) // tokens_per_partition)
        # source s is owed num[s] * p / den tokens by step p; at the last step all queues are dry
        top = max(range(len(order)), key=lambda i: (self.total[i] * weight[0] / weight[i], i)) if order else 0
        for i in range(len(order)):  # exact comparison of total/weight
            if self.total[i] * weight[top] > self.total[top] * weight[i]:
                top = i
        self.num = [w * self.total[top] for w in weight] if order else []
        self.den = weight[top] * self.parts if order else 1

    def served(self, s: int, p: int) -> int:
        return min(self.total[s], self.num[s] * p // self.den)

    def carried(self, s: int, p: int) -> float:
        """Deficit of source s at step p: what it is owed beyond whole tokens."""
        if self.served(s, p) >= self.total[s]:
            return 0.0
        return (self.num[s] * p % self.den) / self.den

    def step(self, s: int, x: int) -> int:
        """The partition that serves token x of queue s."""
        return -(-(x + 1) * self.den // self.num[s]) - 1


def window_sizes(total: int, seq_len: int) -> list[int]:
    """Whole sequences, then the rest in powers of two, largest first."""
    sizes, rest = [seq_len] * (total // seq_len), total % seq_len
    bit = 1 << max(rest.bit_length() - 1, 0)
    while rest:
        if rest & bit:
            sizes.append(bit)
            rest -= bit
        bit >>= 1
    return sizes


def round_robin(amount: np.ndarray, deficit: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Tokens that each window takes of each queue: (windows, sources); every queue ends empty."""
    left, deficit = amount.astype(np.int64).copy(), deficit.astype(float).copy()
    share = amount / max(amount.sum(), 1)
    takes = np.zeros((len(sizes), len(amount)), dtype=np.int64)
    for k, size in enumerate(sizes):
        deficit += size * share
        take = np.minimum(np.maximum(np.floor(deficit), 0).astype(np.int64), left)
        over = int(take.sum()) - size
        if over > 0:  # only by rounding: the smallest counters give back
            for s in np.argsort(deficit - take, kind="stable"):
                back = min(over, int(take[s]))
                take[s] -= back
                over -= back
                if not over:
                    break
        while over < 0:  # tokens left over go round the queues, largest counter first
            for s in np.argsort(take - deficit, kind="stable"):
                if over < 0 and left[s] > take[s]:
                    take[s] += 1
                    over += 1
        left -= take
        deficit -= take
        takes[k] = take
    return takes


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         seq_len: int = SEQ_LEN, targets: Optional[dict] = None, windows: int = WINDOWS,
         tokenizer: Optional[str] = None, eod: int = EOD) -> DataFrame:
    """Pieces of packed sequences: (id, start, length, ids, doc_tokens, sequence_id, offset, source).

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit integers. A
    sequence is the pieces of one ``sequence_id`` in order of ``offset``.
    """
    tokens = token_queues(df, id_col, text_col, source_col, tokenizer, eod)
    id_type = tokens.schema["_id"].dataType.simpleString()
    totals = {r["_source"]: r["t"] for r in tokens.groupBy("_source").agg(F.sum("_n").alias("t")).collect()}  # one row per source
    plan = Schedule(totals, targets, windows * seq_len)
    # staged, so its size is known: a small table is broadcast and the ids stay where they are
    base = stage(prefix_sums(tokens, ["_source"], "_part", "_n", "_base"), "queue-offsets")
    placed = join_null_safe(tokens, base, ["_source", "_part"]).select(
        "_id", "_source", "_n", (F.col("_loc") + F.col("_base")).alias("_q"), "_ids")

    def deal(batches):
        """Split every document at the partition steps of its queue."""
        for batch in batches:
            rows = []
            for i, (s, n, q) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("_source", "_n", "_q")))):
                s, at = plan.rank[s], 0
                while at < n:
                    p = plan.step(s, q + at)
                    cut = min(n, plan.served(s, p + 1) - q)
                    rows.append((i, p, s, q + at, at, cut - at))
                    at = cut
            if not rows:
                continue
            i, p, s, q, at, ln = (np.array(x, dtype=np.int64) for x in zip(*rows))
            ids = batch.column("_ids")
            parts = []
            for r, a, m, n in zip(i.tolist(), at.tolist(), ln.tolist(), batch.column("_n").take(pa.array(i)).to_pylist()):
                whole = ids[r].as_buffer()
                width = whole.size // n
                parts.append(whole[width * a:width * (a + m)].to_pybytes())
            idx = pa.array(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(p), pa.array(s), pa.array(q), batch.column("_id").take(idx), batch.column("_source").take(idx),
                 pa.array(at), pa.array(ln), batch.column("_n").take(idx), pa.array(parts, pa.binary())],
                ["_p", "_s", "_q", "_id", "_source", "_at", "_len", "_n", "_ids"])

    dealt = placed.mapInArrow(
        deal, f"_p long, _s long, _q long, _id {id_type}, _source string, _at long, _len long, _n long, _ids binary")
    names = ["_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "source"]

    def fill(t: pa.Table) -> pa.Table:
        """Deficit round-robin over the queues of one partition."""
        t = t.combine_chunks().sort_by([("_s", "ascending"), ("_q", "ascending")])
        p, s = t["_p"][0].as_py(), t["_s"].to_numpy()
        q, at, ln = t["_q"].to_numpy(), t["_at"].to_numpy(), t["_len"].to_numpy()
        queues, first = np.unique(s, return_index=True)
        amount = np.add.reduceat(ln, first)
        sizes = window_sizes(int(amount.sum()), seq_len)
        takes = round_robin(amount, np.array([plan.carried(int(x), p) for x in queues]), sizes)
        before = np.cumsum(takes, axis=1) - takes  # tokens of earlier queues in the window
        row, start, length, win, off = [], [], [], [], []
        for k, f in enumerate(first):
            last = first[k + 1] if k + 1 < len(first) else len(s)
            begins = q[f:last] - q[f]
            cuts = np.concatenate(([0], np.cumsum(takes[:, k])))
            edges = np.unique(np.concatenate((begins, cuts)))
            edges, ends = edges[:-1], edges[1:]
            r = np.searchsorted(begins, edges, "right") - 1
            w = np.searchsorted(cuts, edges, "right") - 1
            row.append(r + f)
            start.append(edges - begins[r])
            length.append(ends - edges)
            win.append(w)
            off.append(before[w, k] + edges - cuts[w])
        row, start, length, win, off = map(np.concatenate, (row, start, length, win, off))
        buf = t["_ids"].combine_chunks()
        ids = []
        for r, a, m in zip(row.tolist(), start.tolist(), length.tolist()):
            part = buf[r].as_buffer()
            ids.append(np.frombuffer(part, f"<u{part.size // int(ln[r])}")[a:a + m].astype("<u4").tobytes())
        idx = pa.array(row)
        return pa.Table.from_arrays(
            [t["_id"].take(idx), pa.array(start + at[row]), pa.array(length), pa.array(ids, pa.binary()),
             t["_n"].take(idx), pa.array((p << 20) + win), pa.array(off), t["_source"].take(idx)], names=names)

    out = dealt.groupBy("_p").applyInArrow(
        fill, f"_id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, source string")
    return out.withColumnRenamed("_id", id_col)


def op2_packing(spark, sf_dir: str) -> DataFrame:
    return pieces_digest(pack(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def pieces_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
