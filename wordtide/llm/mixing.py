"""Mixing sources to target weights with fixed-length blocks.

Method: the words of each source form a stream that is cut into blocks of ``block_words``
words (the last may be shorter). A source with target t over n words takes its slots as
whole passes over its blocks plus a part of one more pass. Output shards draw their source
counts from a multinomial over what the sources still have to give, so the shard counts
are random and the totals come out exactly. Slot j of a source in pass e reads block
perm_e(j), a keyed pseudorandom permutation of the block indices (a Feistel network with
cycle walking); the last slot of a part pass is trimmed to the words still due. Slots and
blocks are joined on (source, block index).

Distribution. Sizes are counted where the texts are read; from then on only numbers move.
Stream offsets are prefix sums over one row per (source, scan partition). The driver
holds one row per source and one per (shard, source). Slots are generated in tasks from
ranges of at most ``SLOT_RANGE`` slots, and block indices spread over the join, so a source
with a third of all rows is no hot key.

Targets: the weights share the total of all sizes; a target above ``max_repeat`` times its
source is cut there and the excess goes to the other sources by weight, until none is above.

Defined cases: null or empty texts have size 0 and are never taken; null sources form one source
of their own, last in order; rows that repeat an id are separate documents; a table without
words has targets 0; other columns are ignored. Reruns with the same seed agree.
"""

from __future__ import annotations

from fractions import Fraction
from typing import Optional

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtide.llm._common import free_name, join_null_safe, modest_batches, prefix_sums, stage

BLOCK_WORDS = 64
SHARD_BLOCKS = 1 << 18
SLOT_RANGE = 1 << 16
MAX_REPEAT = 3
SEED = 20240501

#: bytes that separate words: space and \t \n \v \f \r
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def word_starts(data: bytes) -> np.ndarray:
    """Byte offsets at which words of the text begin."""
    b = np.frombuffer(data, dtype=np.uint8)
    word = ~SPACES[b]
    return np.flatnonzero(word & np.concatenate(([True], ~word[:-1]))) if len(b) else np.zeros(0, np.int64)


def sized(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(_id, _source, _size, _part, _row, _loc): word counts and the place within the scan partition's stream."""
    modest_batches(df.sparkSession)
    src = df.select(F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("_source"),
                    F.col(text_col).cast("binary").alias("_text"))
    id_type = src.schema["_id"].dataType.simpleString()

    def count(batches):
        from pyspark import TaskContext

        part, seen, row = TaskContext.get().partitionId(), {}, 0
        for b in batches:
            size = np.array([len(word_starts(t.as_buffer())) if t.is_valid else 0 for t in b.column("_text")], dtype=np.int64)
            loc = []
            for s, n in zip(b.column("_source").to_pylist(), size.tolist()):
                loc.append(seen.get(s, 0))
                seen[s] = loc[-1] + n
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_source"), pa.array(size), pa.array(np.full(len(size), part)),
                 pa.array(np.arange(row, row + len(size))), pa.array(loc, pa.int64())],
                ["_id", "_source", "_size", "_part", "_row", "_loc"])
            row += len(size)

    return stage(src.mapInArrow(count, f"_id {id_type}, _source string, _size long, _part long, _row long, _loc long"), "sizes")


def targets(sizes: dict, weights: Optional[dict] = None, max_repeat: int = MAX_REPEAT) -> dict:
    """Target words per source, exact fractions. Default weights 1, 2, 3, repeating in code-point order, null last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weights = weights or {s: i % 3 + 1 for i, s in enumerate(order)}
    out, open_, rest = {}, list(order), Fraction(sum(sizes.values()))
    while open_:
        total = sum(Fraction(weights[s]) for s in open_)
        over = [s for s in open_ if rest * Fraction(weights[s]) / total > max_repeat * sizes[s]]
        if not over:
            return out | {s: rest * Fraction(weights[s]) / total for s in open_}
        for s in over:
            out[s] = Fraction(max_repeat * sizes[s])
        rest -= sum(out[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    return out


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = (x ^ np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Keyed permutation of range(n), elementwise: four Feistel rounds, walking cycles back into range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, bits = np.uint64((1 << half) - 1), np.uint64(half)
    x = index.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> bits, x[todo] & mask
        for r in range(4):
            left, right = right, left ^ (_mix(right, (key * 4 + r + 1) & 0xFFFFFFFFFFFFFFFF) & mask)
        x[todo] = (left << bits) | right
        todo = todo[x[todo] >= n]
    return x.astype(np.int64)


def place(value: int, n: int, key: int) -> int:
    """The index that ``permute`` sends to ``value``: its rounds backwards, walking the cycle the other way."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, bits = np.uint64((1 << half) - 1), np.uint64(half)
    x = np.array([value], dtype=np.uint64)
    while True:
        left, right = x >> bits, x & mask
        for r in reversed(range(4)):
            left, right = right ^ (_mix(left, (key * 4 + r + 1) & 0xFFFFFFFFFFFFFFFF) & mask), left
        x = (left << bits) | right
        if x[0] < n:
            return int(x[0])


class Plan:
    """Slots per source. ``size`` words in ``blocks`` blocks; ``passes`` whole passes, then ``part`` slots of
    the next, the last of them trimmed to ``trim`` words (0: not trimmed)."""

    def __init__(self, sizes: dict, goal: dict, block_words: int, seed: int):
        self.order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
        self.sizes, self.goal, self.words, self.seed = sizes, goal, block_words, seed
        self.blocks = [-(-sizes[s] // block_words) for s in self.order]
        self.passes, self.part, self.trim, self.slots = [], [], [], []
        for i, s in enumerate(self.order):
            quota = round(goal[s])
            whole, due = divmod(quota, sizes[s]) if sizes[s] else (0, 0)
            part, trim = self._part(i, whole, due)
            self.passes.append(whole)
            self.part.append(part)
            self.trim.append(trim)
            self.slots.append(whole * self.blocks[i] + part)

    def key(self, source: int, turn: int) -> int:
        return (self.seed * 1_000_003 + source * 8191 + turn) & 0x3FFFFFFFFFFFFFFF

    def _part(self, i: int, turn: int, due: int) -> tuple[int, int]:
        if not due:
            return 0, 0
        n, short = self.blocks[i], self.sizes[self.order[i]] % self.words
        slots = -(-due // self.words)
        if short:  # one block is short: if it is among the slots, they may lack words
            at = place(n - 1, n, self.key(i, turn))
            if at < slots:
                have = (slots - 1) * self.words + short
                if have < due:
                    return slots + 1, due - have
                if at == slots - 1:
                    return slots, due - (slots - 1) * self.words
                return slots, due - ((slots - 2) * self.words + short)
        return slots, due - (slots - 1) * self.words

    def draw(self, shard_blocks: int) -> list[tuple[int, int, int, int]]:
        """(shard, source, first slot, slots): each shard draws from a multinomial over what is left."""
        rng = np.random.default_rng(self.seed)
        left, given, out, shard = np.array(self.slots, dtype=np.int64), np.zeros(len(self.slots), dtype=np.int64), [], 0
        while left.sum():
            room = min(shard_blocks, int(left.sum()))
            take = np.zeros_like(left)
            while room:
                open_ = left - take
                got = np.minimum(rng.multinomial(room, open_ / open_.sum()), open_)
                take += got
                room -= int(got.sum())
            out += [(shard, int(i), int(given[i]), int(take[i])) for i in np.flatnonzero(take)]
            given += take
            left -= take
            shard += 1
        return out


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Optional[dict] = None, max_repeat: int = MAX_REPEAT, block_words: int = BLOCK_WORDS,
        shard_blocks: int = SHARD_BLOCKS, seed: int = SEED):
    """(documents, spans, plan).

    documents: (_id, _source, _size, _part, _row, _loc), one row per input row.
    spans: what the mix is made of, in words: (shard, slot, source, turn, block, _part, _row, word, words),
    the ``words`` words from ``word`` of the document at (_part, _row), in slot ``slot`` of the shard and
    pass ``turn`` over the source.
    """
    spark = df.sparkSession
    docs = sized(df, id_col, text_col, source_col)
    sizes = {r["_source"]: r["t"] for r in docs.groupBy("_source").agg(F.sum("_size").alias("t")).collect()}  # one row per source
    plan = Plan(sizes, targets(sizes, weights, max_repeat), block_words, seed)
    rank = {s: i for i, s in enumerate(plan.order)}
    base = prefix_sums(docs, ["_source"], "_part", "_size", "_base")
    ranks = spark.createDataFrame([(s, i) for s, i in rank.items()] or [(None, 0)], "_source string, _s int")
    at = join_null_safe(docs, base, ["_source", "_part"]).select(
        "_part", "_row", "_size", "_source", (F.col("_loc") + F.col("_base")).alias("_q"))
    at = join_null_safe(at.where("_size > 0"), ranks, ["_source"]).drop("_source")
    whole = F.sequence(F.floor(F.col("_q") / block_words), F.floor((F.col("_q") + F.col("_size") - 1) / block_words))
    pieces = at.select("_part", "_row", "_size", "_s", "_q", F.explode(whole).alias("_block"))

    draws = [(sh, s, f + k, min(n - k, SLOT_RANGE), k) for sh, s, f, n in plan.draw(shard_blocks) for k in range(0, n, SLOT_RANGE)]
    ranges = spark.createDataFrame(draws or [(0, 0, 0, 0, 0)], "_shard long, _s int, _first long, _slots long, _k long")
    ranges = ranges.repartition(max(1, min(len(draws), 4096)))

    def slots(batches):
        for b in batches:
            for shard, s, first, n, _ in zip(*(b.column(c).to_pylist() for c in b.schema.names)):
                if not n:
                    continue
                j = np.arange(first, first + n)
                turn, idx = np.divmod(j, plan.blocks[s])
                block = np.concatenate([permute(idx[turn == e], plan.blocks[s], plan.key(s, int(e))) for e in np.unique(turn)])
                take = np.full(n, block_words, dtype=np.int64)
                if plan.trim[s] and first + n == plan.slots[s]:
                    take[-1] = plan.trim[s]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, shard)), pa.array(j), pa.array(np.full(n, s, dtype=np.int32)), pa.array(turn), pa.array(block), pa.array(take)],
                    ["shard", "slot", "_s", "turn", "_block", "_take"])

    slot = ranges.mapInArrow(slots, "shard long, slot long, _s int, turn long, _block long, _take long")
    begin = F.greatest(F.col("_q"), F.col("_block") * block_words)
    end = F.least(F.col("_q") + F.col("_size"), F.col("_block") * block_words + F.col("_take"))
    # the slots' size is not known to the planner: never broadcast them
    spans = pieces.join(slot.hint("merge"), ["_s", "_block"]).select(
        "shard", "slot", F.col("_s").alias("source"), "turn", F.col("_block").alias("block"), "_part", "_row",
        (begin - F.col("_q")).alias("word"), (end - begin).alias("words")).where("words > 0")
    return docs, spans, plan


def taken_words(docs: DataFrame, spans: DataFrame, plan: Plan) -> DataFrame:
    """docs with ``source_size``, ``target`` and ``taken``."""
    spark = docs.sparkSession
    taken = spans.groupBy("_part", "_row").agg(F.sum("words").alias("taken"))
    rows = [(s, plan.sizes[s], float(plan.goal[s])) for s in plan.order] or [(None, 0, 0.0)]
    info = spark.createDataFrame(rows, "_source string, source_size long, target double")
    out = docs.join(taken, ["_part", "_row"], "left")
    return join_null_safe(out, info, ["_source"]).withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def mixed_rows(df: DataFrame, text_col: str = "text", chars_col: str = "n_chars", **options) -> DataFrame:
    """``df`` as the mix takes it: one row per document taken, its text made of the words taken, pass after pass.

    Pieces keep the white space between their words; a line break stands between pieces that were apart. The
    rows are numbered in a staged copy, so texts and spans meet by an unambiguous key.
    """
    key_, text_, parts_ = (free_name(df, c) for c in ("_key", "_text", "_parts"))
    rows = stage(df.withColumn(key_, F.monotonically_increasing_id()), "numbered")
    docs, spans, _ = mix(rows, key_, text_col, **options)
    key = docs.select("_part", "_row", F.col("_id").alias(key_))
    parts = spans.join(key, ["_part", "_row"]).groupBy(key_).agg(F.collect_list(F.struct("turn", "word", "words")).alias(parts_))
    names = [c for c in df.columns if c not in (text_col, chars_col)]
    src = rows.join(stage(parts, "taken-words"), key_).select(*names, F.col(text_col).cast("binary").alias(text_), parts_)

    def cut(batches):
        for b in batches:
            texts = []
            for text, parts in zip(b.column(text_), b.column(parts_).to_pylist()):
                body = text.as_buffer().to_pybytes()
                at = np.append(word_starts(body), len(body))
                out, last = [], None
                for turn, word, n in sorted((p["turn"], p["word"], p["words"]) for p in parts):
                    if out and last != (turn, word) and not out[-1][-1:].isspace():
                        out.append(b"\n")
                    out.append(body[at[word]:at[word + n]])
                    last = (turn, word + n)
                texts.append(b"".join(out).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(texts, pa.string())], [*names, text_col])

    kinds = dict(df.dtypes)
    out = src.mapInArrow(cut, ", ".join(f"`{c}` {kinds[c]}" for c in names) + f", `{text_col}` string")
    if chars_col in df.columns:
        out = out.withColumn(chars_col, F.length(text_col).cast(kinds[chars_col]))
    return out.select(*df.columns)


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    out = taken_words(*mix(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return out.select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target", "taken")
