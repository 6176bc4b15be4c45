"""Prefix trie of conversations, with subtree sums by the Euler-tour technique.

A node is a distinct sequence of first turns (role, text); its members are the conversations that start with it. What a
cache of shared prefixes saves is summed over subtrees.

Nodes. Turns are numbered within their conversation. Every prefix gets a key of four running sums of hashes of
(depth, turn), so equal prefixes have equal keys, and the parent's key is the key less the last turn's hashes.
Keys are checked: if the members of a key disagree in their last turn's SHA-256, another seed is taken; by induction
over the depth, agreeing keys stand for equal prefixes.

Tour. Each node has an enter and an exit arc; children are ordered by their smallest member. The arc after an enter is
the enter of the first child, or the node's own exit; the arc after an exit is the enter of the next sibling, or
the parent's exit.

List ranking. Arcs that lie in one Arrow batch and follow one another are first joined to one element (they are sorted
by smallest member and depth, so most of a conversation's path falls together). Then rounds of random mates: each element
throws a coin, and one that shows tails after one that shows heads is spliced out; about a quarter goes each round. When at most
``BASE`` elements are left the driver walks them, and the spliced ones get their places back round by round.

Sums. The weights of enter arcs (1 for a leaf; what the node saves) are summed over all earlier positions, block by
block of ``FAN``; a subtree's sum is that at its exit less that at its enter.

Skew. No step needs the turns of a conversation, the members or the children of a node in one task: numbering and
ordering run over range partitions with offsets per partition, running sums over blocks, and members are
aggregated partially. The ids that end at a node become comma-joined pieces in parallel; only hashing the pieces of one
node is sequential, as its digest demands.

Defined cases: turns are ordered by turn (null first), then role, then the SHA-256 of the text; null roles and texts are
empty; rows that repeat a turn are separate turns; rows without a conversation id belong to no conversation and make no node; a
conversation without turns is a member of the root; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordtide.llm._common import prefix_sums, stage

BASE = 2048
FAN = 4096
BLOCK = 1024
KEY = ["s1", "s2", "s3", "s4"]
NOTHING = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- turns

def positions(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``pos``, the place from 0 of each row in its group; a group may span any number of range partitions."""
    rows = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    rows = stage(rows.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()), "ordered")
    runs = rows.groupBy(*group, "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = prefix_sums(runs, group, "_part", "_n", "_before")  # a row per group and partition
    runs = runs.drop("_n").join(before, [*group, "_part"])
    return rows.join(runs, [*group, "_part"]).withColumn("pos", F.col("_row") - F.col("_first") + F.col("_before")).drop(
        "_part", "_row", "_first", "_before")


def numbered_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Staged (c, pos, digest, chars): every turn's place in its conversation, its SHA-256 and its code points."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role, text))
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("t"), role.alias("r"), F.sha2(text.cast("binary"), 256).alias("x"),
        F.length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("tie"))
    rows = positions(rows, ["c"], ["t", "r", "x", "tie"])
    digest = F.sha2(F.concat("x", "r").cast("binary"), 256)  # x has a fixed width
    return stage(rows.select("c", "pos", digest.alias("digest"), "chars"), "turns")


def rebuilt(turns: DataFrame, span: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """((c, pos, digest, chars), (c)): the first h turns of conversation c - c % span, then c's own after its first h.

    h is the CRC-32 of c's decimal text, modulo ``most``.
    """
    sizes = stage(turns.groupBy("c").agg(F.count(F.lit(1)).alias("n")), "sizes")
    h = F.crc32(F.col("c").cast("string").cast("binary")) % most
    convs = sizes.select("c", (F.col("c") - F.col("c") % span).alias("base"), h.alias("h"))
    base = sizes.select(F.col("c").alias("base"), "n")
    convs = stage(convs.join(base, "base", "left").withColumn("lent", F.least("h", F.coalesce("n", F.lit(0)))), "rebuild")
    heads = turns.where((F.col("c") % span == 0) & (F.col("pos") < most)).withColumnRenamed("c", "base")
    lent = convs.join(heads, "base").where(F.col("pos") < F.col("h")).select("c", "pos", "digest", "chars")
    own = turns.where(F.col("pos") >= h).join(convs.select("c", "h", "lent"), "c").select(
        "c", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), "digest", "chars")
    return stage(lent.unionByName(own), "rebuilt"), convs.select("c")


# ---------------------------------------------------------------- nodes

def _prefixes(turns: DataFrame, seed: int) -> DataFrame:
    """(c, d, s1..s4, p1..p4, digest, chars): keys of the prefix of d turns and of its parent."""
    rows = turns.withColumn("d", F.col("pos") + 1).withColumn("block", F.floor(F.col("pos") / BLOCK)).drop("pos")
    hashes = [F.xxhash64(F.lit(seed + k), "d", "digest") for k in (0, 1)]
    halves = [f for h in hashes for f in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]  # sums of these cannot overflow
    rows = rows.select("*", *[h.alias(f"h{k}") for k, h in enumerate(halves, 1)])
    w = Window.partitionBy("c", "block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    inner = rows.select("*", *[F.sum(f"h{k}").over(w).alias(f"i{k}") for k in range(1, 5)])
    # blocks after a conversation's first
    sums = rows.groupBy("c", "block").agg(*[F.sum(f"h{k}").alias(f"b{k}") for k in range(1, 5)])
    w = Window.partitionBy("c").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("c", "block", *[F.sum(f"b{k}").over(w).alias(f"b{k}") for k in range(1, 5)]).where("block > 0")
    out = inner.join(before, ["c", "block"], "left")
    keys = [(F.col(f"i{k}") + F.coalesce(f"b{k}", F.lit(0))) for k in range(1, 5)]
    return out.select("c", "d", "digest", "chars", *[s.alias(f"s{k}") for k, s in enumerate(keys, 1)],
                      *[(s - F.col(f"h{k}")).alias(f"p{k}") for k, s in enumerate(keys, 1)])


def make_nodes(turns: DataFrame, convs: DataFrame, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """(nodes with integer ids, (c, id of the node at which c ends))."""
    while True:
        prefixes = stage(_prefixes(turns, seed), "prefixes")
        nodes = prefixes.groupBy("d", *KEY).agg(
            F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars"),
            *[F.min(f"p{k}").alias(f"p{k}") for k in range(1, 5)], F.min("digest").alias("low"), F.max("digest").alias("high"))
        root = convs.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
            F.lit(0).cast("long").alias("d"), *[F.lit(0).cast("long").alias(k) for k in KEY], "conv_id", "n_convs",
            F.lit(0).cast("long").alias("chars"), *[F.lit(0).cast("long").alias(f"p{k}") for k in range(1, 5)],
            F.lit("").alias("low"), F.lit("").alias("high"))
        nodes = stage(nodes.unionByName(root).withColumn("id", F.monotonically_increasing_id()), "nodes")
        if nodes.where("low <> high").isEmpty():
            break
        seed += 2  # two prefixes share a key
    last = prefixes.groupBy("c").agg(F.max(F.struct("d", *KEY)).alias("k"))
    ends = convs.join(last, "c", "left").select(
        "c", *[F.coalesce(F.col(f"k.{x}"), F.lit(0).cast("long")).alias(x) for x in ("d", *KEY)])
    ends = stage(ends.join(nodes.select("d", *KEY, "id"), ["d", *KEY]).select("c", "id"), "ends")
    parents = nodes.select((F.col("d") + 1).alias("d"), *[F.col(s).alias(f"p{k}") for k, s in enumerate(KEY, 1)],
                           F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    up = nodes.where("d > 0").join(parents, ["d", "p1", "p2", "p3", "p4"]).select("id", "parent", "parent_conv_id")
    nodes = nodes.select("id", "d", "conv_id", "n_convs", "chars").join(up, "id", "left")
    return stage(nodes, "tree"), ends


# ---------------------------------------------------------------- tour

def tour(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((arc, nxt, conv_id, d), (id, n_children)): the successor of every arc; arc 2 id enters node id, 2 id + 1 leaves it."""
    kids = stage(positions(nodes.where("parent IS NOT NULL").select("parent", "conv_id", "id"), ["parent"], ["conv_id"]), "children")
    first = kids.where("pos = 0").select(F.col("parent").alias("id"), F.col("id").alias("first"))
    after = kids.alias("a").join(kids.alias("b"), (F.col("a.parent") == F.col("b.parent")) & (F.col("a.pos") + 1 == F.col("b.pos"))).select(
        F.col("a.id").alias("id"), F.col("b.id").alias("sibling"))
    rows = nodes.select("id", "parent", "conv_id", "d").join(first, "id", "left").join(after, "id", "left")
    enter, leave = F.col("id") * 2, F.col("id") * 2 + 1
    arcs = rows.select("conv_id", "d", F.explode(F.array(
        F.struct(enter.alias("arc"), F.coalesce(F.col("first") * 2, leave).alias("nxt")),
        F.struct(leave.alias("arc"), F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1).alias("nxt")))).alias("x"))
    counts = kids.groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    return arcs.select("x.arc", "x.nxt", "conv_id", "d"), counts


def join_chains(arc: np.ndarray, nxt: np.ndarray, weight: np.ndarray):
    """Chains among the given elements: per element (first of its chain, distance from it), and per first (next outside, length).

    ``nxt`` is -1 at the list's end.
    """
    order = np.argsort(arc)
    at = np.searchsorted(arc, nxt, sorter=order)
    to = order[np.minimum(at, len(arc) - 1)]
    inside = arc[to] == nxt
    source = np.arange(len(arc))
    source[to[inside]] = np.flatnonzero(inside)
    far = np.zeros(len(arc), np.int64)
    far[to[inside]] = weight[inside]
    while True:  # pointer jumping towards the first
        step = source[source]
        if (step == source).all():
            break
        far, source = far + far[source], step
    last = np.flatnonzero(~inside)
    after, length = np.full(len(arc), -1, np.int64), np.zeros(len(arc), np.int64)
    after[source[last]] = nxt[last]
    length[source[last]] = far[last] + weight[last]
    return arc[source], far, after, length


def rank(arcs: DataFrame, head: int, base: int = BASE) -> DataFrame:
    """Staged (arc, at): the place of every arc in the list that begins with ``head``; ``nxt`` is null at its end.

    Columns of ``arcs`` after (arc, nxt) only say which arcs are worth a place in one batch.
    """
    spark = arcs.sparkSession
    near = [c for c in arcs.columns if c not in ("arc", "nxt")]

    def chains(batches):
        for b in batches:
            if b.num_rows:
                arc, nxt = (b.column(c).fill_null(-1).to_numpy() for c in ("arc", "nxt"))
                first, far, after, length = join_chains(arc, nxt, np.ones(len(arc), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (arc, first, far, after, length)], ["arc", "first", "far", "nxt", "w"])

    placed = arcs.repartitionByRange(*near).sortWithinPartitions(*near) if near else arcs
    members = stage(placed.select("arc", "nxt").mapInArrow(chains, "arc long, first long, far long, nxt long, w long"), "chains")
    rows, removed, left = members.where("arc = first").select("arc", "nxt", "w"), [], None
    while True:
        left = rows.count()
        if left <= base:
            break
        seed = len(removed)
        coin = lambda c: (F.xxhash64(F.lit(seed), c).bitwiseAND(F.lit(1)) == 1) | (F.col(c) == head)
        a = rows.select("arc", "nxt", "w", coin("arc").alias("up"))
        b = rows.select(F.col("arc").alias("nxt"), F.col("nxt").alias("nxt2"), F.col("w").alias("w2"), coin("arc").alias("up2"))
        splice = F.col("up") & ~F.coalesce("up2", F.lit(True))
        row = lambda arc, nxt, w, pred: F.struct(F.col(arc).alias("arc"), nxt.alias("nxt"), w.alias("w"), pred.alias("pred"))
        none = F.lit(None).cast("long")
        out = F.when(splice, F.array(
            row("arc", F.col("nxt2"), F.col("w") + F.col("w2"), none), row("nxt", none, F.col("w"), F.col("arc"))))
        out = out.when(F.col("up"), F.array(row("arc", F.col("nxt"), F.col("w"), none)))
        out = out.when(~F.coalesce("up2", F.lit(True)), F.array(row("nxt", F.col("nxt2"), F.col("w2"), none)))
        mated = stage(a.join(b, "nxt", "left").select(F.explode(out).alias("x")).select("x.*"), "mates")
        rows = mated.where("pred IS NULL").drop("pred")
        removed.append(mated.where("pred IS NOT NULL").select("arc", "pred", F.col("w").alias("off")))
    follow = {r.arc: (r.nxt, r.w) for r in rows.collect()}  # at most ``base`` rows
    spots, at, arc = [], 0, head
    while follow:
        spots.append((arc, at))
        nxt, w = follow.pop(arc)
        arc, at = nxt, at + w
    spots = spark.createDataFrame(spots, "arc long, at long")
    for gone in reversed(removed):
        back = gone.join(spots.withColumnRenamed("arc", "pred"), "pred").select("arc", (F.col("at") + F.col("off")).alias("at"))
        spots = stage(spots.unionByName(back), "places")
    return stage(members.join(spots.withColumnRenamed("arc", "first"), "first").select("arc", (F.col("at") + F.col("far")).alias("at")), "ranks")


def sums_before(df: DataFrame, n: int, values: list[str], fan: int = FAN) -> DataFrame:
    """``df`` (at from 0 to n - 1, values) with each value replaced by its sum over all smaller ``at``."""
    block = df.withColumn("_block", F.floor(F.col("at") / fan))
    w = Window.partitionBy("_block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    inner = block.select(*[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(c) if c in values else c for c in block.columns])
    if n <= fan:
        return inner.drop("_block")
    totals = stage(block.groupBy(F.col("_block").alias("at")).agg(*[F.sum(c).alias(c) for c in values]), "block-sums")
    before = sums_before(totals, -(-n // fan), values, fan).select(F.col("at").alias("_block"), *[F.col(c).alias(f"_{c}") for c in values])
    return inner.join(before, "_block").select(*[(F.col(c) + F.col(f"_{c}")).alias(c) if c in values else c for c in df.columns])


def ends_digest(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256): the SHA-256 of each node's ending conversations, ascending, comma-joined."""
    def pieces(batches):
        for b in batches:
            node, c = (b.column(x).to_numpy() for x in ("id", "c"))
            edge = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1]))) if len(node) else np.zeros(0, int)
            text = c.astype(str).tolist()
            stop = [*edge[1:].tolist(), len(node)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[edge]), pa.array(c[edge]), pa.array([",".join(text[i:j]) for i, j in zip(edge.tolist(), stop)], pa.string())],
                ["id", "c", "piece"])

    def digests(batches):
        node, sha = None, None
        for b in batches:
            ids, out = [], []
            for i, piece in zip(b.column("id").to_pylist(), b.column("piece").to_pylist()):
                if i == node:
                    sha.update(b",")
                else:
                    if sha:
                        ids.append(node)
                        out.append(sha.hexdigest())
                    node, sha = i, hashlib.sha256()
                sha.update(piece.encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.string())], ["id", "ends_sha256"])
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([sha.hexdigest()])], ["id", "ends_sha256"])

    joined = ends.select("id", "c").repartitionByRange("id", "c").sortWithinPartitions("id", "c").mapInArrow(pieces, "id long, c long, piece string")
    return joined.repartition("id").sortWithinPartitions("id", "c").mapInArrow(digests, "id long, ends_sha256 string")


# ---------------------------------------------------------------- interface

def trie(turns: DataFrame, convs: DataFrame, base: int = BASE, fan: int = FAN) -> DataFrame:
    """The trie of (c, pos, digest, chars) with all conversations (c), one row per node."""
    nodes, ends = make_nodes(turns, convs)
    top = nodes.where("d = 0").select("id").head()
    out = ["conv_id long", "depth long", "parent_conv_id long", "n_convs long", "n_children long", "n_leaves long", "saved_tokens long", "ends_sha256 string"]
    if top is None:
        return turns.sparkSession.createDataFrame([], ", ".join(out))
    arcs, children = tour(nodes)
    children = stage(children, "child-counts")
    places = rank(arcs, 2 * top.id, base)
    known = nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    known = known.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars"))
    weights = known.select((F.col("id") * 2).alias("arc"), F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"), "saved")
    line = stage(places.join(weights, "arc", "left").na.fill(0, ["leaves", "saved"]), "tour")
    sums = sums_before(line, 2 * nodes.count(), ["leaves", "saved"], fan)
    # weights are not negative, so the larger sum is the exit's
    spans = sums.groupBy(F.shiftright("arc", 1).alias("id")).agg(
        (F.max("leaves") - F.min("leaves")).alias("n_leaves"), (F.max("saved") - F.min("saved")).alias("saved_tokens"))
    result = known.join(spans, "id").join(ends_digest(ends), "id", "left")
    return result.select("conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                         F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))


def prefix_trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of the conversations of ``df`` as they are."""
    turns = numbered_turns(df, conv, turn, role, text)
    return trie(turns, turns.select("c").distinct())


def with_turns(nodes: DataFrame, df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Nodes of ``prefix_trie(df)`` with the role and text of their last turn (null at the root)."""
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("_t"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("_tie"))
    rows = rows.withColumn("_x", F.sha2(F.col("text").cast("binary"), 256))
    rows = positions(rows, ["conv_id"], ["_t", "role", "_x", "_tie"]).select("conv_id", (F.col("pos") + 1).alias("depth"), "role", "text")
    return nodes.join(rows, ["conv_id", "depth"], "left")


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return trie(*rebuilt(numbered_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


# fixed values: the CRC-32 of each four-bit number, polynomial 0xEDB88320
NIBBLES = [0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
           0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C]

SQL = f"""
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, r, x, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, r, sha256(x)) AS p FROM t),
k AS (
  SELECT c, c - c % 100 AS b, xor(list_reduce(
    list_concat([4294967295], flatten(list_transform(range(1, length(c::VARCHAR) + 1),
      lambda i: [ascii(substr(c::VARCHAR, i, 1)) & 15, ascii(substr(c::VARCHAR, i, 1)) >> 4]))),
    lambda a, n: xor(a >> 4, {NIBBLES}[(xor(a, n) & 15) + 1])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM t)),
a AS (
  SELECT k.c, 0 AS own, p, r, x FROM k JOIN o ON o.c = k.b AND p <= h
  UNION ALL SELECT k.c, 1, p, r, x FROM k JOIN o ON o.c = k.c AND p > h),
s AS (
  SELECT k.c, coalesce(list(struct_pack(r := r, x := x) ORDER BY own, p) FILTER (WHERE p IS NOT NULL), []) AS v
  FROM k LEFT JOIN a USING (c) GROUP BY k.c),
n AS MATERIALIZED (
  SELECT v[1:d] AS pre, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(v) = d), '') AS e
  FROM (SELECT c, v, unnest(range(0, len(v) + 1)) AS d FROM s) GROUP BY 1, 2),
w AS MATERIALIZED (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM n m WHERE m.d = n.d + 1 AND m.pre[1:m.d - 1] = n.pre) AS n_children,
         (n.n_convs - 1) * coalesce(length(n.pre[n.d].x), 0) AS saved
  FROM n LEFT JOIN n p ON p.d = n.d - 1 AND p.pre = n.pre[1:n.d - 1])
SELECT w.conv_id, w.d::BIGINT AS depth, any_value(w.parent_conv_id) AS parent_conv_id, any_value(w.n_convs) AS n_convs, any_value(w.n_children) AS n_children,
       count(*) FILTER (WHERE u.n_children = 0) AS n_leaves, CAST(sum(u.saved) AS BIGINT) AS saved_tokens, sha256(any_value(w.e)) AS ends_sha256
FROM w JOIN w u ON u.d >= w.d AND u.pre[1:w.d] = w.pre GROUP BY w.conv_id, w.d, w.pre
"""
