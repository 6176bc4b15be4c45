"""MinHash near-duplicates by a multi-index Hamming join.

Signature: 64 symbols of 16 bits, one per minhash of the document's set of distinct 5-word
shingles. Two documents are candidates when their signatures differ in at most 31 symbols.
The join finds every such pair: the signature is split into 16 chunks of 4 symbols, so by the
pigeonhole principle two signatures within 31 differences have a chunk with at most one.
Each document enumerates that error: for each chunk it emits the four keys that leave one
symbol out. Documents that share a key meet in a bucket. At a similarity of 0.75 a symbol
differs with probability 1/4, and more than 31 differences have a probability of 1.5e-5: so
many links of pairs at the threshold are lost, fewer above it.

Buckets. Rows are sorted by key and streamed, so no bucket is held in memory. Every row carries
the two low bits of its 64 symbols; these differ in no more places than the symbols, so a
pair above 31 is dropped at once and none within 31 is lost. A bucket of at most ``SMALL``
rows gives its few pairs. A larger one gives only its star (first row with each other) and
keeps its rows aside. When the star pairs are confirmed and joined into components, kept-aside
buckets whose rows lie in one component are finished. In the others every pair of different components
within the radius is tried. Pairs are never written out: blocks of ``SKETCH_BLOCK`` x ``SKETCH_BLOCK`` signatures
first name the rows that have a pair to try; their texts are fetched, and blocks of ``SHINGLE_BLOCK`` x
``SHINGLE_BLOCK`` shingles return only links that join components, fewer than they have rows. A pair is tried in
one bucket, the first of those that both rows have. Links inside a component are not needed for its members.

Confirmation: pairs are joined with the whole texts of both documents, and a link stands when
100 * intersection >= 75 * union of the full shingle sets (64-bit shingle hashes).

Documents with identical sets form one class first, so exact copies cost nothing. Components
come from label propagation with pointer jumping; every join has staged scans on both sides,
so AQE splits a hub. Nothing but row counts reaches the driver.

Defined cases: texts without words, empty or null have an empty set, are linked with nothing and
kept; texts of fewer than five words have their whole word sequence as the only shingle;
identical sets are linked; rows that repeat an id are all reported; a component of null ids
only has a null component_id and its rows are kept; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.llm._common import free_name, join_null_safe, modest_batches, stage

SHINGLE_WORDS = 5
PERCENT = 75
CHUNKS, CHUNK_SYMBOLS = 16, 4
SYMBOLS = CHUNKS * CHUNK_SYMBOLS
RADIUS = 2 * CHUNKS - 1
SMALL = 4
SKETCH_BLOCK = 8192
SHINGLE_BLOCK = 1 << 19
SEED = 7
CACHED_WORDS = 1 << 18


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of distinct shingle hashes of whole texts."""

    def __init__(self, words: int = SHINGLE_WORDS):
        import xxhash

        self.k, self.hash, self.cache = words, xxhash.xxh3_64_intdigest, {}

    def shingles(self, text: bytes) -> np.ndarray:
        """Sorted distinct 64-bit hashes. bytes.lower() and bytes.split() know ASCII letters and spaces only."""
        words = text.lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(self.cache) > CACHED_WORDS:
            self.cache.clear()
        cache, get = self.cache, self.hash
        ids = []
        for w in words:
            h = cache.get(w)
            if h is None:
                h = cache[w] = get(w)
            ids.append(h)
        h = np.array(ids, dtype=np.uint64)
        k = min(self.k, len(h))
        n = len(h) - k + 1
        out = np.full(n, k, dtype=np.uint64)
        for i in range(k):
            out = _mix(out + h[i:i + n]) + np.uint64(i)
        return np.unique(out)


def signature_family(seed: int = SEED):
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64))


def minhash(shingles: np.ndarray, family) -> np.ndarray:
    """64 symbols of 16 bits of a non-empty set."""
    a, b = family
    low = np.full(SYMBOLS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), 4096):
        low = np.minimum(low, (shingles[None, i:i + 4096] * a[:, None] + b[:, None]).min(axis=1))
    return (_mix(low) >> np.uint64(48)).astype("<u2")


def sketches(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two low bits of every symbol, as two 64-bit integers per row."""
    place = np.uint64(1) << np.arange(SYMBOLS, dtype=np.uint64)
    bit = lambda k: (((sig >> k) & 1).astype(np.uint64) * place).sum(axis=1, dtype=np.uint64)
    return bit(0).view(np.int64), bit(1).view(np.int64)


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """(rows, 64) keys: for each chunk its four symbols with one left out. Exact integers, no hashing."""
    s = sig.reshape(len(sig), CHUNKS, CHUNK_SYMBOLS).astype(np.int64)
    keys = []
    for out in range(CHUNK_SYMBOLS):
        a, b, c = (s[:, :, j] for j in range(CHUNK_SYMBOLS) if j != out)
        keys.append((np.arange(CHUNKS, dtype=np.int64) << 50) | (np.int64(out) << 48) | (a << 32) | (b << 16) | c)
    return np.concatenate(keys, axis=1)


def near(x0, x1, xn, y0, y1, yn, percent: int = PERCENT) -> np.ndarray:
    """Could the pair be within the radius and, by set sizes alone, similar enough?"""
    apart = np.bitwise_count(np.asarray((x0 ^ y0) | (x1 ^ y1), dtype=np.int64).view(np.uint64))  # signed counts take the absolute value
    return (apart <= RADIUS) & (100 * np.minimum(xn, yn) >= percent * np.maximum(xn, yn))


def signatures(df: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(_id, _n, _set, _sig): set size, 128-bit name of the set, signature; null for empty sets."""
    src = df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    id_type = src.schema["_id"].dataType.simpleString()

    def sign(batches):
        import xxhash

        shingler, family = Shingler(words), signature_family()
        for b in batches:
            n, names, sigs = [], [], []
            for t in b.column("_text"):
                s = shingler.shingles(t.as_py() or b"")
                n.append(len(s))
                names.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sigs.append(minhash(s, family).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(n, pa.int64()), pa.array(names, pa.binary()),
                                              pa.array(sigs, pa.binary())], ["_id", "_n", "_set", "_sig"])

    return stage(src.mapInArrow(sign, f"_id {id_type}, _n long, _set binary, _sig binary"), "signatures")


def bucket_rows(nodes: DataFrame) -> DataFrame:
    """(key, node, s0, s1, n): 64 rows per class."""
    def emit(batches):
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                c = b.slice(at, 1024)
                sig = np.frombuffer(b"".join(c.column("_sig").to_pylist()), "<u2").reshape(-1, SYMBOLS)
                s0, s1 = sketches(sig)
                keys = chunk_keys(sig)
                rep = lambda x: pa.array(np.repeat(x, keys.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), rep(c.column("_node").to_numpy()), rep(s0), rep(s1), rep(c.column("_n").to_numpy())],
                    ["key", "node", "s0", "s1", "n"])

    return nodes.select("_node", "_n", "_sig").mapInArrow(emit, "key long, node long, s0 long, s1 long, n long")


def meet(rows: DataFrame, percent: int) -> DataFrame:
    """Stream sorted buckets: candidate pairs (kind 0: a, b) and the rows of large buckets (kind 1: a = key, b = node)."""
    names, kinds = ["key", "node", "s0", "s1", "n"], ["kind", "a", "b"]

    def run(batches):
        carry, leader = None, None  # rows of the unfinished bucket; first row of a large bucket being streamed
        for last, b in _with_last(batches):
            cols = [b.column(c).to_numpy() for c in names] if b is not None else [np.zeros(0, np.int64)] * 5
            if carry is not None:
                cols = [np.concatenate(x) for x in zip(carry, cols)]
            carry = None
            key = cols[0]
            if not len(key):
                continue
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            sizes = np.diff(np.concatenate((starts, [len(key)])))
            if not last and not (leader is not None and leader[0] == key[-1]) and sizes[-1] <= SMALL:
                carry = [c[starts[-1]:] for c in cols]  # may go on in the next batch
                cols, starts, sizes = [c[:starts[-1]] for c in cols], starts[:-1], sizes[:-1]
                key = cols[0]
                if not len(key):
                    continue
            size, first = np.repeat(sizes, sizes), np.repeat(starts, sizes)
            large = size > SMALL
            head = [c[first] for c in cols]
            if leader is not None and leader[0] == key[0]:  # the bucket began in an earlier batch
                large[:sizes[0]] = True
                for h, v in zip(head, leader):
                    h[:sizes[0]] = v
            pairs = []
            _, node, s0, s1, n = cols
            star = np.flatnonzero(large & (head[1] != node))
            star = star[near(head[2][star], head[3][star], head[4][star], s0[star], s1[star], n[star], percent)]
            pairs.append(np.stack((head[1][star], node[star]), axis=1))
            for lag in range(1, SMALL):
                i = np.flatnonzero((key[:-lag] == key[lag:]) & ~large[:-lag])
                j = i + lag
                i, j = (x[near(s0[i], s1[i], n[i], s0[j], s1[j], n[j], percent)] for x in (i, j))
                pairs.append(np.stack((node[i], node[j]), axis=1))
            pairs = np.unique(np.sort(np.concatenate(pairs), axis=1), axis=0)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(pairs), np.int64)), pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], kinds)
            k = np.flatnonzero(large)
            if len(k):
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(k), np.int64)), pa.array(key[k]), pa.array(node[k])], kinds)
            leader = [h[-1] for h in head] if large[-1] else None

    return rows.repartition("key").sortWithinPartitions("key", "node").mapInArrow(
        run, "kind long, a long, b long")


def _with_last(batches):
    """(False, batch) for every batch, then (True, None)."""
    for b in batches:
        yield False, b
    yield True, None


def links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    side = lambda x: nodes.select(F.col("_node").alias(x), F.col("_id").alias(f"_id_{x}"), F.col("_set").alias(f"_set_{x}"))
    text = lambda x: docs.select(F.col("_id").alias(f"_id_{x}"), F.col("_text").alias(f"_text_{x}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b")
    rows = join_null_safe(rows, text("b"), ["_id_b"])
    rows = join_null_safe(rows, text("a"), ["_id_a"])

    def confirm(batches):
        import xxhash

        shingler, seen = Shingler(words), (None, None, None)
        for b in batches:
            out = []
            for x, y, nx, ny, tx, ty in zip(*(b.column(c) for c in ("a", "b", "_set_a", "_set_b", "_text_a", "_text_b"))):
                tx, nx = tx.as_py() or b"", nx.as_py()
                if seen[0] != tx:  # rows come sorted by the first document
                    s = shingler.shingles(tx)
                    seen = (tx, s, xxhash.xxh3_128_digest(s.tobytes()))
                t = shingler.shingles(ty.as_py() or b"")
                # an id that repeats with other texts brings other sets: not the pair meant
                if seen[2] != nx or xxhash.xxh3_128_digest(t.tobytes()) != ny.as_py():
                    continue
                s = seen[1]
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= percent * (len(s) + len(t) - both):
                    out.append((x.as_py(), y.as_py()))
            if out:
                x, y = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    return stage(rows.select("a", "b", "_set_a", "_set_b", "_text_a", "_text_b").mapInArrow(confirm, "a long, b long").distinct(), "links")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of ``edges`` (a, b): comp is the smallest node reachable."""
    both = stage(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))), "edges")
    label = stage(both.groupBy("u").agg(F.least("u", F.min("v")).alias("l")).select(F.col("u").alias("node"), F.col("l").alias("comp")), "labels")
    while True:
        of = label.select(F.col("node").alias("v"), F.col("comp").alias("c"))
        low = both.join(of, "v").groupBy("u").agg(F.min("c").alias("c"))
        near_ = stage(label.join(low, label["node"] == low["u"]).select("node", "comp", F.least("comp", "c").alias("c")), "near-labels")
        jump = near_.select(F.col("node").alias("at"), F.col("c").alias("next"))
        step = stage(near_.join(jump, near_["c"] == jump["at"], "left").select(
            "node", F.col("comp").alias("old"), F.least("c", F.coalesce("next", "c")).alias("comp")), "jumped-labels")
        label = step.select("node", "comp")
        if step.where("old <> comp").isEmpty():
            return label


def owned_pairs(key: int, sig_x, n_x, comp_x, sig_y, n_y, comp_y, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of two blocks of bucket ``key`` that are to be tried here: of different components, within
    the radius, and with ``key`` as the first key that both have."""
    chunk, omitted = key >> 50, key >> 48 & 3
    x0, x1 = sketches(sig_x)
    y0, y1 = sketches(sig_y)
    out = []
    for a in range(0, len(sig_x), 64):
        r = slice(a, a + 64)
        i, j = np.nonzero(near(x0[r, None], x1[r, None], n_x[r, None], y0, y1, n_y, percent) & (comp_x[r, None] != comp_y))
        i += a
        for k in range(0, len(i), 1 << 16):
            u, v = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
            differ = (sig_x[u] != sig_y[v]).reshape(-1, CHUNKS, CHUNK_SYMBOLS)
            apart = differ.sum(axis=2)
            first = (apart <= 1).argmax(axis=1)
            row = np.arange(len(u))
            leaves = np.where(apart[row, first] == 0, 0, differ[row, first].argmax(axis=1))
            own = (apart.sum(axis=1) <= RADIUS) & (first == chunk) & (leaves == omitted)
            out.append(np.stack((u[own], v[own])))
    i, j = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
    return i, j


def intersections(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets[i] and sets[j]: the members of one set are marked, its partners count marks."""
    out = np.zeros(len(i), dtype=np.int64)
    if not len(i):
        return out
    size = np.array([len(s) for s in sets])
    begin = np.cumsum(size) - size
    _, member = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(member.max() + 1, dtype=bool)
    order = np.argsort(i, kind="stable")
    cuts = np.flatnonzero(np.concatenate(([True], np.diff(i[order]) != 0, [True])))
    for a, b in zip(cuts[:-1], cuts[1:]):
        x = i[order[a]]
        own = member[begin[x]:begin[x] + size[x]]
        mark[own] = True
        for c in range(a, b, 1024):
            some = order[c:min(b, c + 1024)]
            y = j[some]
            first = np.cumsum(size[y]) - size[y]
            place = np.arange(size[y].sum()) + np.repeat(begin[y] - first, size[y])
            out[some] = np.add.reduceat(mark[member[place]].astype(np.int64), first)
        mark[own] = False
    return out


def block_pairs(rows: DataFrame, weight, bound: int) -> DataFrame:
    """``rows`` of (key, node, ...) dealt to pairs of blocks (i, j), i <= j, of about ``bound`` in ``weight`` each; ``mine`` is
    the row's own block. A key of one block is not copied."""
    count = stage(rows.groupBy("key").agg(F.ceil(F.sum(weight) / bound).alias("blocks")), "block-counts")
    rows = rows.join(count, "key").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return rows.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other")).drop("blocks", "other")


def cross_links(large: DataFrame, label: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between different components that meet in large buckets."""
    rows = large.select(F.col("a").alias("key"), F.col("b").alias("node"))
    rows = stage(rows.join(label, "node", "left").withColumn("comp", F.coalesce("comp", "node")), "large-buckets")
    mixed = stage(rows.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key"), "mixed-buckets")
    rows = stage(rows.join(mixed, "key", "left_semi"), "rows-of-mixed-buckets")
    rows = block_pairs(rows, F.lit(1), SKETCH_BLOCK).join(nodes.select(F.col("_node").alias("node"), F.col("_n").alias("n"), F.col("_sig").alias("sig")), "node")

    def sides(t: pa.Table):
        key, i, j = (t[c][0].as_py() for c in ("key", "i", "j"))
        sig = np.frombuffer(b"".join(t["sig"].to_pylist()), "<u2").reshape(-1, SYMBOLS)
        n, comp, mine = (t[c].to_numpy() for c in ("n", "comp", "mine"))
        x, y = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        u, v = owned_pairs(key, sig[x], n[x], comp[x], sig[y], n[y], comp[y], percent)
        return x[u], y[v]

    def name(t: pa.Table) -> pa.Table:
        """The rows of a block pair that have a pair to try."""
        x, y = sides(t)
        return t.take(pa.array(np.unique(np.concatenate((x, y))))).select(names)

    names = ["key", "i", "j", "mine", "node", "comp", "n", "sig"]
    schema = "key long, i long, j long, mine long, node long, comp long, n long, sig binary"
    tried = rows.select(*names).groupBy("key", "i", "j").applyInArrow(name, schema).select("key", "node", "comp", "n", "sig")
    tried = stage(tried.dropDuplicates(["key", "node"]), "rows-to-try")
    parts = block_pairs(tried, F.col("n"), SHINGLE_BLOCK).join(nodes.select(F.col("_node").alias("node"), "_id", F.col("_set").alias("set")), "node")
    parts = join_null_safe(parts, docs, ["_id"]).select(*names, "set", F.col("_text").alias("text"))

    def confirm(t: pa.Table) -> pa.Table:
        import xxhash

        shingler, sets, keep, seen = Shingler(words), [], [], set()
        for r, (node, name_, text) in enumerate(zip(t["node"].to_pylist(), t["set"].to_pylist(), t["text"])):
            if node in seen:
                continue
            s = shingler.shingles(text.as_py() or b"")
            if xxhash.xxh3_128_digest(s.tobytes()) == name_:  # else another text under the same id
                seen.add(node)
                sets.append(s)
                keep.append(r)
        t = t.take(pa.array(keep, pa.int64()))
        if not keep:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        x, y = sides(t)
        node, comp, n = (t[c].to_numpy() for c in ("node", "comp", "n"))
        both = intersections(sets, x, y)
        linked = np.flatnonzero(100 * both >= percent * (n[x] + n[y] - both))
        root, out = {}, []

        def find(c):
            while root.get(c, c) != c:
                c = root[c]
            return c

        for k in linked:
            p, q = find(comp[x[k]]), find(comp[y[k]])
            if p != q:
                root[max(p, q)] = min(p, q)
                out.append(sorted((int(node[x[k]]), int(node[y[k]]))))
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return stage(parts.groupBy("key", "i", "j").applyInArrow(confirm, "a long, b long").distinct(), "cross-links")


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
               percent: int = PERCENT) -> DataFrame:
    """One row per input row: (id, n_shingles, component_id, kept)."""
    modest_batches(df.sparkSession)
    if percent < PERCENT:
        raise ValueError(f"the signature's radius covers similarities of {PERCENT} percent or more")
    docs = df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    sigs = signatures(df, id_col, text_col, words)
    nodes = sigs.where("_set IS NOT NULL").groupBy("_set").agg(F.min("_id").alias("_id"), F.first("_n").alias("_n"), F.first("_sig").alias("_sig"))
    nodes = stage(nodes.withColumn("_node", F.monotonically_increasing_id()), "classes")
    met = stage(meet(bucket_rows(nodes), percent), "candidates")
    pairs = stage(met.where("kind = 0").select("a", "b").distinct(), "pairs")
    edges = links(pairs, nodes, docs, words, percent)
    label = components(edges)
    large = met.where("kind = 1")
    if not large.isEmpty():
        more = cross_links(large, label, nodes, docs, words, percent)
        if not more.isEmpty():
            label = components(edges.unionByName(more))
    named = stage(label.join(nodes.select(F.col("_node").alias("node"), "_id"), "node"), "component-rows")
    lows = stage(named.groupBy("comp").agg(F.min("_id").alias("_low")), "component-ids")
    found = named.join(lows, "comp").select(F.col("node").alias("_node"), "_low", F.lit(True).alias("_linked"))
    by_set = stage(nodes.join(found, "_node", "left").select(
        "_set", F.when(F.col("_linked"), F.col("_low")).otherwise(F.col("_id")).alias("_low"), F.lit(True).alias("_any")), "set-components")
    out = sigs.join(by_set, "_set", "left").select(
        "_id", "_n", F.when(F.col("_any"), F.col("_low")).otherwise(F.col("_id")).alias("component_id"))
    return out.select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), "component_id",
                      F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns: of a component one row, of the smallest id (null last), then of the
    smallest SHA-256 of its text. A row without words stays, once if it is repeated."""
    if df.groupBy(id_col).count().where("count > 1").isEmpty():  # an id names a row
        kept = stage(near_dedup(df, id_col, text_col).where("kept").select(F.col(id_col).alias("_id")), "kept")
        return df.join(kept, df[id_col].eqNullSafe(kept["_id"]), "left_semi")
    sha = F.sha2(F.col(text_col).cast("binary"), 256)
    rows = df.select(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), sha.alias("sha")).alias("row"), F.col(text_col).alias("text"))
    kept = near_dedup(rows, "row", "text").where("kept").groupBy("row").count()
    kept = stage(kept.select(F.col("row.id").alias("_id"), F.col("row.sha").alias("_sha"), "count"), "kept")
    name = free_name(df, "_sha")
    rows = df.withColumn(name, sha)
    rows = rows.join(kept, rows[id_col].eqNullSafe(kept["_id"]) & rows[name].eqNullSafe(kept["_sha"]), "left_semi")
    if not kept.where("count > 1").isEmpty():
        rows = rows.dropDuplicates([id_col, name])
    return rows.drop(name)


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
