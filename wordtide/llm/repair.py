"""Token files compressed by Re-Pair grammars, with random access.

Writer. Rows are sorted by id over range partitions; every partition tokenises its documents in
order, appends ``eod`` to each and cuts its ids into shards of ``shard_ids``, one file per shard
(a document may go on in the next shard). Re-Pair compresses each shard: count adjacent pairs of
symbols, replace the most frequent pairs by new symbols (nonterminals), and repeat on the
shorter sequence until a round would save less than ``LEAST_GAIN`` of it. A round takes the pairs within ``STEP`` of the
most frequent one's count; where two of them overlap, the more frequent one wins and the other
waits for the next round.

File, little-endian: a header (``HEADER``), the rules (left and right symbol of each), the expansion length
of each rule, the expanded position of every ``SAMPLE``-th symbol, the symbols, and a table of the
documents (Arrow IPC: number in the partition, id, ids of it before this shard, ids in this shard).
Symbols below ``base`` are token ids, others are rules; they take 16 bits while base and rules fit, else 32.

Reader. ``read_files`` decodes whole files, one task per file, and stitches documents cut by a shard's end;
``read_ids`` decodes any range of one file: it looks the range up in the sampled positions and reads only
the symbols that cover it.

Tokenising. ``WordEncoder`` gives the ids of ``tokenizers`` for vocabularies whose normaliser and splitter
never look across white space. Texts are cut into words, each distinct word is encoded once by the library's
model, and ids are gathered by word number. Words that are not plain (letters of ASCII and Latin-1, digits, ASCII
symbols but the apostrophe) go through the library's whole path.

Defined cases: null and empty texts are documents of one id, ``eod``; strings of special tokens become their
ids, as in the library; rows that repeat an id follow one another by the SHA-256 of their text and count
separately; a null id comes first; an empty table gives no files and no rows; other columns are ignored;
a text of any length is cut at white space into parts of ``PART_BYTES``, and its ids over as many shards as it takes.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from typing import Optional

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtide.llm._common import modest_batches, new_path, open_fs, prefix_sums, stage
from wordtide.session import delete_on_exit

EOD = 2
SHARD_IDS = 1 << 20
PART_BYTES = 8 << 20
CACHED_WORDS = 1 << 20
SAMPLE = 256
STEP = 64           # a round takes pairs of at least 1/STEP of the most frequent one's count
MIN_USES = 8        # a rule takes the place of about eight symbols in the file
LEAST_GAIN = 0.015  # rounds end when one would save less of the sequence
HEADER = "<4sIQQQQQQ"  # magic, symbol bytes, base, ids, rules, symbols, documents, bytes of the document table
MAGIC = b"RPG1"


# ---------------------------------------------------------------- grammar

def compress(ids: np.ndarray, base: int, min_uses: int = MIN_USES) -> tuple[np.ndarray, np.ndarray]:
    """(rules of shape (n, 2), symbols): the Re-Pair grammar of ``ids``, all below ``base``.

    With a base below 2^16 there are as many rules as leave symbols 16 bits.
    """
    kind, half, room = (np.uint32, 16, (1 << 16) - base) if base < 1 << 16 else (np.uint64, 32, (1 << 31) - base)
    seq, rules, made = ids.astype(kind), [], 0
    half = kind(half)
    while len(seq) > 1 and made < room:
        pairs = seq[:-1] << half | seq[1:]
        keys = np.sort(pairs)
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        count = np.diff(np.append(first, len(keys)))
        top = int(count.max())
        if top < min_uses:
            break
        often = np.flatnonzero(count >= max(min_uses, top // STEP))
        chosen = keys[first[often[np.argsort(count[often], kind="stable")][made - room:]]]  # the index of a pair is its priority
        at, rank = _find(pairs, chosen)
        # in a run of one pair (one symbol again and again) every second one stands
        again = np.flatnonzero((at[1:] == at[:-1] + 1) & (rank[1:] == rank[:-1])) + 1
        if len(again):
            start = np.arange(len(at))
            start[again] = 0
            np.maximum.accumulate(start, out=start)
            keep = (np.arange(len(at)) - start) % 2 == 0
            at, rank = at[keep], rank[keep]
        # of two that overlap the more frequent one goes first
        touch, up = at[1:] == at[:-1] + 1, rank[1:] > rank[:-1]
        keep = np.ones(len(at), bool)
        keep[1:] &= ~touch | up
        keep[:-1] &= ~(touch & up)
        at, rank = at[keep], rank[keep]
        pays = np.bincount(rank, minlength=len(chosen)) >= min_uses
        keep = pays[rank]
        at, rank = at[keep], rank[keep]
        if len(at) < len(seq) * LEAST_GAIN:
            break
        seq[at] = (base + made + np.cumsum(pays) - 1)[rank]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
        rules.append(np.stack([chosen[pays] >> half, chosen[pays] & ((kind(1) << half) - kind(1))], 1).astype(np.uint32))
        made += len(rules[-1])
    return (np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)), seq.astype(np.uint32)


def _find(pairs: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, indices in ``chosen``) of the pairs that are chosen; of chosen ones that meet in a slot the last counts."""
    width = pairs.dtype.itemsize * 8
    bits = max(12, (len(chosen) * 8).bit_length())
    slot = lambda x: (x * pairs.dtype.type(0x9E3779B1)) >> pairs.dtype.type(width - bits)
    table = np.full(1 << bits, -1, np.int32)
    table[slot(chosen)] = np.arange(len(chosen), dtype=np.int32)
    rank = table[slot(pairs)]
    at = np.flatnonzero(rank >= 0)
    rank = rank[at]
    same = chosen[rank] == pairs[at]
    return at[same], rank[same]


def _rounds(rules: np.ndarray, base: int):
    """(first, end) of consecutive rules that only use rules before ``first``."""
    used = np.maximum.accumulate(rules.max(axis=1).astype(np.int64)) - base if len(rules) else np.zeros(0, np.int64)
    a = 0
    while a < len(rules):
        b = int(np.searchsorted(used, a, "left"))
        yield a, b
        a = b


def _ragged(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (n[0] of them), starts[1], ..."""
    total = np.cumsum(n)
    return np.repeat(starts - (total - n), n) + np.arange(total[-1] if len(n) else 0)


def _symbol_lengths(symbols: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    out = np.ones(len(symbols), np.int64)
    rule = np.flatnonzero(symbols >= base)
    out[rule] = lengths[symbols[rule] - base]
    return out


def rule_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Expansion length of every rule; a rule only uses earlier ones."""
    out = np.ones(len(rules), np.int64)
    for a, b in _rounds(rules, base):
        out[a:b] = _symbol_lengths(rules[a:b, 0], out, base) + _symbol_lengths(rules[a:b, 1], out, base)
    return out


def _fill(symbols: np.ndarray, count: np.ndarray, text: np.ndarray, whole: np.ndarray, base: int) -> np.ndarray:
    """The ids of ``symbols``, ``count`` each; ``text`` holds the expansions of rules, that of rule k from ``whole[k]`` on."""
    out = np.repeat(symbols, count)
    rule = np.flatnonzero(symbols >= base)
    first = (np.cumsum(count) - count)[rule]
    out[_ragged(first, count[rule])] = text[_ragged(whole[symbols[rule] - base], count[rule])]
    return out


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """The ids that ``symbols`` stand for."""
    whole = np.concatenate(([0], np.cumsum(lengths)))
    text = np.zeros(whole[-1], np.uint32)
    for a, b in _rounds(rules, base):
        sides = rules[a:b].reshape(-1)
        text[whole[a]:whole[b]] = _fill(sides, _symbol_lengths(sides, lengths, base), text, whole, base)
    return _fill(symbols, _symbol_lengths(symbols, lengths, base), text, whole, base)


# ---------------------------------------------------------------- files

def pack_file(ids: np.ndarray, docs: pa.Table, base: int) -> bytes:
    rules, symbols = compress(ids, base)
    lengths = rule_lengths(rules, base)
    kind = "<u2" if base + len(rules) <= 1 << 16 else "<u4"
    spans = _symbol_lengths(symbols, lengths, base)
    samples = (np.cumsum(spans) - spans)[::SAMPLE]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema) as w:
        w.write_table(docs)
    table = sink.getvalue().to_pybytes()
    head = struct.pack(HEADER, MAGIC, np.dtype(kind).itemsize, base, len(ids), len(rules), len(symbols), docs.num_rows, len(table))
    return b"".join([head, rules.astype("<u4").tobytes(), lengths.astype("<u8").tobytes(), samples.astype("<u8").tobytes(),
                     symbols.astype(kind).tobytes(), table])


class File:
    """An open shard: ``rules``, ``lengths``, ``samples`` in memory, symbols read as needed."""

    def __init__(self, f):
        self.f = f
        magic, self.width, self.base, self.n_ids, n_rules, self.n_symbols, self.n_docs, self.table_bytes = struct.unpack(HEADER, f.read_at(struct.calcsize(HEADER), 0))
        if magic != MAGIC:
            raise ValueError("not a grammar file")
        n_samples = -(-self.n_symbols // SAMPLE)
        body = f.read_at(16 * n_rules + 8 * n_samples, struct.calcsize(HEADER))
        self.rules = np.frombuffer(body, "<u4", 2 * n_rules).reshape(-1, 2)
        self.lengths = np.frombuffer(body, "<u8", n_rules, 8 * n_rules).astype(np.int64)
        self.samples = np.frombuffer(body, "<u8", n_samples, 16 * n_rules).astype(np.int64)
        self.symbols_at = struct.calcsize(HEADER) + len(body)

    def symbols(self, first: int, end: int) -> np.ndarray:
        data = self.f.read_at((end - first) * self.width, self.symbols_at + first * self.width)
        return np.frombuffer(data, f"<u{self.width}").astype(np.uint32)

    def documents(self) -> pa.Table:
        return pa.ipc.open_stream(self.f.read_at(self.table_bytes, self.symbols_at + self.n_symbols * self.width)).read_all()

    def ids(self, start: int = 0, n: Optional[int] = None) -> np.ndarray:
        """Ids [start, start + n) of the shard, from the symbols that cover them."""
        end = self.n_ids if n is None else min(start + n, self.n_ids)
        if start >= end:
            return np.zeros(0, np.uint32)
        a = int(np.searchsorted(self.samples, start, "right")) - 1
        b = int(np.searchsorted(self.samples, end, "left"))
        got = expand(self.symbols(a * SAMPLE, min(b * SAMPLE, self.n_symbols)), self.rules, self.lengths, self.base)
        return got[start - self.samples[a]:end - self.samples[a]]


def read_ids(path: str, start: int, n: int) -> np.ndarray:
    """Ids [start, start + n) of one file."""
    fs, p = open_fs(path)
    with fs.open_input_file(p) as f:
        return File(f).ids(start, n)


# ---------------------------------------------------------------- tokenising

def _table(data: np.ndarray, table: bytes) -> np.ndarray:
    return np.frombuffer(data.tobytes().translate(table), np.uint8)


class WordEncoder:
    """Ids of ``tokenizers`` for a vocabulary that drops white space and splits words into letters, digits and symbols."""

    _plain = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|[0-9]|[\x00-\x08\x0e-\x1f!-&(-/:-@\[-`{-\x7f]+")

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.model, self.size = self.tok.model, self.tok.get_vocab_size()
        spelt = "".join(pre_tokenizers.ByteLevel.alphabet())
        if not {chr(c) for c in range(33, 127)} <= set(spelt):
            raise ValueError("not a byte-level vocabulary")
        # bytes as the model spells them: printable ones of Latin-1 stand for themselves, the others follow from 256 on
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.spell = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in own)}
        byte = np.arange(256)
        blank = (byte >= 9) & (byte <= 13) | (byte == 32)
        letter = (byte >= 97) & (byte <= 122) | (byte >= 0x80)
        self.lower = np.where((byte >= 65) & (byte <= 90), byte + 32, byte).astype(np.uint8).tobytes()
        self.kind = np.select([blank, letter, (byte >= 48) & (byte <= 57)], [0, 1, 2], 3).astype(np.uint8).tobytes()
        self.hard = ((byte == 39) | (byte == 0xC2) | (byte >= 0xC4)).astype(np.uint8).tobytes()
        self._reset()

    def _reset(self):
        self.known, self.flat, self.starts, self.counts = {}, np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _ids(self, word: bytes) -> list[int]:
        if word.isalpha():  # letters of ASCII
            return [t.id for t in self.model.tokenize(word.decode())]
        if self._plain.fullmatch(word):
            return [t.id for t in self.model.tokenize(word.decode("latin-1").translate(self.spell))]
        if word.isspace():
            return []
        return self.tok.encode(word.decode(), add_special_tokens=False).ids

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > CACHED_WORDS:
            self._reset()
        get, out, flat, counts = self.known.get, [], [], []
        for w in words:
            k = get(w)
            if k is None:
                k = self.known[w] = len(self.known)
                ids = self._ids(w)
                flat += ids
                counts.append(len(ids))
            out.append(k)
        if counts:
            n = np.array(counts)
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(n) - n])
            self.counts = np.concatenate([self.counts, n])
            self.flat = np.concatenate([self.flat, np.array(flat, np.uint32)])
        return np.array(out)

    def encode(self, texts: pa.Array):
        """Yields (ids, lengths, closed): the ids of consecutive documents, how many each takes, and whether the last
        one ends here. One that does not goes on as the first of the next yield."""
        texts = texts.fill_null("") if texts.null_count else texts
        wide = pa.types.is_large_string(texts.type)
        off = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
        off = off - off[0]
        a = doc = 0
        while doc < len(texts):
            b, last = a + PART_BYTES, len(texts)
            if b < len(data):  # cut before a blank, or at a document's end
                stop = b_end = int(off[np.searchsorted(off, b, "left")])
                for c in range(b, b_end, PART_BYTES):
                    blank = np.flatnonzero(_table(data[c:min(c + PART_BYTES, b_end)], self.kind) == 0)
                    if len(blank):
                        stop = c + int(blank[0])
                        break
                b = stop
            if b < len(data):
                last = int(np.searchsorted(off, b, "left"))
            else:
                b = len(data)
            closed = off[last] == b
            yield (*self._part(data[a:b], np.minimum(off[doc + 1:last + 1], b) - a), closed)
            a, doc = b, last if closed else last - 1

    def _part(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``raw``, whose documents end at ``ends``."""
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(ends), np.int64)
        low = _table(raw, self.lower).copy()
        lead = np.flatnonzero(raw[:-1] == 0xC3)
        after = low[lead + 1]
        low[lead[(after <= 0x9E) & (after != 0x97)] + 1] += 0x20
        kind = _table(low, self.kind)
        inner = ends[ends < len(raw)]
        cut = np.empty(len(raw), bool)
        cut[0] = True
        np.not_equal(kind[1:], kind[:-1], out=cut[1:])
        cut |= kind == 2
        cut[inner] = True
        odd = np.concatenate([np.flatnonzero(_table(raw, self.hard)), lead[(after == 0x97) | (after == 0xB7)],
                              np.flatnonzero((raw[:-1] == 60) & (raw[1:] == 124))])
        if len(odd):  # the whole word, from blank to blank, goes to the library
            edge = np.zeros(len(raw), bool)
            edge[0] = True
            edge[1:] = (kind[1:] == 0) != (kind[:-1] == 0)
            edge[inner] = True
            at = np.append(np.flatnonzero(edge), len(raw))
            w = np.unique(np.searchsorted(at, odd, "right") - 1)
            mark = np.zeros(len(raw) + 1, np.int8)
            mark[at[w]] += 1
            mark[at[w + 1]] -= 1
            inside = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
            cut[inside] = False
            cut[at[w]] = True
            low[inside] = raw[inside]
        at = np.flatnonzero(cut)
        words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.append(at, len(raw)).astype(np.int32)), pa.py_buffer(low)])
        words = words.dictionary_encode()
        number = self._numbers(words.dictionary.to_pylist())[words.indices.to_numpy()]
        n = self.counts[number]
        ids = self.flat[_ragged(self.starts[number], n)]
        upto = np.concatenate(([0], np.cumsum(n)))[np.searchsorted(at, ends, "left")]
        return ids, np.diff(upto, prepend=0)


def vocabulary(path: Optional[str] = None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# ---------------------------------------------------------------- Spark

def write_files(df: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: Optional[str] = None,
                eod: int = EOD, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write ``df`` as grammar files in order of ``id_col``; returns their staged list (part, shard, path, n_ids, n_bytes)."""
    spark = df.sparkSession
    modest_batches(spark)
    path = vocabulary(tokenizer)
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = rows.withColumn("_sha", F.sha2(F.coalesce("_text", F.lit("")).cast("binary"), 256)).withColumn("_row", F.monotonically_increasing_id())
    order = ["_id", "_sha", "_row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("_id", "_text")

    def write(batches):
        from pyspark import TaskContext

        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)
        part, encoder = TaskContext.get().partitionId(), WordEncoder(path)
        shard, number, before = 0, 0, 0   # of the file, of the open document, ids of it in earlier files
        held, table, width = [], [], 0    # ids and document rows of the open file

        def flush():
            nonlocal shard, held, table, width
            name = f"{root}/part-{part:06d}-{shard:06d}-{uuid.uuid4().hex}.rpg"
            docs = pa.table({"number": pa.array([t[0] for t in table], pa.int64()), "id": pa.concat_arrays([t[1] for t in table]),
                             "before": pa.array([t[2] for t in table], pa.int64()), "n": pa.array([t[3] for t in table], pa.int64()), "closed": pa.array([t[4] for t in table])})
            data = pack_file(np.concatenate(held), docs, encoder.size)
            with fs.open_output_stream(name) as f:
                f.write(data)
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([name]), pa.array([width]), pa.array([len(data)])],
                                             ["part", "shard", "path", "n_ids", "n_bytes"])
            shard, held, table, width = shard + 1, [], [], 0
            return row

        for batch in batches:
            key, doc = batch.column("_id"), 0
            for ids, lengths, closed in encoder.encode(batch.column("_text")):
                at = 0
                for k, n in enumerate(lengths.tolist()):
                    piece, at = ids[at:at + n], at + n
                    ends = closed or k < len(lengths) - 1
                    if ends:
                        piece = np.append(piece, np.uint32(eod))
                    while len(piece):
                        take, piece = piece[:shard_ids - width], piece[shard_ids - width:]
                        held.append(take)
                        if table and table[-1][0] == number:
                            table[-1][3] += len(take)
                        else:
                            table.append([number, key.slice(doc, 1), before, len(take), False])
                        table[-1][4] = ends and not len(piece)
                        width, before = width + len(take), before + len(take)
                        if width == shard_ids:
                            yield flush()
                    if ends:
                        number, before, doc = number + 1, 0, doc + 1
        if held:
            yield flush()

    return stage(rows.mapInArrow(write, "part int, shard int, path string, n_ids long, n_bytes long"), "grammar-files")


def read_files(files: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Every piece of a document in the listed files: (part, shard, number, id, before, n, closed, at, crc, n_ids).

    ``at`` is its place in the file, ``crc`` that of its ids as little-endian unsigned 32-bit integers, ``n_ids`` of the file.
    """
    def read(batches):
        for b in batches:
            for part, shard, path in zip(*(b.column(c).to_pylist() for c in ("part", "shard", "path"))):
                fs, p = open_fs(path)
                with fs.open_input_file(p) as f:
                    file = File(f)
                    ids, docs = file.ids().astype("<u4"), file.documents().combine_chunks()
                n = docs["n"].to_numpy()
                at = np.cumsum(n) - n
                if len(ids) != file.n_ids or n.sum() != len(ids):
                    raise ValueError(f"{path}: {len(ids)} ids, {file.n_ids} in its header")
                crc = [zlib.crc32(ids[a:a + k].tobytes()) for a, k in zip(at.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(n), pa.int32()), pa.array([shard] * len(n), pa.int32()), *(docs[c].chunk(0) for c in docs.column_names),
                     pa.array(at), pa.array(crc, pa.int64()), pa.array([len(ids)] * len(n), pa.int64())],
                    ["part", "shard", *docs.column_names, "at", "crc", "n_ids"])

    # a fixed number of tasks: rows of the list are small, what they stand for is not
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("part", "shard", "path").repartition(tasks, "path").mapInArrow(
        read, f"part int, shard int, number long, id {id_type}, before long, n long, closed boolean, at long, crc long, n_ids long")


def joined_crc(pieces: list[tuple[int, int]]) -> int:
    """CRC-32 of a byte string from (crc, bytes) of its consecutive pieces."""
    def times(a, b):  # product of polynomials over GF(2), bit-reversed, modulo the CRC's polynomial
        out = 0
        for k in range(32):
            if a >> (31 - k) & 1:
                out ^= b
            b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
        return out

    total = 0
    for crc, size in pieces:
        shift, power, n = 0x80000000, 0x00800000, size  # 1 and x^8
        while n:
            if n & 1:
                shift = times(power, shift)
            power, n = times(power, power), n >> 1
        total = times(shift, total) ^ crc
    return total


def documents(files: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Per document of the listed files: (id, start, n_tokens, ids_crc32), from what the files hold."""
    pieces = stage(read_files(files, id_type), "grammar-pieces")
    sizes = pieces.groupBy("part", "shard").agg(F.max("n_ids").alias("n_ids"))
    in_part = prefix_sums(sizes, ["part"], "shard", "n_ids", "_shard_at")
    # one row per partition
    parts = prefix_sums(sizes.withColumn("_all", F.lit(0)), ["_all"], "part", "n_ids", "_part_at").drop("_all")
    starts = in_part.join(parts, "part").select("part", "shard", (F.col("_part_at") + F.col("_shard_at")).alias("_at"))
    placed = pieces.join(starts, ["part", "shard"]).withColumn("start", F.col("_at") + F.col("at"))
    whole = F.col("closed") & (F.col("before") == 0)

    @F.udf("long")
    def fold(rows):
        return joined_crc([(r["crc"], 4 * r["n"]) for r in sorted(rows, key=lambda r: r["before"])])

    # the others have as many pieces as their ids touch shards
    cut = placed.where(~whole).groupBy("part", "number").agg(
        F.first("id").alias("id"), F.min("start").alias("start"), F.sum("n").alias("n_tokens"),
        fold(F.collect_list(F.struct("before", "n", "crc"))).alias("ids_crc32"))
    return placed.where(whole).select("id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32")).unionByName(cut.drop("part", "number"))


def op13_repair(spark, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "grammar")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    files = write_files(docs, folder)
    delete_on_exit(spark, folder)
    out = documents(files, docs.schema["doc_id"].dataType.simpleString())
    return out.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")
