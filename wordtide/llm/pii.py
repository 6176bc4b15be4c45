"""Surrogate generation for personal data.

Detected entities get keyed replacements of the same type and format. An entity is its
normalised value (digits of a phone or card number, lower-case address, name token with script), so
all its spellings in all documents get one surrogate, written in the format of each mention: case, separators,
brackets and digit groups stay. Different entities get different surrogates, and no surrogate equals an
entity of the corpus:

  1. one pass detects entities; documents that have any are staged with them (the others pass through).
  2. distinct entities get a candidate surrogate from HMAC(key, type, value, try).
  3. a candidate is refused when it is an entity of the corpus or when two entities share it (the earliest try,
     then the smallest value keeps it); refused entities try again until none is left.
  4. mentions fetch their surrogates by entity and are written into the texts by document.

Types: e-mail, phone, payment card (Luhn), IBAN (mod 97), US social security number, IPv4, cloud access key, assigned
secrets (password=..., token = "..."), and names after an honorific, whose surrogates keep gender (from the honorifics
of all mentions or a name list; none where mentions disagree), role (given anywhere, or surname) and script (Latin, Cyrillic, Han). Surrogates keep what makes a value valid: check digits,
octet ranges, country and scheme prefixes; e-mail domains go to the reserved example domains, North American
numbers to the fictional 555 exchange (to unassigned ones where that is used up). Letters outside ASCII stay in their
script; secrets of symbols only become letters.

Plan: entities are counted with partial aggregates, so one that a third of all rows holds is one row; joins have
staged scans on both sides and AQE splits a hot entity. Only texts with entities are shuffled. Nothing
but emptiness tests reaches the driver.

Defined cases: null text stays null and has no entities; overlapping matches go to the leftmost, then to the type
listed first; rows that repeat an id are separate documents; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from typing import Iterator, Optional

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordtide.llm._common import modest_batches, stage

KEY = b"wordtide"

# Honorifics by gender, and given names by script and gender.
HONORIFICS = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora", "г-жа", "госпожа"],
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Signor", "г-н", "господин"],
    "": ["Mx", "Dr", "Prof", "д-р"],
}
HAN_HONORIFICS = {"f": ["女士", "小姐"], "m": ["先生"]}
GIVEN = {
    ("latin", "f"): ["Alice", "Clara", "Diana", "Elena", "Emma", "Greta", "Helen", "Ingrid", "Julia", "Laura", "Lucia", "Maria", "Nora", "Olga", "Paula", "Sofia"],
    ("latin", "m"): ["Albert", "Bruno", "Carlos", "David", "Erik", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Lucas", "Martin", "Oscar", "Paul", "Tomas"],
    ("cyrillic", "f"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Ольга", "Софья"],
    ("cyrillic", "m"): ["Андрей", "Борис", "Виктор", "Иван", "Максим", "Олег", "Павел", "Сергей"],
}
SYLLABLES = {
    "latin": ["ba", "den", "fal", "gor", "hel", "kin", "lor", "mar", "nel", "per", "ros", "sen", "tal", "ver", "wen", "zan"],
    "cyrillic": ["ба", "вен", "гор", "дем", "зар", "кол", "лан", "мор", "нев", "пет", "рос", "сав", "тим", "фед", "хар", "юр"],
    "han": ["安", "柏", "晨", "达", "恩", "芳", "光", "海", "佳", "兰", "明", "宁", "平", "清", "荣", "文"],
}

_TITLE = {t: g for g, ts in HONORIFICS.items() for t in ts}
_HAN_TITLE = {t: g for g, ts in HAN_HONORIFICS.items() for t in ts}
_GENDER = {n.casefold(): g for (_, g), names in GIVEN.items() for n in names}
_NAME = r"[A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ]+(?:[-'’][A-ZÀ-ÖØ-Þ][a-zà-öø-ÿ]+)?|[А-ЯЁ][а-яё]+(?:-[А-ЯЁ][а-яё]+)?"
#: in order of preference where matches begin at the same place
PATTERNS = [
    ("email", r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-])"),
    ("secret", r"(?i:\b(?:password|passwd|pwd|secret|token|api_?key)\b\s*[=:]\s*[\"']?)([^\s\"',;]{8,})"),
    ("access_key", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("ip", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)"),
    ("phone", r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,4}(?![\d])|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])"),
    ("card", r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?![\d-])"),
    ("name", r"(?<!\w)(?:" + "|".join(sorted(_TITLE, key=len, reverse=True)) + r")\.? +((?:" + _NAME + r")(?: (?:" + _NAME + r")){0,2})(?!\w)"),
    ("han_name", r"([一-鿿]{2,4}?)(?:" + "|".join(_HAN_TITLE) + r")"),
]
FINDER = re.compile("|".join(f"(?P<{n}>{p})" for n, p in PATTERNS))
#: every match holds one of these characters or strings in its first word; of a secret, after the blanks that follow that word
HINT_CHARS = re.compile(r"[0-9@=:]+")
HINT_STRINGS = ["AKIA", "ASIA", *_TITLE, *_HAN_TITLE]
#: the rest of a word and 19 more: no match has more words (a card number of 19 single digits)
AHEAD = re.compile(r"\S*(?:\s+\S+){0,19}")


def hint_windows(text: str) -> list[tuple[int, int]]:
    """Disjoint parts of the text that hold every match whole: from the first word a hint can belong to, 20 words on."""
    at = [m.start() for m in HINT_CHARS.finditer(text)]
    extra = []
    for h in HINT_STRINGS:
        i = text.find(h)
        while i >= 0:
            extra.append(i)
            i = text.find(h, i + 1)
    if extra:
        at = sorted(at + extra)
    spans = []
    for a in at:
        low = spans[-1][1] if spans else 0
        end = AHEAD.match(text, a).end()
        if a >= low:
            word = a
            if text[a] in "=:":
                while word > low and text[word - 1].isspace():
                    word -= 1
            begin = max(text.rfind(" ", low, word), text.rfind("\n", low, word))
            if begin >= 0 or not spans:
                spans.append([max(begin, 0), end])
                continue
        spans[-1][1] = max(spans[-1][1], end)  # the word may begin in the last part
    return [(a, b) for a, b in spans]


def luhn(digits: str) -> int:
    """Luhn sum modulo 10; 0 for a valid number."""
    twice = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(t - 9 if t > 9 else t for t in twice)) % 10


def iban_rest(iban: str) -> int:
    """Remainder by 97; 1 for a valid number."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def script(word: str) -> str:
    c = word[0]
    return "han" if "一" <= c <= "鿿" else "cyrillic" if "Ѐ" <= c <= "ӿ" else "latin"


def entities(text: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, type, value) of the entities of a text, in order, not overlapping."""
    for begin, end in hint_windows(text or ""):
        yield from _entities_between(text, begin, end)


def _entities_between(text: str, at: int, stop: int) -> Iterator[tuple[int, int, str, str]]:
    while m := FINDER.search(text, at, stop):
        kind, at = m.lastgroup if m.lastgroup in _KINDS else next(k for k in _KINDS if m.group(k) is not None), m.end()
        raw, start = m.group(kind), m.start(kind)
        if kind == "email":
            yield start, m.end(), kind, raw.lower()
        elif kind == "secret":
            i = re.match(r"[^=:]*[=:]\s*[\"']?", raw).end()
            value = raw[i:].rstrip("!#$%&*.:?)]}>")  # punctuation that follows
            if len(value) >= 8:
                yield start + i, start + i + len(value), kind, value
        elif kind in ("access_key", "ip", "ssn"):
            yield start, m.end(), kind, raw
        elif kind == "card":
            # the whole match, or a prefix that ends at a separator: a date or a code may follow
            for end in [len(raw), *reversed([s.start() for s in re.finditer(r"[ -]", raw)])]:
                digits = re.sub(r"\D", "", raw[:end])
                if len(digits) >= 13 and luhn(digits) == 0 and len(set(digits)) > 1:
                    at = start + end
                    yield start, at, kind, digits
                    break
            else:  # its later digits may still be another entity
                gap = re.search(r"[ -]", raw)
                at = start + gap.end() if gap else m.end()
        elif kind == "iban":
            value = raw.replace(" ", "")
            if iban_rest(value) == 1:
                yield start, m.end(), kind, value
            else:
                at = start + 2  # its digits may still be another entity
        elif kind == "phone":
            digits = re.sub(r"\D", "", raw)
            if 7 <= len(digits) <= 15:
                yield start, m.end(), kind, ("+" if raw[0] == "+" else "") + digits
        elif kind == "name":
            title = re.match(r"[^\s.]+", raw).group()
            first = re.match(r"[^\s.]+\.? +", raw).end()
            words = raw[first:].split(" ")
            gender = _TITLE[title] or _GENDER.get(words[0].casefold(), "")
            for i, w in enumerate(words):
                given = len(words) > 1 and i == 0 or w.casefold() in _GENDER
                kind_ = f"given_{gender or _GENDER.get(w.casefold(), 'x')}_{script(w)}" if given else f"surname_{script(w)}"
                yield start + first, start + first + len(w), kind_, w.casefold()
                first += len(w) + 1
        elif kind == "han_name":
            title = next(t for t in _HAN_TITLE if raw.endswith(t))
            name = raw[:-len(title)]
            yield start, start + len(name), f"given_{_HAN_TITLE[title]}_han", name


_KINDS = [n for n, _ in PATTERNS]


class Stream:
    """Keyed pseudorandom choices for one entity and try."""

    def __init__(self, key: bytes, kind: str, value: str, turn: int):
        self.seed, self.block, self.pool = hmac.new(key, f"{kind}\0{value}\0{turn}".encode(), hashlib.sha256).digest(), 0, 0
        self.left = 0

    def below(self, n: int) -> int:
        if self.left < 64:
            self.pool = int.from_bytes(hashlib.sha256(self.seed + self.block.to_bytes(4, "big")).digest(), "big")
            self.block, self.left = self.block + 1, 256
        self.pool, x = divmod(self.pool, n)
        self.left -= n.bit_length()
        return x

    def like(self, c: str) -> str:
        """A character of the class of c."""
        if "0" <= c <= "9":
            return chr(48 + self.below(10))
        if "a" <= c <= "z":
            return chr(97 + self.below(26))
        if "A" <= c <= "Z":
            return chr(65 + self.below(26))
        if c <= "\x7f":
            return c
        if "一" <= c <= "鿿":
            return chr(0x4E00 + self.below(0x9FA6 - 0x4E00))
        near = neighbours(c)
        return near[self.below(len(near))] if near else c

    def letters(self, n: int) -> str:
        return "".join(chr(97 + self.below(26)) for _ in range(n))

    def digits(self, n: int) -> str:
        return "".join(chr(48 + self.below(10)) for _ in range(n))


def neighbours(c: str) -> str:
    """Letters or digits of the script of ``c``: those of its kind in its part of the code table; none for symbols."""
    kind = unicodedata.category(c)
    if kind[0] not in "LN":
        return ""
    first = ord(c) & ~63
    some = [x for x in map(chr, range(first, first + 64)) if x > "\x7f" and unicodedata.category(x) == kind]
    return "".join(x for x in some if x == c or len(x.upper()) == 1 and x.upper().lower() == x.lower())


def _name(s: Stream, script_: str, turn: int) -> str:
    """A made-up name; longer after several refused tries, so there is always another."""
    n = (1 if script_ == "han" else 2) + s.below(2) + turn // 4
    return "".join(SYLLABLES[script_][s.below(16)] for _ in range(n))


def surrogate(key: bytes, kind: str, value: str, turn: int) -> str:
    """Normalised surrogate of a normalised entity; longer after several refused tries, so there is always a free one."""
    s, more = Stream(key, kind, value, turn), turn // 4
    if kind == "email":
        local, domain = value.split("@")
        labels, host = domain.split("."), Stream(key, "domain", domain, 0)
        top = labels[-1] if labels[-1] in ("com", "net", "org") else "org"
        front = ["".join(map(host.like, x)) for x in labels[:-2]]
        return "".join(map(s.like, local)) + s.letters(more) + "@" + ".".join([*front, "example", top])
    if kind == "secret":
        hexed = re.fullmatch(r"[0-9a-f]+", value)
        if hexed:
            return "".join("0123456789abcdef"[s.below(16)] for _ in range(len(value) + more))
        if not any(map(str.isalnum, value)):
            return s.letters(len(value) + more)
        return "".join(map(s.like, value)) + s.letters(more)
    if kind == "access_key":
        return value[:4] + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[s.below(32)] for _ in range(len(value) - 4 + more))
    if kind == "ip" and more > 4:  # so many addresses that hardly one is free: documentation range of the next version
        return "2001:db8::" + ":".join(f"{s.below(65536):x}" for _ in range(4))
    if kind == "ip":
        return ".".join(str(1 + s.below(223 if i == 0 else 254)) for i in range(4))
    if kind == "ssn":
        return f"{900 + s.below(100)}-{1 + s.below(99):02d}-{1 + s.below(9999):04d}{s.digits(more)}"  # 9xx is never issued
    if kind == "card":
        body = value[0] + "".join(s.like(c) for c in value[1:-1]) + s.digits(more)
        return body + str((10 - luhn(body + "0")) % 10)
    if kind == "iban":
        body = "".join(map(s.like, value[4:])) + s.digits(more)
        return f"{value[:2]}{98 - iban_rest(value[:2] + '00' + body):02d}{body}"
    if kind == "phone":
        plus, digits = ("+", value[1:]) if value[0] == "+" else ("", value)
        if len(digits) - (plus == "+") == 10 and (not plus or digits[0] == "1"):  # North America: area code, 555, line
            exchange = f"{s.below(200):03d}" if more else "555"  # those from 0 and 1 are never assigned
            return f"{plus}{digits[:-10]}{2 + s.below(8)}{s.below(100):02d}{exchange}{s.below(10_000):04d}{s.digits(max(0, more - 3))}"
        keep = 2 if plus else 1
        return plus + digits[:keep] + "".join(map(s.like, digits[keep:])) + s.digits(more)
    role, *_, script_ = kind.split("_")
    gender = kind.split("_")[1] if role == "given" else ""
    names = GIVEN.get((script_, gender), [])
    if names and turn < 2:
        return names[s.below(len(names))].casefold()
    return _name(s, script_, turn)


def written(mention: str, value: str, kind: str) -> str:
    """``value`` in the format of ``mention``: separators and case."""
    if kind in ("phone", "card", "iban"):
        rest = iter(value.lstrip("+") if kind == "phone" else value)
        return "".join(next(rest) if c.isalnum() else c for c in mention) + "".join(rest)
    if kind == "email":
        if mention.isupper():
            return value.upper()
        return "".join(b.upper() if a.isupper() else b for a, b in zip(mention, value)) + value[len(mention):]
    if kind.startswith(("given_", "surname_")):
        return value.upper() if mention.isupper() and len(mention) > 1 else "-".join(p[:1].upper() + p[1:] for p in value.split("-"))
    return value


def _hits(df: DataFrame, id_col: str, text_col: str, with_entities: bool) -> DataFrame:
    """Documents with entities (id, text, ents), or those without (id, text)."""
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    ent = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string())]))

    def find(batches):
        for b in batches:
            found = [list(entities(t)) if t else [] for t in b.column("text").to_pylist()]
            keep = pa.array([bool(f) == with_entities for f in found], pa.bool_())
            cols = [b.column("id").filter(keep), b.column("text").filter(keep)]
            if with_entities:
                cols.append(pa.array([[dict(zip(("start", "end", "kind", "value"), e)) for e in f] for f in found if f], ent))
            yield pa.RecordBatch.from_arrays(cols, ["id", "text", "ents"][:len(cols)])

    extra = ", ents array<struct<start: int, end: int, kind: string, value: string>>" if with_entities else ""
    return src.mapInArrow(find, f"id {id_type}, text string{extra}")


def entity_kind(kind: str = "kind") -> F.Column:
    """The kind that makes a mention an entity: a name is one by script and value, whatever its role and gender there."""
    k = F.col(kind)
    return F.when(k.rlike("^(given|surname)_"), F.concat(F.lit("name_"), F.substring_index(k, "_", -1))).otherwise(k)


def distinct_entities(mentions: DataFrame) -> DataFrame:
    """(kind, value, form) of mentions (kind, value): ``form`` is the kind whose surrogates an entity gets.

    A name that is given anywhere is a given name; its gender is what its mentions say, none if they disagree.
    """
    def any_(prefix):
        return F.max(F.col("kind").startswith(prefix))

    merged = mentions.withColumn("entity", entity_kind()).groupBy("entity", "value").agg(
        any_("given_").alias("given"), any_("given_f").alias("f"), any_("given_m").alias("m"))
    script_ = F.substring_index("entity", "_", -1)
    gender = F.when(F.col("f") & ~F.col("m"), "f").when(F.col("m") & ~F.col("f"), "m").otherwise("x")
    name = F.when(F.col("given"), F.concat(F.lit("given_"), gender, F.lit("_"), script_)).otherwise(F.concat(F.lit("surname_"), script_))
    return merged.select(F.col("entity").alias("kind"), "value", F.when(F.col("entity").startswith("name_"), name).otherwise(F.col("entity")).alias("form"))


def surrogates(found: DataFrame, key: bytes = KEY) -> DataFrame:
    """(kind, value, turn, surrogate) for distinct (kind, value): distinct within a kind, and no value of that kind.

    A column ``form`` names the kind to generate, where it is not ``kind``.
    """
    if "form" not in found.columns:
        found = found.withColumn("form", F.col("kind"))

    def generate(df):
        def run(batches):
            for b in batches:
                rows = list(zip(*(b.column(c).to_pylist() for c in ("form", "value", "turn"))))
                yield pa.RecordBatch.from_arrays([b.column("kind"), b.column("value"), b.column("form"), b.column("turn"),
                                                  pa.array([surrogate(key, k, v, t) for k, v, t in rows], pa.string())],
                                                 ["kind", "value", "form", "turn", "surrogate"])
        return df.select("kind", "value", "form", "turn").mapInArrow(run, "kind string, value string, form string, turn int, surrogate string")

    real = found.select("kind", F.col("value").alias("surrogate"))
    cur = stage(generate(found.withColumn("turn", F.lit(0))), "surrogates")
    while True:
        owner = stage(cur.groupBy("kind", "surrogate").agg(F.min(F.struct("turn", "value")).alias("first"), F.count(F.lit(1)).alias("n")), "owners")
        taken = real.withColumn("real", F.lit(True))
        owner = owner.join(taken, ["kind", "surrogate"], "left").where("n > 1 OR real").select(
            "kind", "surrogate", F.when(F.col("real"), None).otherwise(F.col("first.value")).alias("owner"), F.lit(True).alias("clash"))
        clash = stage(owner, "clashes")
        if clash.isEmpty():
            return cur.select("kind", "value", "turn", "surrogate")
        marked = cur.join(clash, ["kind", "surrogate"], "left")
        refused = F.coalesce(F.col("clash"), F.lit(False)) & ~F.col("value").eqNullSafe(F.col("owner"))
        good = marked.where(~refused).select("kind", "value", "form", "turn", "surrogate")
        again = generate(marked.where(refused).withColumn("turn", F.col("turn") + 1))
        cur = stage(good.unionByName(again), "surrogates")


def replace_entities(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: bytes = KEY) -> DataFrame:
    """(id, text, n_entities, spans): the text with surrogates, and where they stand in it."""
    modest_batches(df.sparkSession)
    hits = stage(_hits(df, id_col, text_col, True).withColumn("row", F.monotonically_increasing_id()), "texts-with-entities")
    mentions = stage(hits.select("row", F.posexplode("ents").alias("i", "e")).select("row", "i", "e.kind", "e.value"), "mentions")
    found = stage(distinct_entities(mentions), "entities")
    names = stage(surrogates(found, key), "surrogate-table")
    put = mentions.withColumn("kind", entity_kind()).join(names, ["kind", "value"]).groupBy("row").agg(F.collect_list(F.struct("i", "surrogate")).alias("put"))
    rows = hits.join(stage(put, "replacements"), "row")
    id_type = dict(rows.dtypes)["id"]
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def write(batches):
        for b in batches:
            texts, spans = [], []
            for text, ents, put in zip(*(b.column(c).to_pylist() for c in ("text", "ents", "put"))):
                put = {p["i"]: p["surrogate"] for p in put}
                out, at, size, marks = [], 0, 0, []
                for i, e in enumerate(ents):
                    new = written(text[e["start"]:e["end"]], put[i], e["kind"])
                    out += [text[at:e["start"]], new]
                    size += e["start"] - at
                    marks.append({"start": size, "end": size + len(new), "kind": e["kind"]})
                    size, at = size + len(new), e["end"]
                texts.append("".join([*out, text[at:]]))
                spans.append(marks)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(texts, pa.string()), pa.array(spans, span)], ["id", "text", "spans"])

    spans_type = "array<struct<start: int, end: int, kind: string>>"
    done = rows.select("id", "text", "ents", "put").mapInArrow(write, f"id {id_type}, text string, spans {spans_type}")
    rest = _hits(df, id_col, text_col, False).withColumn("spans", F.array().cast(spans_type))
    out = done.unionByName(rest)
    return out.select(F.col("id").alias(id_col), F.col("text").alias(text_col), F.size("spans").alias("n_entities"), "spans")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "text", "n_entities")
