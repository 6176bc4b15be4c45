"""Text column functions: tokenising (T1), term normalisation.

Everything except NFKC runs as built-in (JVM) expressions. NFKC has no Spark SQL
builtin; it is an Arrow-batched pandas UDF that sees token arrays with a non-ASCII
token, or *distinct* surfaces (``operators.terms.normalize_surfaces``).
"""

from __future__ import annotations

import unicodedata
from typing import Callable, Iterable, Optional

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values (must equal the reference's normalisation rules) -----------
# Symbols deleted by term normalisation:  _ - . , : ; / \ ( ) [ ] ! ?
DELETED_SYMBOLS = "_-.,:;/\\()[]!?"
# Long-vowel mark and wave dashes deleted by term normalisation:  ー 〜 ~
DELETED_LONG_MARKS = "ー〜~"
# Terms of at most this many code points are filtered (normalised to '').
MAX_FILTERED_LENGTH = 1
# -----------------------------------------------------------------------------

# Whitespace as Python's ``str.split``/``re`` ``\s`` sees it: Unicode White_Space
# plus the four information separators U+001C..U+001F.
WHITESPACE_RUN = r"(?U)[\s\x{1c}-\x{1f}]+"

# Default tokenizer: maximal runs of one script class — Latin letters with
# digits, Han ideographs, Katakana (with the prolonged-sound mark).  This is our
# stand-in for a morphological analyser's noun list.
TOKEN_PATTERN = r"[\p{IsLatin}\p{Nd}]+|\p{IsHan}+|[\p{IsKatakana}ー]+"
# The same classes in RE2 syntax (DuckDB oracle).
TOKEN_PATTERN_RE2 = r"[\p{Latin}\p{Nd}]+|\p{Han}+|[\p{Katakana}ー]+"


def regex_tokens(content: Column, pattern: str = TOKEN_PATTERN) -> Column:
    """Surfaces in text order; null and empty texts have none (T5: that is no failure)."""
    return F.coalesce(F.regexp_extract_all(content, F.lit(pattern), F.lit(0)), F.array().cast("array<string>"))


def safe_udf_tokenizer(fn: Callable[[str], Iterable[str]]):
    """Wrap a per-text Python tokenizer as a pandas UDF returning array<string>.

    T5: an exception on one text yields NULL for that row (counted as a
    tokenizer failure) and the other rows go on. Null and empty texts have no tokens.
    """

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def _tok(s: pd.Series) -> pd.Series:
        out = []
        for text in s:
            if not text:
                out.append([])
                continue
            try:
                out.append([t for t in fn(text)])
            except Exception:
                out.append(None)
        return pd.Series(out, dtype=object)

    return _tok


def _nfkc_one(x: Optional[str]) -> Optional[str]:
    if x is None or x.isascii():  # ASCII is NFKC-stable
        return x
    return unicodedata.normalize("NFKC", x)


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(_nfkc_one)


# Not for Catalyst to push below a distinct or a join into more rows.
nfkc = _nfkc.asNondeterministic()


# Tokens that normalisation leaves as they are.
PLAIN_TOKEN = r"^[a-z0-9]{%d,}\z" % (MAX_FILTERED_LENGTH + 1)
# What normalisation changes in tokens between blanks: another character, or a token that is empty or too short.
ODD_CHARACTER, SHORT_TOKEN = "[^a-z0-9 ]", " [^ ]{0,%d} " % MAX_FILTERED_LENGTH


def normalize_after_nfkc(c: Column) -> Column:
    """T3 minus NFKC, then T4: lower → delete symbols and long marks →
    collapse whitespace → trim → '' when at most one code point remains.

    One look at a plain token spares it the other steps, which cost several times as much."""
    x = F.lower(c)
    x = F.translate(x, DELETED_SYMBOLS + DELETED_LONG_MARKS, "")
    x = F.regexp_replace(x, WHITESPACE_RUN, " ")
    x = F.trim(x)
    return F.when(c.rlike(PLAIN_TOKEN), c).when(c.isNull(), F.lit("")).when(F.length(x) <= MAX_FILTERED_LENGTH, F.lit("")).otherwise(x)


@F.arrow_udf(T.ArrayType(T.StringType()))
def nfkc_tokens(tokens: pa.Array) -> pa.Array:
    values = tokens.flatten()
    if not len(values):  # a batch of plain posts: nothing to do, and no Python object per post
        return tokens
    out = pa.array([_nfkc_one(t) for t in values.to_pylist()], pa.string())
    offsets = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), out, mask=pc.is_null(tokens) if tokens.null_count else None)


def normalize_tokens(tokens: Column) -> Column:
    """T3/T4 for every element of a token array; NULL stays NULL, and no element of the result is NULL.

    A look at the joined tokens finds the arrays of plain ones, which stay as they are: Spark interprets a step through
    the elements. Only arrays with a non-ASCII token are sent to the Arrow UDF; the rest stays in the JVM. In its place goes
    an empty array: an Arrow batch is measured at every row, and a list column then walks over all NULLs since its last
    value again, which makes a batch without values quadratic in its rows.
    """
    joined = F.concat(F.lit(" "), F.array_join(tokens, " ", "?"), F.lit(" "))  # a NULL element is not plain
    plain = ~(joined.rlike(ODD_CHARACTER) | joined.rlike(SHORT_TOKEN))
    wide = F.octet_length(joined) > F.length(joined)
    nf = F.when(wide, nfkc_tokens(F.when(wide, tokens).otherwise(F.array().cast("array<string>")))).otherwise(tokens)
    return F.when(plain, tokens).otherwise(F.transform(nf, normalize_after_nfkc))
