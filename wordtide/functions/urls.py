"""URL column functions."""

from __future__ import annotations

from typing import Optional
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEME = r"[A-Za-z][A-Za-z0-9+.-]*"
# Path of a URL or bare path: after the optional scheme and authority, before ?/#.
PATH_RE = rf"^(?:{SCHEME}:)?(?://[^/?#]*)?([^?#]*)"
VALID_URL_RE = rf"^{SCHEME}://[^/?#]+"
ORIGIN_RE = rf"^({SCHEME}://[^/?#]*)"
# --- fixed values ------------------------------------------------------------
# The path segment that precedes the board and thread id in thread URLs.
READ_CGI = "read.cgi"
# -----------------------------------------------------------------------------


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, PATH_RE, 1)


def thread_id(url: Column) -> Column:
    """The path segment two after ``read.cgi``; NULL when absent."""
    parts = F.filter(F.split(url_path(url), "/"), lambda s: s != "")
    i = F.array_position(parts, READ_CGI)
    return F.when(i > 0, F.try_element_at(parts, (i + 2).cast("int")))


def is_valid_url(url: Column) -> Column:
    """Has a scheme and a host."""
    return F.coalesce(url.rlike(VALID_URL_RE), F.lit(False))


def _join_url(base: Optional[str], path: Optional[str]) -> Optional[str]:
    return None if base is None or path is None else urljoin(base, path)


@F.pandas_udf(T.StringType())
def _join_url_udf(base: pd.Series, path: pd.Series) -> pd.Series:
    return pd.Series([_join_url(b, p) for b, p in zip(base, path)], dtype=object)


def build_url(base: Column, path: Column) -> Column:
    """Resolve ``path`` against ``base`` with RFC 3986 rules; an empty path ends with '/'.

    Ordinary cases are JVM expressions: an empty path, an absolute http URL, ``//host``, ``/root``, ``?query``,
    ``#fragment`` and ``relative`` paths without dot segments against an http base. Dot segments, other schemes and
    parameters go to the Arrow UDF, which sees NULLs for all other rows.
    """
    http = base.rlike(r"^https?://[^/?#]+")
    origin = F.regexp_extract(base, ORIGIN_RE, 1)
    no_fragment = F.regexp_extract(base, r"^([^#]*)", 1)
    no_query = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.regexp_extract(url_path(base), r"^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    dots = (path.rlike(r"(^|/)\.{1,2}([/?#]|$)") | url_path(base).rlike(r"(^|/)\.{1,2}(/|$)") | path.contains(";") | base.contains(";")
            | path.rlike(r"//") | path.rlike(r"[?#]$") | base.rlike(r"[?#]$") | path.rlike(r"^[/?#].*[\x00-\x20]|[\x00-\x20]") | url_path(base).rlike(r"//"))
    relative = path.rlike(r"^[^/?#:]+([/?#].*)?$")
    plain = http & ~dots & ((path == "") | path.startswith("/") | path.startswith("?") | path.startswith("#") | relative)
    joined = (F.when(path == "", base)
              .when(path.startswith("/"), F.concat(origin, path))
              .when(path.startswith("?"), F.concat(no_query, path))
              .when(path.startswith("#"), F.concat(no_fragment, path))
              .otherwise(F.concat(origin, folder, path)))
    rest = _join_url_udf(F.when(~plain, base), F.when(~plain, path))
    out = F.when(plain, joined).otherwise(rest)
    return F.when((path == "") & ~out.endswith("/"), F.concat(out, F.lit("/"))).otherwise(out)
