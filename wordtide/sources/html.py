"""HTML extraction (S3, S7, S8) as Arrow UDFs returning arrays that Spark explodes.

Parsing is the one step with no Spark builtin: each page is parsed by the stdlib
``html.parser`` inside the UDF (one page per row, Arrow batches), and the result
comes back as ``array<struct<...>>`` so ``posexplode`` keeps document order.  The
small element tree below applies the usual implied-end rules (void elements, a
``<p>`` closes an open ``<p>``) so unclosed paragraphs nest like a browser's.
"""

from __future__ import annotations

import codecs
import re
from html.parser import HTMLParser
from typing import Optional

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values (the reference's markup conventions) ------------------------
# Board page: thread links are the first <a> whose href matches this pattern,
# inside a <p> whose style matches the style pattern.
BOARD_CONTAINER_TAG = "p"
BOARD_STYLE_PATTERN = r"background:\s*#BEB"
THREAD_LINK_PATTERN = r"/test/read\.cgi/"
# Thread page: each post is a <div class="clear post"> (exact class string), its
# date the text of <span class="date">, its body the text of <div class="post-content">.
POST_TAG, POST_CLASS = "div", "clear post"
DATE_TAG, DATE_CLASS = "span", "date"
CONTENT_TAG, CONTENT_CLASS = "div", "post-content"
# -----------------------------------------------------------------------------

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
# Start tags that implicitly close an open <p>.
CLOSES_P = {"p", "div", "ul", "ol", "table", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote",
            "article", "section", "nav", "header", "footer", "form", "hr"}
SKIP_TEXT = {"script", "style", "template"}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict, parent: Optional["Node"]):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def iter(self):
        """Descendant elements in document order (iterative: deep pages are fine)."""
        stack = [iter(self.children)]
        while stack:
            for c in stack[-1]:
                if isinstance(c, Node):
                    yield c
                    stack.append(iter(c.children))
                    break
            else:
                stack.pop()

    def strings(self):
        """Text nodes in document order, skipping script/style contents."""
        stack = [iter(self.children)]
        while stack:
            for c in stack[-1]:
                if isinstance(c, Node):
                    if c.tag not in SKIP_TEXT:
                        stack.append(iter(c.children))
                        break
                else:
                    yield c
            else:
                stack.pop()

    def text(self, sep: str = "", strip: bool = True) -> str:
        parts = [s.strip() for s in self.strings()] if strip else list(self.strings())
        return sep.join(p for p in parts if p)


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {}, None)
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            n = self.cur
            while n is not self.root and n.tag != "p":
                n = n.parent
            if n.tag == "p":
                self.cur = n.parent
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur)
        self.cur.children.append(node)
        if tag not in VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(Node(tag, {k: (v or "") for k, v in attrs}, self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not self.root and n.tag != tag:
            n = n.parent
        if n is not self.root:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def parse(html: Optional[str]) -> Node:
    b = _TreeBuilder()
    if html:
        try:
            b.feed(html)
            b.close()
        except Exception:  # broken markup: keep what was built
            pass
    return b.root


def _class_is(node: Node, cls: Optional[str]) -> bool:
    """A one-word class matches any element carrying that class; a value with
    spaces must equal the whole class attribute (``clear post``)."""
    if cls is None:
        return True
    value = node.attrs.get("class")
    if value is None:
        return False
    return value == cls or (not any(ch.isspace() for ch in cls) and cls in value.split())


def _first(node: Node, tag: str, cls: Optional[str]) -> Optional[Node]:
    for d in node.iter():
        if d.tag == tag and _class_is(d, cls):
            return d
    return None


def board_links(html: Optional[str], container_tag: str = BOARD_CONTAINER_TAG,
                style_pattern: Optional[str] = BOARD_STYLE_PATTERN,
                link_pattern: str = THREAD_LINK_PATTERN) -> list[dict]:
    """S3: for each container whose style matches, its first <a> with a matching href."""
    style_re = re.compile(style_pattern) if style_pattern else None
    link_re = re.compile(link_pattern)
    out = []
    for el in parse(html).iter():
        if el.tag != container_tag:
            continue
        if style_re is not None and not style_re.search(el.attrs.get("style", "")):
            continue
        for a in el.iter():
            href = a.attrs.get("href")
            if a.tag == "a" and href and link_re.search(href):
                out.append({"href": href, "title": a.text()})
                break
    return out


def thread_posts(html: Optional[str], post_tag: str = POST_TAG, post_class: Optional[str] = POST_CLASS,
                 date_tag: str = DATE_TAG, date_class: Optional[str] = DATE_CLASS,
                 content_tag: Optional[str] = CONTENT_TAG, content_class: Optional[str] = CONTENT_CLASS) -> list[dict]:
    """(date_text, content) per post element; content is the stripped text
    nodes joined by newlines, of the first content element or, with ``content_tag`` None,
    of the whole post.  Posts lacking either are kept here, S9 drops them."""
    out = []
    for el in parse(html).iter():
        if el.tag != post_tag or not _class_is(el, post_class):
            continue
        d = _first(el, date_tag, date_class)
        c = _first(el, content_tag, content_class) if content_tag else el
        out.append({"date_text": d.text() if d is not None else "",
                    "content": c.text("\n") if c is not None else ""})
    return out


LINKS_TYPE = T.ArrayType(T.StructType([T.StructField("href", T.StringType()),
                                       T.StructField("title", T.StringType())]))
POSTS_TYPE = T.ArrayType(T.StructType([T.StructField("date_text", T.StringType()),
                                       T.StructField("content", T.StringType())]))


def board_links_udf(container_tag: str = BOARD_CONTAINER_TAG, style_pattern: Optional[str] = BOARD_STYLE_PATTERN,
                    link_pattern: str = THREAD_LINK_PATTERN):
    @F.pandas_udf(LINKS_TYPE)
    def _links(s: pd.Series) -> pd.Series:
        return pd.Series([None if h is None else board_links(h, container_tag, style_pattern, link_pattern)
                          for h in s], dtype=object)

    return _links


def thread_posts_udf(post_tag: str = POST_TAG, post_class: Optional[str] = POST_CLASS,
                     date_tag: str = DATE_TAG, date_class: Optional[str] = DATE_CLASS,
                     content_tag: Optional[str] = CONTENT_TAG, content_class: Optional[str] = CONTENT_CLASS):
    @F.pandas_udf(POSTS_TYPE)
    def _posts(s: pd.Series) -> pd.Series:
        return pd.Series([None if h is None else thread_posts(h, post_tag, post_class, date_tag, date_class,
                                                              content_tag, content_class) for h in s], dtype=object)

    return _posts


@F.pandas_udf(T.StringType())
def html_text(s: pd.Series) -> pd.Series:
    """S8 as a column function: stripped text nodes joined by newlines."""
    return pd.Series([None if h is None else parse(h).text("\n") for h in s], dtype=object)


# Charsets that Spark decodes itself when the bytes are well formed: UTF-8 text that encodes to the same bytes.
UTF8_NAMES = ["utf-8", "utf8"]


def decode_udf(default_charset: str = "shift_jis"):
    """Bytes -> text with a per-row charset; bad bytes are replaced, never dropped.

    A NULL or unknown charset falls back on the default, so a page with a misspelt charset is still a page.
    """

    @F.pandas_udf(T.StringType())
    def _decode(body: pd.Series, charset: pd.Series) -> pd.Series:
        out = []
        for b, cs in zip(body, charset):
            if b is None:
                out.append(None)
                continue
            try:
                codecs.lookup(cs or default_charset)
            except LookupError:
                cs = None
            out.append(bytes(b).decode(cs or default_charset, "replace"))
        return pd.Series(out, dtype=object)

    return _decode


def decode(body: Column, charset: Optional[Column] = None, default_charset: str = "shift_jis") -> Column:
    """S2. Well-formed UTF-8 bodies are decoded in the JVM; only the others reach the Arrow UDF."""
    cs = charset if charset is not None else F.lit(None).cast("string")
    plain = F.lower(F.coalesce(cs, F.lit(default_charset))).isin(UTF8_NAMES) & F.is_valid_utf8(body.cast("string"))
    rest = decode_udf(default_charset)(F.when(~F.coalesce(plain, F.lit(False)), body), cs)
    return F.when(plain, body.cast("string")).otherwise(rest)
