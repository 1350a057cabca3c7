"""P1-P3 HTML handling: charset decode, HTTP header strip, HTML -> text.

The text layout is our own definition (a chain of RE2-safe substitutions so
the SQL oracle can run the same chain): drop comments and script/style/head
blocks, turn block-level tags into line breaks, strip the remaining tags,
decode character references, then trim lines and drop blank ones.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quarry.functions import charset
from quarry.functions.text import _c

BLOCK_TAGS = ("address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|"
              "form|h1|h2|h3|h4|h5|h6|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul")

HTML_STEPS = [
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<script\b[^>]*>.*?</script\s*>", ""),
    (r"(?is)<style\b[^>]*>.*?</style\s*>", ""),
    (r"(?is)<head\b[^>]*>.*?</head\s*>", ""),
    (r"(?i)</?(?:" + BLOCK_TAGS + r")\b[^>]*>", "\n"),
    (r"<[^>]*>", ""),
]
SPACE_STEPS = [
    (r"[ \t\x{A0}]+", " "),
    (r"(?m)^ +| +$", ""),
    (r"\n{2,}", "\n"),
    (r"^\n+|\n+$", ""),
]


def _unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def decode_references(col) -> Column:
    """Character references to characters, once and from left to right.

    All decimal and hexadecimal references and every name of the HTML
    standard (Arrow-batched; texts without ``&`` stay on the JVM).  What a
    reference decodes to is not decoded again: ``&amp;lt;`` gives ``&lt;``.
    """
    t = _c(col)
    has = F.contains(t, F.lit("&"))
    return F.when(has, F.pandas_udf(_unescaped, "string")(F.when(has, t))).otherwise(t)


def html_to_text(col) -> Column:
    """P1."""
    t = _c(col)
    for pat, rep in HTML_STEPS:
        t = F.regexp_replace(t, pat, rep)
    t = decode_references(t)
    for pat, rep in SPACE_STEPS:
        t = F.regexp_replace(t, pat, rep)
    return t


_CHARSET = r"(?i)charset\s*=\s*[\"']?\s*([a-z0-9_:.-]{2,40})"


@F.pandas_udf(StringType())
def _decode_as(content: pd.Series, names: pd.Series) -> pd.Series:
    return pd.Series([None if raw is None else charset.decode(bytes(raw), name) for raw, name in zip(content, names)], dtype=object)


def decode_bytes(col, header=None) -> Column:
    """UTF-8 when valid, else the charset named in the HTTP header or the page, else the one detected.

    ``header`` is a string column with the response header, if there is one; a page
    names its charset within its first 4096 bytes.  Only content that is not valid UTF-8
    goes through Arrow, Spark's own ``decode`` knowing Unicode and Latin-1 only; without
    a (known) name :func:`quarry.functions.charset.detect` reads the bytes.  Null content
    gives null.
    """
    b = _c(col)
    s = b.cast("string")
    page = F.regexp_extract(F.decode(F.substring(b, 1, 4096), "ISO-8859-1"), _CHARSET, 1)
    name = F.lower(page)
    if header is not None:
        told = F.regexp_extract(F.coalesce(_c(header), F.lit("")), _CHARSET, 1)
        name = F.lower(F.when(told != "", told).otherwise(page))
    other = ~F.is_valid_utf8(s)
    return F.when(other, _decode_as(F.when(other, b), name)).otherwise(s)


def strip_http_header(col) -> Column:
    """P3 on a binary payload: bytes after the first CRLFCRLF, else all.

    Works on the hex form so no byte is reinterpreted as text.
    """
    h = F.hex(_c(col))
    # hex pairs must align: search only at even offsets
    idx = F.locate("0D0A0D0A", h)
    first_even = F.when((idx > 0) & (idx % 2 == 1), idx)
    return F.when(first_even.isNotNull(), F.unhex(F.substring(h, first_even + 8, F.length(h)))).otherwise(_c(col))
