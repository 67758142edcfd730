"""Text functions: codecs, hashes, clean-up, titles. Built-in expressions where they exist, else one Arrow UDF."""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Control characters but tab, line feed and carriage return.
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
#: White space on a line: space, tab, no-break and zero-width space.
BLANK = r"[ \t\x{A0}\x{200B}]+"


def doc_key(title: Column) -> Column:
    """SHA-1 hex of a canonical title."""
    return F.sha1(title.cast("binary"))


def chunk_key(doc: Column, seq: Column) -> Column:
    """doc:00042, with more digits where five don't do."""
    return F.format_string("%s:%05d", doc, seq)


def content_key(text: Column) -> Column:
    """SHA-256 hex."""
    return F.sha2(text.cast("binary"), 256)


#: The URL namespace of UUIDs (RFC 4122), as hex.
_URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def point_key(key: Column) -> Column:
    """The version-5 UUID of a key in the URL namespace."""
    digest = F.sha1(F.concat(F.unhex(F.lit(_URL_NAMESPACE)), key.cast("binary")))
    nibble = F.substring(digest, 17, 1)
    variant = F.substring(F.lit("89ab89ab89ab89ab"), F.conv(nibble, 16, 10).cast("int") + 1, F.lit(1))
    return F.concat_ws(
        "-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12)
    )


def url_decoded(text: Column) -> Column:
    """Percent-decoding in which a plus stays a plus; null for a broken escape."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def url_encoded(text: Column) -> Column:
    """Percent-encoding of everything but letters, digits and _ . - ~."""
    out = F.url_encode(text)
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def parent_title(title: Column) -> Column:
    """What stands before the last slash, trimmed; null without a slash or if nothing is left."""
    parent = F.trim(F.regexp_extract(title, r"(?s)^(.*)/[^/]*$", 1))
    return F.when((parent != "") & (parent != title), parent)


def head_noun(category: Column) -> Column:
    """The last word of a category, the possessive particle read as a space."""
    return F.element_at(F.split(F.trim(F.regexp_replace(F.replace(category, F.lit("의"), F.lit(" ")), r"(?U)\s+", " ")), " "), -1)


def shard_path(key: Column) -> Column:
    """aa/bb/key.gz; keys under four characters are filled with zeros on the left."""
    full = F.when(F.length(key) < 4, F.lpad(key, 4, "0")).otherwise(key)
    return F.concat(F.concat_ws("/", F.substring(full, 1, 2), F.substring(full, 3, 2), full), F.lit(".gz"))


def breadcrumb(title: Column, path: Column, body: Column) -> Column:
    """title > heading > heading, then the body on the next line."""
    return F.concat(F.array_join(F.concat(F.array(title), F.coalesce(path, F.array().cast("array<string>"))), " > "), F.lit("\n"), body)


@F.arrow_udf(StringType())
def unescaped(values: pa.Array) -> pa.Array:
    """HTML entities decoded."""
    return pa.array([None if v is None else html.unescape(v) for v in values.to_pylist()], pa.string())


def without_control(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, "")


#: Elements without text, folding boxes, tool links and noise lines of the site (fixed values).
_DROPPED = r"(?is)<(script|style|svg|noscript)\b[^>]*>.*?</\1\s*>"
_FOLDED = r"(?s)<details\b[^>]*>\s*<summary\b[^>]*>(?:(?!</summary>).)*?(?:펼치기|접기).*?</details\s*>"
_TOOLS = r"""(?is)<a\b[^>]*\bhref=['"](?:/edit/|/discuss/|/history/|/member/|/backlink/|/title_history/|/RecentChanges|/RecentDiscuss|/Search|/action/|/w/%EB%B6%84%EB%A5%98:|/w/분류:)[^'"]*['"][^>]*>.*?</a\s*>"""
_NOISE = r"^(분류|편집|토론|역사|최근 수정 시각:?|\[?\s*펼치기\s*·?\s*접기\s*\]?|더 보기|접기)$"


def plain_text(fragment: Column) -> Column:
    """The readable text of an HTML fragment, in the order that the result hangs on.

    Dropped elements, folding boxes and tool links go first, then line breaks and images; ends of blocks
    become line ends, other tags spaces; entities are decoded before control characters and edit marks
    are removed; blanks are made single, lines trimmed, noise lines dropped, and at most one empty line
    is left in a row. Null gives null.
    """
    out = fragment
    for pattern in (_DROPPED, _FOLDED, _TOOLS, r"(?i)<(?:img|input|br)\b[^>]*/?>"):
        out = F.regexp_replace(out, pattern, " ")
    out = F.regexp_replace(out, r"(?i)</(p|div|li|tr|h[1-6])\s*>", "\n")
    out = unescaped(F.regexp_replace(out, r"<[^>]+>", " "))
    out = F.regexp_replace(F.regexp_replace(without_control(out), r"\[\s*편집\s*\]", " "), BLANK, " ")
    lines = F.filter(F.transform(F.split(out, "\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), lambda x: ~x.rlike(_NOISE))
    return F.regexp_replace(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"), r"(?U)^\s+|\s+$", "")


_SPACE = re.compile(r"\s+")


def clean_cell(value: str) -> str:
    """A table cell's text: tags as spaces, entities decoded, white space single."""
    return _SPACE.sub(" ", html.unescape(re.sub(r"<[^>]+>", " ", value))).strip()
