"""Column functions for text: clean-up, length gate, previews, file-name parts.

Everything but Unicode NFC is a native Spark expression, so it stays inside
whole-stage code generation.  NFC has no built-in; it runs in an Arrow batch
UDF and only for rows that can change (a character at or above U+0300).
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from vellum.functions.arrays import arrow_udf

# White space as Python's str.isspace() defines it, as one
# regex class that Java and RE2 read the same way.
WS = (
    r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# The same set for Java's regex engine: Character.isWhitespace plus the four
# code points Python also counts (checked equal on every BMP code point).
# A single predicate per character instead of a dozen ranges: ~3x faster.
JAVA_WS = r"[\p{javaWhitespace}\x{85}\x{a0}\x{2007}\x{202f}]"
JAVA_NON_WS = "[^" + JAVA_WS[1:]
# The same white space as a plain character set (for the native trim).
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"
# Control characters removed by the clean-up (tab, LF, CR stay).
CONTROL_CHARS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
# Typographic quotes and dashes, and their ASCII replacements.
TYPOGRAPHIC_FROM = "’‘“”–—"
TYPOGRAPHIC_TO = "''\"\"--"
# Shortest kept page, section or chunk, in characters.
MIN_CHUNK_LENGTH = 60
# Encoder instructions.
PASSAGE_PREFIX = "Represent this passage for searching relevant queries: "
QUERY_PREFIX = "Represent this query for searching relevant passages: "


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _nfc_series(s: pd.Series) -> pd.Series:
    def one(t):
        if t is None or unicodedata.is_normalized("NFC", t):
            return t
        return unicodedata.normalize("NFC", t)

    return s.map(one)


_nfc_udf = None


def nfc(c: Column | str) -> Column:
    """Unicode NFC.  Text made only of code points below U+0300 is already NFC
    (no combining marks, no Hangul), so only the other rows cross into Python."""
    global _nfc_udf
    if _nfc_udf is None:
        _nfc_udf = arrow_udf(_nfc_series, StringType())
    c = _col(c)
    needs = c.rlike(r"[^\x{0}-\x{2ff}]")
    return F.coalesce(_nfc_udf(F.when(needs, c)), c)


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: Unicode white space off both ends (native
    ``btrim(x, <set>)``, no regex)."""
    return F.btrim(_col(c), F.lit(WS_CHARS))


def normalize_text(c: Column | str, *, with_nfc: bool = True) -> Column:
    """NFC, drop control characters, ASCII quotes/dashes, collapse blank
    runs, cap newline runs at two, empty white-space-only lines, strip."""
    x = nfc(c) if with_nfc else _col(c)
    x = F.regexp_replace(x, CONTROL_CHARS, "")
    x = F.translate(x, TYPOGRAPHIC_FROM, TYPOGRAPHIC_TO)
    x = F.regexp_replace(x, r"[ \t]+", " ")
    x = F.regexp_replace(x, r"\n{3,}", "\n\n")
    x = F.regexp_replace(x, rf"(?dm)^{JAVA_WS}+$", "")
    return strip_ws(x)


def long_enough(c: Column | str, n: int = MIN_CHUNK_LENGTH) -> Column:
    """At least ``n`` characters (code points)."""
    return F.length(_col(c)) >= n


def preview(c: Column | str, n: int = 600, flatten: bool = False) -> Column:
    """First ``n`` characters, ``...`` when longer; ``flatten`` turns
    newlines into spaces (the length test stays on the original text)."""
    c = _col(c)
    head = F.substring(c, 1, n)
    if flatten:
        head = F.replace(head, F.lit("\n"), F.lit(" "))
    return F.concat(head, F.when(F.length(c) > n, F.lit("...")).otherwise(F.lit("")))


def file_name(path: Column | str) -> Column:
    """Last path component."""
    return F.regexp_extract(_col(path), r"([^/]*)$", 1)


def file_suffix(path: Column | str) -> Column:
    """``.ext`` of the name as pathlib gives it ('' for ``.rc`` or ``a.``)."""
    return F.regexp_extract(file_name(path), r"^.+(\.[^.]+)$", 1)


def file_stem(path: Column | str) -> Column:
    """Name without its suffix."""
    name = file_name(path)
    return F.substring(name, F.lit(1), F.length(name) - F.length(file_suffix(path)))


def file_type(path: Column | str) -> Column:
    """Lower-cased suffix without the dot."""
    return F.lower(F.regexp_replace(file_suffix(path), r"^\.", ""))


def passage_text(text: Column | str, model_name: str) -> Column:
    """Passage prefix only for encoder names containing ``bge``."""
    if "bge" in model_name.lower():
        return F.concat(F.lit(PASSAGE_PREFIX), _col(text))
    return _col(text)


def query_text(text: Column | str, with_prefix: bool = True) -> Column:
    """Query prefix (G2 always adds it; G1 never does)."""
    return F.concat(F.lit(QUERY_PREFIX), _col(text)) if with_prefix else _col(text)
