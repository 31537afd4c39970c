"""Row-local block and chunk building: one file = one row, no shuffle.

A decoder yields, per file row, an array of pages or of paragraph elements.
Everything from there to numbered chunks happens inside that row with array
functions: pages are numbered by position, sections are cut from element
ranges, blocks are split, pieces are stripped, filtered and numbered.  The
only Python is two small Arrow helpers - NFC for non-ASCII-ish arrays and the
sequential heading rule on an array of booleans - and the recursive splitter.

Compared with the row-per-element form in ``vellum.operators.blocks`` (kept
for element tables), this removes every window and shuffle between decoding
and chunk numbering, and a large file costs one row of work wherever it is.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.functions.arrays import arrow_udf
from vellum.functions.text import MIN_CHUNK_LENGTH, normalize_text, strip_ws
from vellum.functions.vectors import bind
from vellum.operators import chunking
from vellum.operators.blocks import SECTION_NAME, is_heading

_RANGE = T.ArrayType(
    T.StructType([T.StructField("head", T.IntegerType()), T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType())])
)


def section_ranges(heads) -> list[dict]:
    """X5 rule on the heading flags of a document's non-blank elements.

    Returns one ``(head, lo, hi)`` per section that has body lines: ``head``
    is the index of the heading that opened it (-1 before any), the body is
    elements ``lo .. hi-1``.  A heading opens a new section only when the
    current one has lines; otherwise it is body text."""
    out, head, lo, lines = [], -1, 0, 0
    for i, h in enumerate(heads):
        if h and lines:
            out.append({"head": head, "lo": lo, "hi": i})
            head, lo, lines = i, i + 1, 0
        else:
            lines += 1
    if lines:
        out.append({"head": head, "lo": lo, "hi": len(heads)})
    return out


def _ranges_series(s: pd.Series) -> pd.Series:
    return s.map(lambda a: [] if a is None else section_ranges(list(a)))


def _nfc_array_series(s: pd.Series) -> pd.Series:
    def one(a):
        if a is None:
            return None
        return [t if t is None or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t) for t in a]

    return s.map(one)


def _split_array_series(size: int, overlap: int):
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda a: [] if a is None else [chunking.split_recursive(t or "", chunking.SEPARATORS, size, overlap) for t in a])

    return run


def nfc_array(texts: Column) -> Column:
    """NFC of every string of an array; rows made only of code points below
    U+0300 skip the Python step."""
    udf = arrow_udf(_nfc_array_series, T.ArrayType(T.StringType()))
    needs = F.exists(texts, lambda t: t.rlike(r"[^\x{0}-\x{2ff}]"))
    return F.coalesce(udf(F.when(needs, texts)), texts)


def page_blocks_array(pages: Column, min_len: int = MIN_CHUNK_LENGTH) -> Column:
    """X2 in one row: ``array<string>`` pages -> ``array<struct<page,
    total_pages, text>>`` of normalised pages with at least ``min_len``
    characters, numbered from 1 among all pages."""
    texts = nfc_array(pages)

    def build(x):
        blocks = F.transform(
            x["t"],
            lambda t, i: F.struct(
                (i + 1).cast("int").alias("page"), x["n"].alias("total_pages"),
                normalize_text(F.coalesce(t, F.lit("")), with_nfc=False).alias("text"),
            ),
        )
        return F.filter(blocks, lambda b: F.length(b["text"]) >= min_len)

    return bind(F.struct(texts.alias("t"), F.size(pages).cast("int").alias("n")), build)


def section_blocks_array(elements: Column, min_len: int = MIN_CHUNK_LENGTH) -> Column:
    """X5-X8 in one row: ``array<struct<style, text>>`` in reading order (tables
    last) -> ``array<struct<section, section_idx, text>>``."""
    kept = F.filter(
        F.transform(elements, lambda e: F.struct(e["style"].alias("style"), strip_ws(e["text"]).alias("text"))),
        lambda e: F.length(e["text"]) > 0,
    )
    ranges_udf = arrow_udf(_ranges_series, _RANGE)
    # Python UDFs cannot sit inside lambdas: call them at the top, then bind
    # their results (and the element array) once to one lambda variable.
    raw = F.transform(kept, lambda e: e["text"])
    ranges = ranges_udf(F.transform(kept, lambda e: is_heading(e["style"])))
    texts = nfc_array(raw)

    def build(x):
        secs = F.transform(
            x["r"],
            lambda r: F.struct(
                F.when(r["head"] >= 0, F.element_at(x["raw"], r["head"] + 1)).alias("heading"),
                normalize_text(F.array_join(F.slice(x["t"], r["lo"] + 1, r["hi"] - r["lo"]), "\n"), with_nfc=False).alias("text"),
            ),
        )
        good = F.filter(secs, lambda s: F.length(s["text"]) >= min_len)
        return F.transform(
            good,
            lambda s, i: F.struct(
                F.coalesce(s["heading"], F.format_string(SECTION_NAME.replace("{}", "%d"), i + 1)).alias("section"),
                (i + 1).cast("int").alias("section_idx"),
                s["text"].alias("text"),
            ),
        )

    return bind(F.struct(raw.alias("raw"), ranges.alias("r"), texts.alias("t")), build)


def chunk_blocks_array(blocks: Column, size: int = chunking.CHUNK_SIZE, overlap: int = chunking.CHUNK_OVERLAP,
                       min_len: int = MIN_CHUNK_LENGTH, fields: list[str] | None = None, splitter=None) -> Column:
    """T5-T7 in one row: blocks ``array<struct<..., text>>`` -> kept chunks
    ``array<struct<fields..., text>>`` in (block, piece) order; the chunk id
    is the array position and ``total_chunks`` the array size."""
    fields = fields or []
    split = splitter or arrow_udf(_split_array_series(size, overlap), T.ArrayType(T.ArrayType(T.StringType())))
    pieces = split(F.transform(blocks, lambda b: b["text"]))

    def build(x):
        per_block = F.transform(
            x["b"],
            lambda b, i: F.transform(
                chunking.kept_pieces(F.element_at(x["p"], i + 1), min_len),
                lambda p: F.struct(*[b[f].alias(f) for f in fields], p.alias("text")),
            ),
        )
        return F.flatten(per_block)

    return bind(F.struct(blocks.alias("b"), pieces.alias("p")), build)
