"""Block building: pages and sections of a document.

Elements arrive as rows ``(doc, pos, style, text)`` and pages as rows
``(doc, page, text)``; grouping into sections is a gaps-and-islands computation
with skew-safe running aggregates, so no document is ever gathered into one
task except as the text value of the block it produces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import MIN_CHUNK_LENGTH, normalize_text, strip_ws
from vellum.operators.windows import running_agg

# Name of a section before its first heading, and the separators
# used to lay out table cells and rows as text.
SECTION_NAME = "Sección {}"
CELL_SEP = " | "
ROW_SEP = "\n"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def _ordered_join(order: str, text: str, sep: str) -> Column:
    """Ordered concatenation of a group: sort (order, text) structs, join texts."""
    return F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(order), F.col(text)))), lambda s: s[text]), sep
    )


def page_blocks(pages: DataFrame, doc: str = "doc", page: str = "page", text: str = "text",
                min_len: int = MIN_CHUNK_LENGTH, normalize: bool = True) -> DataFrame:
    """Normalise each page and drop those shorter than ``min_len``; the page
    keeps its 1-based number and ``total_pages`` counts all pages of the doc."""
    x = running_agg(pages.withColumn("__one", F.lit(1)), [doc], page, "__one", "__c", "sum", total="total_pages")
    t = normalize_text(text) if normalize else _col(text)
    return (
        x.withColumn(text, t)
        .where(F.length(text) >= min_len)
        .withColumn("total_pages", F.col("total_pages").cast("int"))
        .drop("__one", "__c")
    )


def concat_pages(pages: DataFrame, doc: str = "doc", page: str = "page", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """X3 (G1): the document text = every non-empty page text followed by a
    newline, in page order.  Pages with no text (failed or empty) add nothing; a
    document of such pages only has an empty text.  ``keep``: columns that are
    the same on all pages of a document."""
    full = F.when(F.col(text).isNotNull() & (F.col(text) != ""), F.struct(F.col(page).alias("page"), F.col(text).alias("text")))
    parts = F.transform(F.array_sort(F.collect_list(full)), lambda s: F.concat(s["text"], F.lit("\n")))
    return pages.groupBy(doc, *(keep or [])).agg(F.array_join(parts, "").alias(text))


def empty_document_filter(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents with text, documents that are only white space or empty)."""
    blank = F.coalesce(F.length(strip_ws(text)) == 0, F.lit(True))
    return docs.where(~blank), docs.where(blank)


def is_heading(style: Column | str) -> Column:
    """A style name starting with 'heading' or 'title' (any case)."""
    return F.lower(F.coalesce(_col(style), F.lit(""))).rlike("^(heading|title)")


def drop_blank_elements(elements: DataFrame, text: str = "text") -> DataFrame:
    """Strip every element and drop the empty ones."""
    return elements.withColumn(text, strip_ws(text)).where(F.length(text) > 0)


def non_blank_lines(text: Column | str) -> Column:
    """X7 in array form: the stripped, non-empty lines of a text (dense positions
    after ``posexplode``)."""
    return F.filter(F.transform(F.split(_col(text), "\n"), lambda l: strip_ws(l)), lambda l: F.length(l) > 0)


def dense_positions(elements: DataFrame, doc: str = "doc", pos: str = "pos") -> DataFrame:
    """Renumber ``pos`` 0.. per document (skew-safe running count)."""
    x = running_agg(elements.withColumn("__one", F.lit(1)), [doc], pos, "__one", "__dense", "sum")
    return x.withColumn(pos, F.col("__dense") - 1).drop("__one", "__dense")


def section_blocks(elements: DataFrame, doc: str = "doc", pos: str = "pos", heading: Column | str = "is_heading",
                   text: str = "text", min_len: int = MIN_CHUNK_LENGTH, normalize: bool = True) -> DataFrame:
    """Group non-blank elements (dense ``pos`` 0.. per doc) into sections.

    A heading closes the current section only when it already has lines; it
    then names the next section and is not part of any text.  Any other element
    (also a heading met by an empty section) is body text.  Sections shorter
    than ``min_len`` after normalisation are dropped without using a number.
    Output: ``doc, section, section_idx, text``."""
    h = _col(heading)
    x = elements.select(F.col(doc), F.col(pos).cast("bigint").alias("__pos"), h.alias("__h"), F.col(text).alias("__t"))
    x = running_agg(x, [doc], "__pos", F.when(~F.col("__h"), F.col("__pos")), "__last_non", "max")
    run = F.col("__pos") - F.coalesce(F.col("__last_non"), F.lit(-1))
    boundary = F.col("__h") & F.when(F.col("__last_non").isNull(), run % 2 == 0).otherwise(run % 2 == 1)
    x = x.withColumn("__b", boundary.cast("int"))
    x = running_agg(x, [doc], "__pos", "__b", "__sec", "sum")
    heads = x.where(F.col("__b") == 1).select(doc, "__sec", F.col("__t").alias("__heading"))
    body = x.where(F.col("__b") == 0).groupBy(doc, "__sec").agg(_ordered_join("__pos", "__t", "\n").alias("__body"))
    body_text = normalize_text(strip_ws("__body")) if normalize else strip_ws("__body")
    secs = (
        body.join(heads, [doc, "__sec"], "left")
        .withColumn("__body", body_text)
        .where(F.length("__body") >= min_len)
    )
    secs = running_agg(secs.withColumn("__one", F.lit(1)), [doc], "__sec", "__one", "section_idx", "sum")
    return secs.select(
        doc,
        F.coalesce(F.col("__heading"), F.format_string(SECTION_NAME.replace("{}", "%d"), F.col("section_idx"))).alias("section"),
        F.col("section_idx").cast("int").alias("section_idx"),
        F.col("__body").alias(text),
    )


def table_rows_text(cells: DataFrame, doc: str = "doc", tbl: str = "tbl", row: str = "row", col: str = "col",
                    text: str = "text") -> DataFrame:
    """One text per table: stripped non-empty cells joined by `` | ``,
    non-empty rows joined by newlines.  Output ``doc, tbl, text``."""
    c = cells.withColumn(text, strip_ws(text)).where(F.length(text) > 0)
    rows = c.groupBy(doc, tbl, row).agg(_ordered_join(col, text, CELL_SEP).alias(text))
    return rows.groupBy(doc, tbl).agg(_ordered_join(row, text, ROW_SEP).alias(text))


def append_tables(elements: DataFrame, tables: DataFrame, doc: str = "doc", pos: str = "pos",
                  heading: str = "is_heading", text: str = "text", tbl: str = "tbl") -> DataFrame:
    """Tables join the element stream after the last paragraph of their
    document, in table order, as body text (so they land in the last section)."""
    last = elements.groupBy(doc).agg(F.max(pos).alias("__last"))
    t = (
        tables.join(last, doc, "left")
        .select(doc, F.col(tbl), F.col(text), F.coalesce(F.col("__last"), F.lit(-1)).alias("__last"))
    )
    t = running_agg(t.withColumn("__one", F.lit(1)), [doc], tbl, "__one", "__k", "sum")
    t = t.select(doc, (F.col("__last") + F.col("__k")).cast(elements.schema[pos].dataType).alias(pos),
                 F.lit(False).alias(heading), text)
    return elements.select(doc, pos, heading, text).unionByName(t)
