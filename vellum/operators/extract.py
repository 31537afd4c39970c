"""The distributed extraction job - files in, blocks and errors out.

Every file row is decoded, turned into blocks and (later) chunked inside the
row (``vellum.operators.per_file``): no window and no shuffle between reading
a file and numbering its chunks.  The decoder is chosen by ``file_type``; a
file never aborts the job - an unsupported type, a decoder failure or a file
without any block becomes the file's ``error``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.functions.text import MIN_CHUNK_LENGTH
from vellum.functions.arrays import keep_rows, posexplode_rows
from vellum.operators import per_file
from vellum.sources.files import UdfDecoder

BLOCK = T.StructType([
    T.StructField("page", T.IntegerType()),
    T.StructField("total_pages", T.IntegerType()),
    T.StructField("section", T.StringType()),
    T.StructField("section_idx", T.IntegerType()),
    T.StructField("text", T.StringType()),
])
NO_TEXT = "no extractable text (scanned without OCR?)"


def _as_blocks(arr, kind: str):
    if kind == "pages":
        return F.transform(arr, lambda b: F.struct(
            b["page"].alias("page"), b["total_pages"].alias("total_pages"), F.lit(None).cast("string").alias("section"),
            F.lit(None).cast("int").alias("section_idx"), b["text"].alias("text")))
    return F.transform(arr, lambda b: F.struct(
        F.lit(None).cast("int").alias("page"), F.lit(None).cast("int").alias("total_pages"), b["section"].alias("section"),
        b["section_idx"].alias("section_idx"), b["text"].alias("text")))


def decode_files(files: DataFrame, decoders: dict, min_len: int = MIN_CHUNK_LENGTH) -> DataFrame:
    """``files(path, file_type, file_hash, content)`` -> one row per file:
    ``path, file_hash, blocks array<struct<page, total_pages, section,
    section_idx, text>>, error``.  Row-local: no shuffle."""
    ftype = F.col("file_type")
    items = F.lit(None).cast(T.ArrayType(T.StructType([T.StructField("style", T.StringType()), T.StructField("text", T.StringType())])))
    derr = F.lit(None).cast("string")
    blocks = F.lit(None).cast(T.ArrayType(BLOCK))
    # Python decoders run once per file of their type, native ones are expressions
    x = files
    for name, dec in decoders.items():
        if isinstance(dec, UdfDecoder):
            # the UDF sees only files of its type (others pass null)
            x = x.withColumn(f"__d_{name}", dec.items_and_error(F.when(ftype == name, F.col("content"))))
    for name, dec in decoders.items():
        if isinstance(dec, UdfDecoder):
            it, er = F.col(f"__d_{name}.items"), F.col(f"__d_{name}.error")
        else:
            it, er = dec.items(F.col("content")), F.lit(None).cast("string")
        items = F.when(ftype == name, it).otherwise(items)
        derr = F.when(ftype == name, er).otherwise(derr)
    x = x.select("path", "file_hash", "file_type", items.alias("__items"), derr.alias("__derr"))
    # types of one kind go through the Python helpers together
    for kind in sorted({"pages" if dec.kind == "pages" else "elements" for dec in decoders.values()}):
        of_kind = ftype.isin([name for name, dec in decoders.items() if (dec.kind == "pages") == (kind == "pages")])
        mine = F.when(of_kind, F.col("__items"))  # Python helpers get null for other types
        if kind == "pages":
            b = _as_blocks(per_file.page_blocks_array(F.transform(mine, lambda i: i["text"]), min_len), "pages")
        else:
            b = _as_blocks(per_file.section_blocks_array(mine, min_len), "elements")
        blocks = F.when(of_kind, b).otherwise(blocks)
    x = x.withColumn("blocks", blocks)
    supported = ftype.isin(list(decoders))
    error = (
        F.when(~supported, F.concat(F.lit("unsupported format: ."), ftype))
        .when(F.col("__derr").isNotNull(), F.col("__derr"))
        .when(F.coalesce(F.size("blocks"), F.lit(0)) <= 0, F.lit(NO_TEXT))
    )
    return x.select("path", "file_hash", F.when(error.isNull(), F.col("blocks")).alias("blocks"), error.alias("error"))


def extract_blocks(files: DataFrame, decoders: dict, min_len: int = MIN_CHUNK_LENGTH, together: bool = False):
    """Rows form of ``decode_files``: (blocks ``path, file_hash, block_no,
    page, total_pages, section, section_idx, text``; errors ``path, error``).
    ``together``: both as one frame with ``error``, whose files are decoded once;
    of the two frames each decodes them."""
    d = decode_files(files, decoders, min_len)
    # a file with an error has no blocks: it keeps one row
    b = d.select("path", "file_hash", "error", posexplode_rows(F.col("blocks"), "i", "b")).where(keep_rows("i") | F.col("error").isNotNull())
    rows = b.select(
        "path", "file_hash", F.coalesce(F.col("b.page"), F.col("b.section_idx")).alias("block_no"),
        "b.page", "b.total_pages", "b.section", "b.section_idx", "b.text", "error",
    )
    if together:
        return rows
    return rows.where(F.col("error").isNull()).drop("error"), d.where(F.col("error").isNotNull()).select("path", "error")


NO_CHUNKS = "no valid chunks after extraction"


def chunk_files(decoded: DataFrame, size: int, overlap: int, min_len: int = MIN_CHUNK_LENGTH, splitter=None) -> DataFrame:
    """T5-T8 per file row: ``path, file_hash, chunks array<struct<page,
    total_pages, section, section_idx, text>>, error`` (a file whose blocks
    give no chunk gets the T8 error).  ``splitter`` (``array<string>`` ->
    ``array<array<string>>``) replaces the recursive splitter."""
    fields = ["page", "total_pages", "section", "section_idx"]
    ch = per_file.chunk_blocks_array(F.col("blocks"), size, overlap, min_len, fields=fields, splitter=splitter)
    x = decoded.select("path", "file_hash", "error", F.when(F.col("error").isNull(), ch).alias("chunks"))
    err = F.coalesce(F.col("error"), F.when(F.size("chunks") <= 0, F.lit(NO_CHUNKS)))
    return x.select("path", "file_hash", F.when(err.isNull(), F.col("chunks")).alias("chunks"), err.alias("error"))


def chunk_rows(chunked: DataFrame, indexed_at: str) -> DataFrame:
    """One row per chunk with the payload fields; ``chunk_id`` is the
    position in the file's chunk array, ``total_chunks`` its size."""
    from vellum.functions.text import file_name, file_type

    x = chunked.where(F.col("error").isNull()).select(
        "path", "file_hash", F.size("chunks").cast("int").alias("total_chunks"), posexplode_rows(F.col("chunks"), "chunk_id", "c")
    ).where(keep_rows("chunk_id"))
    return x.select(
        file_name("path").alias("filename"), F.col("path").alias("filepath"), file_type("path").alias("file_type"),
        "file_hash", F.col("chunk_id").cast("int").alias("chunk_id"), F.length("c.text").cast("int").alias("char_count"),
        F.lit(indexed_at).alias("indexed_at"), "c.page", "c.total_pages", "c.section", "c.section_idx",
        "total_chunks", F.col("c.text").alias("text"),
    )
