"""File sources and decoders (S1, S2, X1 inputs).

``discover_files`` lists a folder tree as the ``binaryFile`` source does; the
suffix test is on the lower-cased path because ``pathGlobFilter`` is case
sensitive.  Below a mounted folder the tasks list and read the files, so that
the driver holds no file's name; elsewhere the source does, whose listing
stands in the driver.  Decoders turn file rows into pages or paragraph elements; each is
either a native expression (plain text, HTML) or a plug-in Arrow UDF for
binary formats (PDF, DOCX) whose per-file failures become error rows.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.functions.arrays import arrow_udf, keep_rows, posexplode_rows
from vellum.functions.identity import file_md5
from vellum.functions.text import file_name, file_type

# File types the G2 indexer lists; G1 lists PDF only.
SUPPORTED_SUFFIXES = (".pdf", ".docx")


def _suffix_filter(suffixes) -> Column:
    low = F.lower(F.col("path"))
    cond = F.lit(False)
    for s in suffixes:
        cond = cond | low.endswith(s.lower())
    return cond


def _read_limit(spark: SparkSession, max_bytes: int | None) -> int:
    """Largest file that is read: the caller's limit, at most the source's own
    (beyond which it would stop the whole job)."""
    own = int(spark.conf.get("spark.sql.sources.binaryFile.maxLength", str((1 << 31) - 1)))
    return own if max_bytes is None else min(own, max_bytes)


def _mounted(spark: SparkSession, folder: str) -> str | None:
    """``folder`` as a path of the operating system; None if it is in another file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toUri().getPath() if fs.getScheme() == "file" else None


def _entries(folder: str) -> Iterator[tuple[str, tuple[int, int] | None]]:
    """What Spark's file sources take in of one folder, one by one: the path, and of
    a file its length and time of change (ms).  Left out are empty files, hidden
    names (``_metadata`` folders are entered), links to nothing and what has gone."""
    try:
        found = os.scandir(folder)
    except FileNotFoundError:
        return
    with found:
        for e in found:
            hidden = e.name.startswith(".") or (e.name.startswith("_") and "=" not in e.name)
            if (hidden or e.name.endswith("._COPYING_")) and not e.name.startswith(("_metadata", "_common_metadata")):
                continue
            try:
                e.name.encode()
                at = None if e.is_dir() else e.stat()
            except (OSError, UnicodeEncodeError):
                continue
            if at is None:
                yield e.path, None
            elif at.st_size and not hidden:
                yield e.path, (at.st_size, at.st_mtime_ns // 1_000_000)


#: entries that the driver looks at, at most, to deal a tree's folders to the tasks
DEAL_ENTRIES = 10_000


def _dealt(root: str, want: int) -> list[tuple[str, bool]]:
    """``want`` folders or more, if ``root`` has them in its first DEAL_ENTRIES
    entries, that make up its tree: each with all below (True) or its own files alone."""
    whole, alone, looked = deque([root]), [], 0
    while whole and len(whole) < want:
        at, below = whole.popleft(), []
        for path, file in _entries(at):
            looked += 1
            if looked > DEAL_ENTRIES:
                return [(x, False) for x in alone] + [(x, True) for x in (*whole, at)]
            if file is None:
                below.append(path)
        alone.append(at)
        whole.extend(below)
    return [(x, False) for x in alone] + [(x, True) for x in whole]


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The files of the folders of ``_dealt``; a task holds one open folder a level."""
    rows: list[tuple] = []

    def taken() -> pa.RecordBatch:
        out = [list(c) for c in zip(*rows)]
        rows.clear()
        return pa.RecordBatch.from_pydict({"path": pa.array(out[0], pa.string()), "length": pa.array(out[1], pa.int64()), "modified_ms": pa.array(out[2], pa.int64())})

    for b in batches:
        for folder, whole in zip(*(c.to_pylist() for c in b.columns)):
            opened = [_entries(folder)]
            while opened:
                path, file = next(opened[-1], (None, None))
                if path is None:
                    opened.pop()
                elif file is not None:
                    rows.append((f"file:{path}", *file))
                    if len(rows) == 10_000:
                        yield taken()
                elif whole:
                    opened.append(_entries(path))
    if rows:
        yield taken()


def _listing(spark: SparkSession, folder: str, suffixes) -> DataFrame:
    """``path, length, modificationTime`` of the files below ``folder``, listed by the
    tasks; from the source's own reader (whose rows have the ``content`` too) if the
    folder isn't mounted, isn't there or may be a pattern."""
    at = None if set(folder) & set("*?[]{}\\") else _mounted(spark, folder)
    if at is None or not os.path.isdir(at):
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).where(_suffix_filter(suffixes))
    most = 4 * spark.sparkContext.defaultParallelism
    folders = _dealt(at, most)
    # from an RDD, so that Spark doesn't take the listing, or the contents, for as small as these rows
    df = spark.createDataFrame(spark.sparkContext.parallelize(folders, min(len(folders), most)), "folder string, whole boolean")
    df = df.mapInArrow(_listed, "path string, length bigint, modified_ms bigint")
    return df.select("path", "length", F.timestamp_millis("modified_ms").alias("modificationTime")).where(_suffix_filter(suffixes))


#: bytes of contents that a task hands to Spark at once (a longer file goes alone)
READ_BYTES = 8 << 20


def _content(path: str) -> bytes:
    """A listed file's bytes, held against the sums that Hadoop keeps beside files it wrote."""
    path = path.removeprefix("file:")
    with open(path, "rb") as f:
        content = f.read()
    try:
        with open(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc"), "rb") as f:
            sums = f.read()
    except FileNotFoundError:
        return content
    if sums[:4] == b"crc\0":
        n = int.from_bytes(sums[4:8], "big")
        if sums[8:] != b"".join(zlib.crc32(content[i:i + n]).to_bytes(4, "big") for i in range(0, len(content), n)):
            raise OSError(f"checksum error: {path}")
    return content


def _read_listed(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """The file rows of a ``_listing``, whose files are dealt to the tasks; contents
    that aren't asked for aren't read."""
    if "content" not in listing.columns:
        spare_missing, spare_corrupt = (spark.conf.get(f"spark.sql.files.ignore{k}Files") == "true" for k in ("Missing", "Corrupt"))

        def read(paths: Iterator[pd.Series]) -> Iterator[pd.Series]:
            got, size = [], 0
            for s in paths:
                for path in s:
                    try:
                        content = _content(path)
                    except OSError as e:
                        if not (spare_missing if isinstance(e, FileNotFoundError) else spare_corrupt):
                            raise
                        content = None
                    if got and size + len(content or b"") > READ_BYTES:
                        yield pd.Series(got, dtype=object)
                        got, size = [], 0
                    got.append(content)
                    size += len(content or b"")
            if got:
                yield pd.Series(got, dtype=object)

        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        listing = listing.repartition(n, "path").withColumn("content", arrow_udf(read, T.BinaryType())("path"))
        if spare_missing or spare_corrupt:
            listing = listing.where(F.col("content").isNotNull())
    return listing.select("path", file_name("path").alias("filename"), file_type("path").alias("file_type"), "length", "content")


def discover_files(spark: SparkSession, folder: str, suffixes=SUPPORTED_SUFFIXES, max_bytes: int | None = None,
                   sort: bool = False) -> DataFrame:
    """Every readable file below ``folder`` with one of ``suffixes`` (any
    case): ``path, filename, file_type, length, content``.  Files over
    ``max_bytes`` and files that the source never lists (a name of the path
    below the folder begins with ``_`` or ``.``) are in ``unreadable_files``.
    ``sort`` orders by path (a range shuffle; the pipeline itself does not need
    the order)."""
    df = _read_listed(spark, _listing(spark, folder, suffixes).where(F.col("length") <= _read_limit(spark, max_bytes)))
    return df.orderBy("path") if sort else df


def list_files(spark: SparkSession, folder: str, suffixes=SUPPORTED_SUFFIXES, max_bytes: int | None = None) -> DataFrame:
    """``path, length, modified`` of the files ``discover_files`` would read; none is opened."""
    df = _listing(spark, folder, suffixes).where(F.col("length") <= _read_limit(spark, max_bytes))
    return df.select("path", "length", F.col("modificationTime").alias("modified"))


#: paths that are handed to the reader one by one; beyond, the folder is read and joined with them
MAX_PATHS = 100_000


def read_files(spark: SparkSession, folder: str, paths: DataFrame, suffixes=SUPPORTED_SUFFIXES, max_bytes: int | None = None) -> DataFrame:
    """``discover_files`` for the files ``paths`` (column ``path``) alone.  Up to
    MAX_PATHS names come to the driver, where the reader's listing stands anyway,
    and no other file is opened.  More of them, or names that the reader would take
    for patterns, are found by listing the folder (by reading it, if it isn't mounted)."""
    some = [r[0] for r in paths.select("path").distinct().limit(MAX_PATHS + 1).collect()]
    if not some:
        return discover_files(spark, folder, suffixes, max_bytes).limit(0)
    if len(some) > MAX_PATHS or any(set(p) & set("*?[]{}\\") for p in some):
        listing = _listing(spark, folder, suffixes).where(F.col("length") <= _read_limit(spark, max_bytes))
        return _read_listed(spark, listing.join(paths.select("path").distinct(), "path", "left_semi"))
    df = spark.read.format("binaryFile").load(some)
    return df.select("path", file_name("path").alias("filename"), file_type("path").alias("file_type"), "length", "content")


def unreadable_files(spark: SparkSession, folder: str, suffixes=SUPPORTED_SUFFIXES, max_bytes: int | None = None) -> DataFrame:
    """S10 input: ``path, error`` for the files of ``suffixes`` below ``folder``
    that ``discover_files`` leaves out, so a run reports them like other bad
    files.  Hidden names come from a plain listing of the folder, of which only
    they are kept."""
    limit = _read_limit(spark, max_bytes)
    large = _listing(spark, folder, suffixes).where(F.col("length") > limit).select(
        "path", F.concat(F.lit("file too large: "), F.col("length").cast("string"), F.lit(f" bytes, limit {limit}")).alias("error")
    )
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return large
    top = fs.getFileStatus(root).getPath().toString().rstrip("/") + "/"
    hidden, files = [], fs.listFiles(root, True)
    while files.hasNext():
        path = files.next().getPath().toString()
        low = path.lower()
        if any(low.endswith(x.lower()) for x in suffixes) and any(n[:1] in ("_", ".") for n in path[len(top):].split("/")):
            hidden.append((path, "hidden name: not read by the file source"))
    return large.unionByName(spark.createDataFrame(hidden, "path string, error string"))


def discover_by_suffix(spark: SparkSession, folder: str, suffix: str = ".pdf") -> DataFrame:
    """S2 (G1): as S1 with a single suffix; order unspecified."""
    return discover_files(spark, folder, (suffix,))


#: folders that files are dealt to: their listing is spread over the tasks
WRITE_FOLDERS = 1024

#: keys of several rows that are told to all tasks; beyond, all rows are shuffled by key
MAX_REPEATED = 100_000


def write_text_files(df: DataFrame, root: str, key: str, text: str, flat: bool = False) -> None:
    """One text file for each value of ``key`` below ``root``, its rows' ``text`` as
    lines, as Spark's text writer with ``partitionBy(key)`` leaves them: in a folder
    ``key=value``, or with ``flat`` (on a mounted folder) as the file ``key=value.txt``,
    since a folder takes as much disk as a short text.  Only rows whose key others
    have are shuffled: ``df`` is read for its keys first, so it must give the same
    rows twice.

    On a mounted (local) folder the tasks write the files themselves, each by one
    rename, so a repeated task changes nothing: Hadoop's local file system starts a
    process for the permissions of every file, which takes longer than all else."""
    rows = df.select(F.pmod(F.xxhash64(key), F.lit(WRITE_FOLDERS)).alias("folder"), F.col(key).alias(key), F.col(text).cast("string").alias("value"))
    spark = df.sparkSession
    root_at = _mounted(spark, root)
    if root_at is None:
        return rows.repartition(key).write.partitionBy("folder", key).text(root)

    os.makedirs(root_at, exist_ok=True)  # without rows too, as the writer leaves it

    def together(some: DataFrame) -> DataFrame:
        return some.repartition(key).sortWithinPartitions(key, "value")

    repeated = [r[0] for r in rows.groupBy(key).count().where("count > 1").select(key).limit(MAX_REPEATED + 1).collect()]
    if len(repeated) > MAX_REPEATED:
        rows = together(rows)
    elif repeated:
        of = T.StructType([T.StructField("__repeated", rows.schema[key].dataType)])
        keys = F.broadcast(spark.createDataFrame([(k,) for k in repeated], of))
        same = rows[key].eqNullSafe(keys["__repeated"])
        rows = rows.join(keys, same, "left_anti").unionByName(together(rows.join(keys, same, "left_semi")))

    def write(batches):
        name, out, to, n = None, None, None, 0

        def finish():
            if out is not None:
                out.close()
                os.replace(out.name, to)

        try:
            for b in batches:
                for folder, value, line in zip(*(c.to_pylist() for c in b.columns)):
                    if name != (folder, value):
                        finish()
                        name, n = (folder, value), n + 1
                        own = f"{key}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
                        at = os.path.join(root_at, f"folder={folder}", *([] if flat else [own]))
                        os.makedirs(at, exist_ok=True)
                        to = os.path.join(at, f"{own}.txt" if flat else "part-00000.txt")
                        out = open(os.path.join(at, f".part-{uuid.uuid4().hex}"), "wb")  # noqa: SIM115 - closed by finish
                    out.write((line or "").encode() + b"\n")
            finish()
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_pydict({"files": pa.array([n], pa.int64())})

    rows.mapInArrow(write, "files bigint").agg(F.sum("files")).collect()  # one number


def files_from_table(df: DataFrame, path: Column, content: Column) -> DataFrame:
    """Files from a table (path and text or bytes columns), same schema as S1."""
    x = df.select(path.alias("path"), content.alias("content"))
    return x.select(
        "path", file_name("path").alias("filename"), file_type("path").alias("file_type"),
        F.length("content").cast("bigint").alias("length"), "content",
    )


def with_hash(files: DataFrame, how: str = "md5") -> DataFrame:
    """D1/D2 on the file rows: ``file_hash`` = md5 (G2) or sha256 (G1)."""
    h = file_md5("content") if how == "md5" else F.sha2(F.col("content"), 256)
    return files.withColumn("file_hash", h)


# ---------------------------------------------------------------- decoders

class Decoder:
    """``kind`` is ``"pages"`` (rows ``path, page, text``, page 1-based) or
    ``"elements"`` (rows ``path, pos, style, text`` in reading order).
    ``decode(files, keep)`` returns ``(rows, errors)``; rows carry ``keep``."""

    kind = "elements"

    def decode(self, files: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
        raise NotImplementedError


def _no_errors(files: DataFrame) -> DataFrame:
    return files.select("path", F.lit(None).cast("string").alias("error")).limit(0)


def _as_text(c: str = "content") -> Column:
    return F.col(c).cast("string")


class TextDecoder(Decoder):
    """Plain text: every line is a paragraph; a line shorter than
    ``heading_below`` characters counts as a heading (0 = never)."""

    kind = "elements"

    def __init__(self, heading_below: int = 0):
        self.heading_below = heading_below

    def _style(self, line: Column) -> Column:
        return F.when(F.length(F.trim(line)) < self.heading_below, F.lit("Heading 1")).otherwise(F.lit("Normal"))

    def items(self, content: Column) -> Column:
        return F.transform(F.split(content.cast("string"), "\n"), lambda l: F.struct(self._style(l).alias("style"), l.alias("text")))



# HTML entities decoded by the HTML decoder.
HTML_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                 ("&apos;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]
_BLOCK_TAGS = "p|div|li|br|tr|td|th|ul|ol|nav|article|footer|header|section|table|title|h[1-6]"


class HtmlDecoder(Decoder):
    """HTML body as paragraphs: ``h1``-``h6`` become headings, other block
    tags break paragraphs, scripts, styles and comments are dropped.  Native
    regular expressions only."""

    kind = "elements"

    @staticmethod
    def _lines(content: Column) -> Column:
        h = content.cast("string")
        body = F.coalesce(F.nullif(F.regexp_extract(h, r"(?is)<body[^>]*>(.*)</body>", 1), F.lit("")), h)
        body = F.regexp_replace(body, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", "")
        body = F.regexp_replace(body, r"(?i)<h([1-6])\b[^>]*>", "\n\u0001$1")
        body = F.regexp_replace(body, rf"(?i)</?({_BLOCK_TAGS})\b[^>]*>", "\n")
        body = F.regexp_replace(body, r"<[^>]*>", "")
        for a, b in HTML_ENTITIES:
            body = F.replace(body, F.lit(a), F.lit(b))
        return F.split(body, "\n")

    @staticmethod
    def _item(line: Column) -> Column:
        is_h = F.startswith(line, F.lit("\u0001"))
        style = F.when(is_h, F.concat(F.lit("Heading "), F.substring(line, 2, 1))).otherwise(F.lit("Normal"))
        text = F.when(is_h, F.substring(line, F.lit(3), F.length(line))).otherwise(line)
        return F.struct(style.alias("style"), text.alias("text"))

    def items(self, content: Column) -> Column:
        return F.transform(self._lines(content), self._item)

    def decode(self, files, keep):
        x = files.select(*keep, posexplode_rows(self._lines(F.col("content")), "pos", "__l")).where(keep_rows("pos"))
        it = self._item(F.col("__l"))
        return x.select(*keep, "pos", it["style"].alias("style"), it["text"].alias("text")), _no_errors(files)


class UdfDecoder(Decoder):
    """Plug-in decoder for binary formats: ``parse(bytes) -> list[str]`` pages
    (``kind="pages"``) or ``list[(style, text)]`` elements.  Runs in an Arrow
    batch UDF; an exception for one file becomes that file's error row."""

    def __init__(self, parse: Callable[[bytes], list], kind: str = "pages"):
        self.parse, self.kind = parse, kind

    def items_and_error(self, content: Column) -> Column:
        """``struct<items, error>`` for one file (Arrow batch UDF)."""
        parse, kind = self.parse, self.kind
        item = T.StructType([T.StructField("style", T.StringType()), T.StructField("text", T.StringType())])
        out_t = T.StructType([T.StructField("items", T.ArrayType(item)), T.StructField("error", T.StringType())])

        def run(s: pd.Series) -> pd.DataFrame:
            items, errors = [], []
            for b in s:
                if b is None:  # a file of another type
                    items.append(None)
                    errors.append(None)
                    continue
                try:
                    got = parse(bytes(b))
                    if kind == "pages":
                        items.append([{"style": None, "text": t} for t in got])
                    else:
                        items.append([{"style": st, "text": t} for st, t in got])
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - a bad file must not stop the job
                    items.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            return pd.DataFrame({"items": items, "error": errors})

        return arrow_udf(run, out_t)(content)

    def decode(self, files, keep):
        x = files.select(*keep, self.items_and_error(F.col("content")).alias("__d"))
        errors = x.where(F.col("__d.error").isNotNull()).select("path", F.col("__d.error").alias("error"))
        ok = x.where(F.col("__d.error").isNull()).select(*keep, F.posexplode("__d.items").alias("pos", "__i"))
        if self.kind == "pages":
            rows = ok.select(*keep, (F.col("pos") + 1).alias("page"), F.col("__i.text").alias("text"))
        else:
            rows = ok.select(*keep, "pos", F.col("__i.style").alias("style"), F.col("__i.text").alias("text"))
        return rows, errors


def optional_pdf_decoder() -> Decoder | None:
    """PDF pages through PyMuPDF when it is installed (not in this image)."""
    try:
        import fitz  # noqa: F401
    except ImportError:
        return None

    def parse(b: bytes) -> list[str]:
        import fitz

        with fitz.open(stream=b, filetype="pdf") as doc:
            return [p.get_text("text", sort=True) for p in doc]

    return UdfDecoder(parse, "pages")


def table_text(cells: list[list[str]]) -> str:
    """X8 on the cells of one table, as ``blocks.table_rows_text`` lays them out:
    blank cells and rows are left out."""
    from vellum.operators.blocks import CELL_SEP, ROW_SEP

    lines = (CELL_SEP.join(filter(None, map(str.strip, row))) for row in cells)
    return ROW_SEP.join(filter(None, lines))


def optional_docx_decoder() -> Decoder | None:
    """DOCX paragraphs (then tables) through python-docx when installed."""
    try:
        import docx  # noqa: F401
    except ImportError:
        return None

    def parse(b: bytes) -> list:
        import io

        import docx

        opened = docx.Document(io.BytesIO(b))
        body = [(p.style.name if p.style else "", p.text) for p in opened.paragraphs]
        return body + [("", text) for text in map(table_text, ([[c.text for c in r.cells] for r in t.rows] for t in opened.tables)) if text]

    return UdfDecoder(parse, "elements")


def default_decoders() -> dict[str, Decoder]:
    decs: dict[str, Decoder] = {"txt": TextDecoder(), "html": HtmlDecoder(), "htm": HtmlDecoder()}
    for name, d in (("pdf", optional_pdf_decoder()), ("docx", optional_docx_decoder())):
        if d is not None:
            decs[name] = d
    return decs
