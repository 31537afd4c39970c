"""Chunking: token windows (G1), recursive character chunks (G2), numbering.

Token windows are native: the text is tokenised with one regex, windows are
cut with ``slice`` inside a ``transform`` and only the window texts are
exploded, so no row ever carries a second copy of a token array.  The
recursive splitter is sequential per block and runs in an Arrow batch UDF;
numbering chunks across the blocks of a file uses the skew-safe running count
of ``vellum.operators.windows``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import ArrayType, IntegerType, StringType

from vellum.functions.arrays import arrow_udf, keep_rows, posexplode_rows
from vellum.functions.text import JAVA_NON_WS, JAVA_WS, MIN_CHUNK_LENGTH, WS, strip_ws
from vellum.operators.windows import running_agg

# G1 windows are 500 tokens with 50 tokens of overlap.
TOKEN_WINDOW = 500
TOKEN_OVERLAP = 50
# G2 chunks are at most 512 characters with 52 of overlap.
CHUNK_SIZE = 512
CHUNK_OVERLAP = 52
# G2 separators, tried in this order.
SEPARATORS = ["\n\n", "\n", ". ", "? ", "! ", "; ", ", ", " ", ""]

NON_WS = "[^" + WS[1:]
# A token is a run of white space followed by a run of anything else, or
# trailing white space alone: lossless, and re-tokenising a window gives it back.
TOKEN_PATTERN = f"{WS}*{NON_WS}+|{WS}+"
# The same tokens for Java with possessive quantifiers: the two classes are
# complements, so nothing is ever given back and backtracking is pure cost.
_JAVA_TOKEN_PATTERN = f"{JAVA_WS}*+{JAVA_NON_WS}++|{JAVA_WS}++"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


class RegexTokenizer:
    """Default tokenizer: lossless regex tokens (an offline stand-in for BPE).

    ``stable``: re-encoding the decoded text of consecutive tokens gives the
    same tokens back (every token but trailing white space starts a new match
    at its own white space), so a window's token count is its length."""

    stable = True

    def encode(self, text: Column | str) -> Column:
        return F.regexp_extract_all(_col(text), F.lit(_JAVA_TOKEN_PATTERN), 0)

    def decode(self, tokens: Column) -> Column:
        return F.array_join(tokens, "")

    def count(self, text: Column | str) -> Column:
        return F.size(self.encode(text))


class BpeTokenizer:
    """Plug-in BPE tokenizer (tiktoken encoding) through Arrow batch UDFs.

    Needs the encoding's vocabulary file to be available offline.  Decoding
    and re-encoding a window can change the count, so T3 re-encodes."""

    stable = False

    def __init__(self, encoding: str = "cl100k_base"):
        import tiktoken  # noqa: F401  (fail early when missing)

        self.encoding = encoding
        name = encoding

        def enc(s: pd.Series) -> pd.Series:
            import tiktoken

            e = tiktoken.get_encoding(name)
            return s.map(lambda t: None if t is None else e.encode(t, disallowed_special=()))

        self._enc = arrow_udf(enc, ArrayType(IntegerType()))

    def codec(self):
        """(text -> ids, ids -> text), made once in every task."""
        import tiktoken

        e = tiktoken.get_encoding(self.encoding)
        return lambda t: e.encode(t, disallowed_special=()), lambda ids: e.decode(list(ids))

    def encode(self, text):
        return self._enc(_col(text))

    def count(self, text):
        return F.size(self.encode(text))


def coded_windows(text: Column | str, tokenizer, size: int, overlap: int) -> Column:
    """T4 + T3 for a tokenizer that runs in Python (it has ``codec()``): one batch
    UDF from text to ``array<struct<text, tokens>>``; each decoded window is
    encoded again for its count, as T3 asks."""
    item = T.StructType([T.StructField("text", T.StringType()), T.StructField("tokens", T.IntegerType())])
    step = size - overlap

    def cut(s: pd.Series) -> pd.Series:
        encode, decode = tokenizer.codec()

        def one(t):
            if t is None:
                return []
            ids = encode(t)
            texts = [decode(ids[i : i + size]) for i in range(0, len(ids), step)]
            return [{"text": x, "tokens": len(encode(x))} for x in texts]

        return s.map(one)

    return arrow_udf(cut, T.ArrayType(item))(_col(text))


def count_tokens(text: Column | str, tokenizer=None) -> Column:
    """Number of tokens of a text (re-encoded)."""
    return (tokenizer or RegexTokenizer()).count(text)


def token_window_chunks(
    df: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    size: int = TOKEN_WINDOW,
    overlap: int = TOKEN_OVERLAP,
    tokenizer=None,
) -> DataFrame:
    """T4 (+T3): windows of ``size`` tokens starting every ``size - overlap``
    tokens while the start is inside the text.  Output: ``keep`` columns,
    ``chunk`` (0-based), ``text`` (decoded window), ``tokens`` (its count)."""
    tok = tokenizer or RegexTokenizer()
    keep = [c for c in (keep or []) if c != text]
    if hasattr(tok, "codec"):
        x = df.select(*keep, posexplode_rows(coded_windows(text, tok, size, overlap), "chunk", "w")).where(keep_rows("chunk"))
        return x.select(*keep, F.col("chunk").cast("int").alias("chunk"), F.col("w.text").alias("text"), F.col("w.tokens").alias("tokens"))
    step = size - overlap
    toks = tok.encode(text)
    x = df.select(*keep, toks.alias("__toks"))
    n = F.size("__toks")
    windows = F.when(
        n > 0,
        F.transform(
            F.sequence(F.lit(0), n - 1, F.lit(step)),
            lambda s: F.struct(
                tok.decode(F.slice(F.col("__toks"), s + 1, F.lit(size))).alias("text"),
                F.least(n - s, F.lit(size)).cast("int").alias("tokens"),
            ),
        ),
    ).otherwise(F.array().cast("array<struct<text:string,tokens:int>>"))
    out = x.select(*keep, posexplode_rows(windows, "chunk", "w")).where(keep_rows("chunk"))
    out = out.select(*keep, F.col("chunk").cast("int").alias("chunk"), F.col("w.text").alias("text"), F.col("w.tokens").alias("tokens"))
    if not getattr(tok, "stable", False):
        out = out.withColumn("tokens", tok.count("text"))  # T3: re-encode the decoded window
    return out


# ---------------------------------------------------------------- recursive splitter

def _split_keep(text: str, sep: str) -> list[str]:
    """Split on a literal separator, the separator opening the following piece."""
    if sep == "":
        return list(text)
    parts = text.split(sep)
    out = [parts[0]] + [sep + p for p in parts[1:]]
    return [p for p in out if p != ""]


def _merge(pieces: list[str], size: int, overlap: int) -> list[str]:
    """Greedy merge of small pieces into chunks of at most ``size`` characters,
    carrying a tail of at most ``overlap`` characters into the next chunk."""
    chunks: list[str] = []
    window: list[str] = []
    total = 0
    for p in pieces:
        n = len(p)
        if window and total + n > size:
            joined = "".join(window).strip()
            if joined:
                chunks.append(joined)
            while window and (total > overlap or total + n > size):
                total -= len(window[0])
                window.pop(0)
        window.append(p)
        total += n
    joined = "".join(window).strip()
    if joined:
        chunks.append(joined)
    return chunks


def split_recursive(text: str, separators=SEPARATORS, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> list[str]:
    """T5 on one string (the documented behaviour of the recursive character
    splitter with literal separators kept at the start and stripped output)."""
    sep, rest = separators[-1], []
    for i, s in enumerate(separators):
        if s == "" or s in text:
            sep, rest = s, separators[i + 1:]
            break
    out: list[str] = []
    small: list[str] = []
    for piece in _split_keep(text, sep):
        if len(piece) < size:
            small.append(piece)
            continue
        if small:
            out.extend(_merge(small, size, overlap))
            small = []
        if rest:
            out.extend(split_recursive(piece, rest, size, overlap))
        else:
            out.append(piece)
    if small:
        out.extend(_merge(small, size, overlap))
    return out


_CUT = "struct<a:int,b:int,open:boolean>"


def _level(segment: Column, sep: str, size: int, overlap: int) -> Column:
    """One separator's step on a segment that holds it: pieces shorter than
    ``size`` are merged by a fold whose state is how far it has come, where the
    pieces of the current chunk begin and what it has cut; longer pieces stay
    open for the separators after this one."""
    lengths = F.transform(F.split(segment["text"], "\\Q" + sep + "\\E", -1), lambda p, i: F.length(p) + F.when(i > 0, len(sep)).otherwise(0))
    none, nothing = F.array().cast("array<int>"), F.array().cast(f"array<{_CUT}>")

    def cut(a, b, still_open: bool) -> Column:
        return F.array(F.struct(a.alias("a"), b.alias("b"), F.lit(still_open).alias("open")))

    def flushed(c) -> Column:
        return F.when(F.size(c["begins"]) > 0, F.concat(c["out"], cut(F.get(c["begins"], F.lit(0)), c["at"], False))).otherwise(c["out"])

    def state(at, begins, out) -> Column:
        return F.struct(at.alias("at"), begins.alias("begins"), out.alias("out"))

    def step(c, n) -> Column:
        full = (F.size(c["begins"]) > 0) & (c["at"] - F.get(c["begins"], F.lit(0)) + n > size)
        # the tail that goes on into the next chunk
        tail = F.filter(c["begins"], lambda o: c["at"] - o <= F.least(F.lit(overlap), size - n))
        short = state(c["at"] + n, F.concat(F.when(full, tail).otherwise(c["begins"]), F.array(c["at"])), F.when(full, flushed(c)).otherwise(c["out"]))
        long = state(c["at"] + n, none, F.concat(flushed(c), cut(c["at"], c["at"] + n, True)))
        return F.when(n == 0, c).when(n >= size, long).otherwise(short)

    def texts(c) -> Column:
        piece = lambda x: F.substring(segment["text"], x["a"] + 1, x["b"] - x["a"])
        return F.transform(flushed(c), lambda x: F.struct(F.when(x["open"], piece(x)).otherwise(strip_ws(piece(x))).alias("text"), x["open"].alias("open")))

    return F.aggregate(lengths, state(F.lit(0), none, nothing), step, texts)


def _split_series(size: int, overlap: int):
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [] if t is None else split_recursive(t, SEPARATORS, size, overlap))

    return run


def recursive_chunks(text: Column | str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """T5: ``array<string>`` of chunks of one block, empty for null (Arrow batch
    UDF: several times as fast as the expression below, whose folds Spark
    interprets piece by piece)."""
    udf = arrow_udf(_split_series(size, overlap), ArrayType(StringType()))
    return udf(_col(text))


def recursive_chunks_native(text: Column | str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """T5 without Python workers: ``split_recursive`` level by level.  At each
    separator the open segments that hold it are split and merged (``_level``), the
    others wait; what is open at the end is cut into windows of characters."""
    t = _col(text)
    segments = F.when(t.isNotNull(), F.array(F.struct(F.when(F.length(t) > size, t).otherwise(strip_ws(t)).alias("text"), (F.length(t) > size).alias("open"))))
    segments = F.coalesce(segments, F.array().cast("array<struct<text:string,open:boolean>>"))
    for sep in SEPARATORS[:-1]:
        segments = F.flatten(F.transform(segments, lambda s: F.when(s["open"] & F.contains(s["text"], F.lit(sep)), _level(s, sep, size, overlap)).otherwise(F.array(s))))

    def windows(s) -> Column:
        step = size - overlap
        last = F.ceil((F.length(s["text"]) - size) / step).cast("int") * step
        return F.transform(F.sequence(F.lit(0), last, F.lit(step)), lambda o: strip_ws(F.substring(s["text"], o + 1, F.lit(size))))

    chunks = F.flatten(F.transform(segments, lambda s: F.when(s["open"], windows(s)).otherwise(F.array(s["text"]))))
    return F.filter(chunks, lambda c: c != "")


def kept_pieces(pieces: Column, min_len: int = MIN_CHUNK_LENGTH) -> Column:
    """T6 first half: strip every piece and keep those of at least ``min_len``."""
    return F.filter(F.transform(pieces, lambda p: strip_ws(p)), lambda p: F.length(p) >= min_len)


def number_chunks(
    pieces: DataFrame,
    key: str = "path",
    block: str = "block_no",
    piece: str = "piece_no",
    *,
    chunk_id: str = "chunk_id",
    total: str = "total_chunks",
) -> DataFrame:
    """``chunk_id`` 0.. across the blocks of each ``key`` in
    (block, piece) order, and ``total`` = kept chunks of the key.  Skew-safe."""
    x = running_agg(pieces, [key], block, F.lit(1), "__n", "sum", order=[block, piece], total=total)
    return x.withColumn(chunk_id, (F.col("__n") - 1).cast("int")).withColumn(total, F.col(total).cast("int")).drop("__n")


def chunk_blocks(
    blocks: DataFrame,
    indexed_at: str,
    *,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    min_len: int = MIN_CHUNK_LENGTH,
    splitter=None,
) -> DataFrame:
    """T5+T6+T7 for G2: blocks (path, file_hash, block_no, text, page?,
    total_pages?, section?, section_idx?) -> chunk rows with the payload
    fields of the reference (filename, filepath, file_type, file_hash,
    chunk_id, char_count, indexed_at, page/section fields, total_chunks, text)."""
    from vellum.functions.text import file_name, file_type

    split = splitter or (lambda c: recursive_chunks(c, size, overlap))
    opt = [c for c in ("page", "total_pages", "section", "section_idx") if c in blocks.columns]
    x = blocks.select("path", "file_hash", "block_no", *opt, kept_pieces(split(F.col("text")), min_len).alias("__p"))
    x = x.select("path", "file_hash", "block_no", *opt, posexplode_rows(F.col("__p"), "piece_no", "text"))
    x = x.where(keep_rows("piece_no"))
    x = number_chunks(x)
    return x.select(
        file_name("path").alias("filename"),
        F.col("path").alias("filepath"),
        file_type("path").alias("file_type"),
        "file_hash",
        "chunk_id",
        F.length("text").alias("char_count"),
        F.lit(indexed_at).alias("indexed_at"),
        *opt,
        "total_chunks",
        "text",
    )


def require_chunks(files: DataFrame, chunks: DataFrame, key: str = "path", chunk_key: str = "filepath") -> DataFrame:
    """Files that produced no chunk (to be quarantined)."""
    has = chunks.select(F.col(chunk_key).alias(key)).distinct()
    return files.join(has, key, "left_anti")


def token_windows(text: Column | str, size: int = TOKEN_WINDOW, overlap: int = TOKEN_OVERLAP, tokenizer=None) -> Column:
    """T4 as a column: ``array<string>`` of decoded windows of one text (a
    splitter for ``chunk_blocks``).  The token array is bound once to a lambda
    variable, so the text is tokenised once, not once per window."""
    tok = tokenizer or RegexTokenizer()
    if hasattr(tok, "codec"):
        return F.transform(coded_windows(text, tok, size, overlap), lambda w: w["text"])

    def cut(toks):
        n = F.size(toks)
        return F.when(
            n > 0,
            F.transform(F.sequence(F.lit(0), n - 1, F.lit(size - overlap)), lambda s: tok.decode(F.slice(toks, s + 1, F.lit(size)))),
        ).otherwise(F.array().cast("array<string>"))

    return F.element_at(F.transform(F.array(tok.encode(text)), cut), 1)
