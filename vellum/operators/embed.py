"""Text encoders.

The default encoder is signed feature hashing (Weinberger et al., 2009): each
lower-cased word is hashed with md5, the hash picks a bucket and a sign, the
bucket counts are L2-normalised.  It is a pure Spark expression evaluated row
by row (no shuffle, no Python) and deterministic, so a SQL engine can
reproduce it.  Its retrieval quality is lexical, not semantic.

A neural encoder plugs in through ``ModelEncoder``: an iterator Arrow UDF that
loads the model once per task and encodes batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from vellum.functions.arrays import arrow_udf
from vellum.functions.text import passage_text, query_text
from vellum.functions.vectors import bind, unit

# A word is a run of letters or digits.
WORD_SPLIT = r"[^\p{L}\p{N}]+"
CACHED_WORDS = 1 << 17  # whose buckets a task remembers
SLICE_WORDS = 1 << 17  # hashed and counted at once


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def hashed_vector(text: Column | str, dim: int) -> Column:
    """Unit-length signed bucket counts of the words of a text (``array<float>``
    of ``dim``).  Every intermediate array is bound once to a lambda variable."""
    codes = F.transform(words(text), lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint"))

    def counts(hs):
        # signed bucket of each word; count of bucket i = size - size without i
        # (array_remove is a native loop, so no lambda runs per word and bucket)
        pos = F.transform(F.filter(hs, lambda h: F.floor(h / dim) % 2 == 0), lambda h: (h % dim).cast("int"))
        neg = F.transform(F.filter(hs, lambda h: F.floor(h / dim) % 2 == 1), lambda h: (h % dim).cast("int"))
        return bind(
            F.struct(pos.alias("p"), neg.alias("n")),
            lambda pn: F.transform(
                F.sequence(F.lit(0), F.lit(dim - 1)),
                lambda i: (
                    (F.size(pn["p"]) - F.size(F.array_remove(pn["p"], i)))
                    - (F.size(pn["n"]) - F.size(F.array_remove(pn["n"], i)))
                ).cast("double"),
            ),
        )

    return unit(bind(codes, counts))


def words(text: Column | str) -> Column:
    """Lower-cased runs of letters or digits (native)."""
    return F.filter(F.split(F.lower(_col(text)), WORD_SPLIT), lambda w: w != "")


def _bucket_series(dim: int):
    import hashlib

    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict[str, int] = {}  # word -> signed bucket, kept across the task's batches
        for s in it:
            out = []
            for ws in s:
                if ws is None:
                    out.append(None)
                    continue
                idx = []
                for w in ws:
                    b = cache.get(w)
                    if b is None:
                        h = int(hashlib.md5(w.encode("utf-8")).hexdigest()[:8], 16)
                        b = (h % dim) + (dim if (h // dim) % 2 else 0)
                        if len(cache) < 1_000_000:
                            cache[w] = b
                    idx.append(b)
                c = np.bincount(np.asarray(idx, dtype=np.int64), minlength=2 * dim).astype(np.float64)
                v = c[:dim] - c[dim:]
                n = np.sqrt(np.dot(v, v))  # integer counts: exact whatever the order
                out.append((v / n if n > 0 else v).astype(np.float32))
            yield pd.Series(out)

    return run


def _slices(batches):
    """Batches in parts of at most SLICE_WORDS words (or one row), so that the
    arrays made for them are small whatever a batch holds."""
    import pyarrow.compute as pc

    for rb in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(rb.column(rb.schema.get_field_index("__words"))), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        a = 0
        while a < len(ends):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SLICE_WORDS, side="right")))
            yield rb.slice(a, b - a)
            a = b


def _arrow_buckets(dim: int, out: str):
    import hashlib

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        cache: dict[str, int] = {}
        for rb in _slices(batches):
            n = rb.num_rows
            wl = rb.column(rb.schema.get_field_index("__words"))
            lengths = pc.fill_null(pc.list_value_length(wl), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = pc.list_flatten(wl)
            counts = np.zeros(n * 2 * dim, dtype=np.float64)
            if len(flat):
                enc = pc.dictionary_encode(flat).combine_chunks() if isinstance(flat, pa.ChunkedArray) else pc.dictionary_encode(flat)
                uniq = enc.dictionary.to_pylist()
                ub = np.empty(len(uniq), dtype=np.int64)
                for i, w in enumerate(uniq):
                    b = cache.get(w)
                    if b is None:
                        h = int(hashlib.md5(w.encode("utf-8")).hexdigest()[:8], 16)
                        b = (h % dim) + (dim if (h // dim) % 2 else 0)
                        if len(cache) < CACHED_WORDS:
                            cache[w] = b
                    ub[i] = b
                rows = np.repeat(np.arange(n, dtype=np.int64), lengths)
                counts = np.bincount(rows * 2 * dim + ub[enc.indices.to_numpy(zero_copy_only=False)], minlength=n * 2 * dim)
                counts = counts.astype(np.float64)
            c = counts.reshape(n, 2 * dim)
            v = c[:, :dim] - c[:, dim:]
            norm = np.sqrt((v * v).sum(axis=1, keepdims=True))  # integer counts: exact
            v = np.where(norm > 0, v / np.where(norm > 0, norm, 1.0), 0.0).astype(np.float32)
            vec = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * dim, dim, dtype=np.int32)), pa.array(v.reshape(-1)))
            cols = [rb.column(i) for i in range(rb.num_columns) if rb.schema.field(i).name != "__words"]
            names = [f.name for f in rb.schema if f.name != "__words"]
            yield pa.RecordBatch.from_arrays(cols + [vec], names=names + [out])

    return run


class HashingEncoder:
    """Default encoder: signed feature hashing to ``dim`` buckets, unit length.

    Words come from a native split; ``native=True`` also hashes and counts
    with array functions (one expression, SQL-reproducible), the default
    hands the word arrays to an Arrow batch UDF that caches each word's bucket
    for the task and counts with ``bincount``.  Both give the same floats."""

    def __init__(self, dim: int = 64, model_name: str = "feature-hashing", native: bool = False):
        self.dim = dim
        self.model_name = model_name
        self.native = native

    def vector(self, text: Column) -> Column:
        if self.native:
            return hashed_vector(text, self.dim)
        udf = arrow_udf(_bucket_series(self.dim), ArrayType(FloatType()))
        return udf(words(text))

    def embed(self, df: DataFrame, text: str = "text", out: str = "vector", is_query: bool = False,
              query_prefix: bool = True) -> DataFrame:
        t = query_text(text, query_prefix) if is_query else passage_text(text, self.model_name)
        if self.native:
            return df.withColumn(out, self.vector(t))
        # Arrow batches end to end: words are split natively, then hashed once
        # per distinct word of the batch and counted with numpy (no Python
        # object per word).
        keep = [c for c in df.columns if c != out]
        x = df.select(*keep, words(t).alias("__words"))
        schema = x.drop("__words").schema.add(out, ArrayType(FloatType()))
        return x.mapInArrow(_arrow_buckets(self.dim, out), schema)


class ModelEncoder:
    """Plug-in encoder: ``load()`` returns an object with ``encode(list[str]) ->
    array (n, dim)``; it is called once per task, batches are Arrow batches."""

    def __init__(self, load: Callable[[], object], dim: int, model_name: str, batch_size: int = 32):
        self.load, self.dim, self.model_name, self.batch_size = load, dim, model_name, batch_size

    def _udf(self):
        load, bs = self.load, self.batch_size

        def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for s in it:
                texts = s.fillna("").tolist()
                vecs = []
                for i in range(0, len(texts), bs):
                    v = np.asarray(model.encode(texts[i:i + bs]), dtype=np.float64)
                    n = np.linalg.norm(v, axis=1, keepdims=True)
                    vecs.append(np.where(n > 0, v / np.where(n > 0, n, 1), 0.0).astype(np.float32))
                out = np.concatenate(vecs) if vecs else np.zeros((0, self.dim), np.float32)
                yield pd.Series(list(out))

        return arrow_udf(run, ArrayType(FloatType()))

    def embed(self, df: DataFrame, text: str = "text", out: str = "vector", is_query: bool = False,
              query_prefix: bool = True) -> DataFrame:
        t = query_text(text, query_prefix) if is_query else passage_text(text, self.model_name)
        return df.withColumn(out, self._udf()(t))


def embed_passages(chunks: DataFrame, encoder=None, text: str = "text", out: str = "vector") -> DataFrame:
    """Passage vectors (passage prefix only for ``bge`` model names)."""
    return (encoder or HashingEncoder()).embed(chunks, text, out, is_query=False)


def embed_queries(queries: DataFrame, encoder=None, text: str = "query", out: str = "vector",
                  with_prefix: bool = True) -> DataFrame:
    """Query vectors (query prefix as G2 does; ``with_prefix=False`` for G1)."""
    return (encoder or HashingEncoder()).embed(queries, text, out, is_query=True, query_prefix=with_prefix)
