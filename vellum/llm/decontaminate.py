"""Benchmark decontamination by winnowing, in DataFrame functions only.

Every window of ``WINDOW`` words keeps its smallest ``GRAM``-word hash.  A
span of ``WINDOW`` words that stands in both a document and an item has the
same smallest hash in both, so joining these fingerprints misses nothing.
Documents with a joined fingerprint are looked at again: each of their windows
with such a fingerprint is extended to its full length by a 128-bit hash of
its words, and windows that agree with an item's are hits.  Items shorter than
a window are one window of their own length, whose fingerprint is the hash of
all its words; documents keep every such hash for the lengths that occur (at
most ``WINDOW`` - 1 numbers, the only thing that comes to the driver).

Joins are left to Spark, which broadcasts the benchmark's side only where the
written table is below its limit and sorts, splitting skewed keys, elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import ascii_lower, text_hash, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, GRAM = 10, 4


def words(text: str = "text") -> Column:
    """Words of a text after A-Z are lower-cased; none for null."""
    found = F.regexp_extract_all(ascii_lower(F.col(text).cast("string")), F.lit(WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row: a lambda variable, not
    an expression that the optimizer copies to every place that names it."""
    return F.transform(F.array(value), body)[0]


def spans(w: Column, n: int, value: Callable[[list[Column]], Column]) -> Column:
    """``value`` of each run of ``n`` words; empty where there are fewer."""
    runs = F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0)))
    return F.when(F.size(w) >= n, F.transform(runs, lambda i: value([F.get(w, i + j) for j in range(n)]))).otherwise(
        F.array().cast("array<long>")
    )


def minima(w: Column, window: int = WINDOW, gram: int = GRAM) -> Column:
    """The fingerprint of every window, in order."""
    width = window - gram + 1
    least = lambda g: F.transform(F.sequence(F.lit(1), F.greatest(F.size(g) - width + 1, F.lit(1))), lambda i: F.array_min(F.slice(g, i, width)))
    return F.when(F.size(w) >= window, let(spans(w, gram, lambda x: F.xxhash64(*x)), least)).otherwise(F.array().cast("array<long>"))


def _windows(w: Column, n: int, window: int, gram: int) -> Column:
    """(n, at, fp, one, two) of every run of ``n`` words: its fingerprint and 128 bits of hash."""
    fps = minima(w, window, gram) if n == window else spans(w, n, lambda x: F.xxhash64(*x))

    def row(f: Column) -> Column:
        def of(fp: Column, i: Column) -> Column:
            run = [F.get(w, i + j) for j in range(n)]
            return F.struct(F.lit(n).alias("n"), i.alias("at"), fp.alias("fp"), F.xxhash64(*run).alias("one"), F.xxhash64(F.lit("second"), *run).alias("two"))

        return F.transform(f, of)

    return let(fps, row)


def _fingerprints(w: Column, lengths: list[int], window: int, gram: int) -> Column:
    each = [minima(w, window, gram) if n == window else spans(w, n, lambda x: F.xxhash64(*x)) for n in lengths]
    return F.array_distinct(F.concat(*each)) if each else F.array().cast("array<long>")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit``,
    ``n_items``, ``items_sha256``, ``contaminated``.

    Null or empty texts have no words; items without words are left out; rows
    with the same doc_id and text count as one; empty tables give no rows or
    no hits; other columns are not looked at; a null doc_id or item_id is kept
    as a value of its own (the id is left out of the hash).
    """
    return _contamination(docs, items, window, gram).drop("h")


def _contamination(docs: DataFrame, items: DataFrame, window: int, gram: int) -> DataFrame:
    """``contamination`` with ``h``, the hash of the row's text."""
    b = items.select(F.col("item_id"), words().alias("w")).where(F.size("w") > 0)
    b = b.withColumn("n", F.least(F.size("w"), F.lit(window)))
    b = written(b.where("n > 0"), "items")
    lengths = [r[0] for r in b.select("n").distinct().orderBy("n").collect()]  # at most `window` numbers
    empty = F.array().cast("array<struct<n:int,at:int,fp:bigint,one:bigint,two:bigint>>")
    of_item = empty
    for n in lengths:
        of_item = F.when(F.col("n") == n, _windows(F.col("w"), n, window, gram)).otherwise(of_item)
    known = written(b.select("item_id", F.explode(of_item).alias("x")).select("item_id", "x.n", "x.fp", "x.one", "x.two").distinct(), "item-windows")
    fps = written(known.select("fp").distinct(), "item-fingerprints")

    d = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), text_hash("text").alias("h"))
    scan = d.select(
        "doc_id", "h",
        F.explode(F.array(let(words(), lambda w: F.struct(F.size(w).alias("n_words"), _fingerprints(w, lengths, window, gram).alias("fps"))))).alias("s"),
    )
    scan = written(scan.select("doc_id", "h", "s.n_words", "s.fps"), "fingerprints")
    near = scan.select("doc_id", "h", F.explode_outer("fps").alias("fp")).join(fps, "fp", "left_semi").select("doc_id", "h").distinct()
    near = written(near, "candidates")
    again = d.join(near.select(F.col("doc_id").alias("id"), F.col("h").alias("g")), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("g")), "left_semi")
    runs = let(words(), lambda w: F.flatten(F.array(empty, *[_windows(w, n, window, gram) for n in lengths])))
    at = again.select("doc_id", "h", F.explode_outer(runs).alias("x")).select("doc_id", "h", "x.*")
    hits = at.join(known, ["n", "fp", "one", "two"]).select("doc_id", "h", "at", "n", "item_id")
    found = hits.groupBy("doc_id", "h").agg(
        F.sort_array(F.collect_set(F.struct("at", "n"))).alias("runs"), F.count_distinct("item_id").cast("long").alias("n_items"),
        F.array_join(F.array_sort(F.collect_set(F.col("item_id").cast("string"))), ",").alias("items"),
    )
    cover = F.aggregate(
        "runs", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda s, r: F.struct(
            (s["n"] + F.greatest(F.lit(0), r["at"] + r["n"] - F.greatest(s["end"], r["at"]))).cast("long").alias("n"),
            F.greatest(s["end"], (r["at"] + r["n"]).cast("long")).alias("end"),
        ),
        lambda s: s["n"],
    )
    found = found.select(F.col("doc_id").alias("id"), F.col("h").alias("g"), cover.alias("n_hit"), "n_items", F.sha2("items", 256).alias("items_sha256"))
    return scan.select("doc_id", "h", "n_words").join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("g")), "left").select(
        "doc_id", "h", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` without the rows in whose text any item's window stands."""
    hit = _contamination(docs, items, window, gram).where("contaminated").select(F.col("doc_id").alias("__hit"), F.col("h").alias("__h")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["__hit"]) & (text_hash(docs["text"]) == hit["__h"]), "left_anti")
