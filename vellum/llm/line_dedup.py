"""Repeated runs of lines, found by winnowing over line hashes (DataFrame
functions only).

Of every ``RUN`` consecutive non-blank lines the smallest line hash is the
fingerprint, so two places with ``RUN`` equal lines have an equal fingerprint.
Only windows whose fingerprint stands at more than one selected line are kept;
their places are joined on a 128-bit hash of the window's lines, and each
window that stands somewhere earlier (smaller doc_id, then smaller line) is a
repeat.  Repeated windows that overlap are one repeated run: a match reaches as
far both ways as its windows do.  The first place is found by a minimum, so a
line that stands in a third of all documents never meets itself pairwise.

Windows are also formed by content: fewer than ``RUN`` lines that hold ``WORDS``
words or more are a window of their own, and with ``short`` a document of fewer
lines than ``RUN`` is one whatever it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import written
from vellum.llm.decontaminate import let

RUN = 3  # lines
WORDS = 50  # that make fewer lines a window


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\x0b\x0c"))


def drop_repeated_runs(docs: DataFrame, run: int = RUN, words: int | None = WORDS, short: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_lines``, ``n_removed``,
    ``n_runs`` (maximal removed runs) and ``text`` without the removed lines.

    Lines end at a line feed and are equal if they are so without white space
    at both ends; blank lines stay, are never matched and don't end a run.
    Windows are judged on the input: overlapping repeats all go.  A null text
    has no lines and stays null; an empty one stays empty; rows with the same
    doc_id and text are copies of one row and get its result; a null doc_id
    comes first; an empty table gives no rows; other columns are not looked at.

    A window is ``run`` lines, or fewer that hold ``words`` words between white
    space (None: only ``run`` lines); with ``short`` all lines of a document that
    has fewer than ``run`` are one, equal to the same lines of another such one.
    """
    d = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("h"))
    hashes = F.transform(F.filter(F.transform(_lines(F.col("text")), _trimmed), lambda x: x != ""), lambda x: F.struct(
        F.xxhash64(x).alias("one"), F.xxhash64(F.lit("second"), x).alias("two"),
        F.lit(0).alias("words") if words is None else F.size(F.split(x, r"[ \t\r\x0b\x0c]+")).alias("words"),
    ))

    def of_lines(l: Column, n: int) -> Column:
        def of(i: Column) -> Column:
            rows = [F.get(l, i + j) for j in range(n)]
            return F.struct(
                i.alias("at"), F.lit(n).alias("n"), F.array_min(F.array(*[r["one"] for r in rows])).alias("fp"),
                F.array_position(F.array(*[r["one"] for r in rows]), F.array_min(F.array(*[r["one"] for r in rows]))).alias("pick"),
                F.xxhash64(*[r["one"] for r in rows]).alias("one"), F.xxhash64(F.lit("second"), *[r["two"] for r in rows]).alias("two"),
            )

        at = F.sequence(F.lit(0), F.greatest(F.size(l) - n, F.lit(0)))
        if n < run:
            full = lambda i: sum((F.get(l, i + j)["words"] for j in range(1, n)), F.get(l, i)["words"]) >= words
            whole = F.size(l) == n if short else F.lit(False)
            at = F.filter(at, lambda i: whole if words is None else whole | full(i))
        return F.when(F.size(l) >= n, F.transform(at, of))

    sizes = range(1 if words is not None or short else run, run + 1)

    def windows(l: Column) -> Column:
        each = [of_lines(l, n) for n in sizes]
        return each[0] if len(each) == 1 else F.flatten(F.array_compact(F.array(*each)))

    # rows with one doc_id and text give the same windows at the same places
    w = d.select("doc_id", "h", F.explode_outer(let(hashes, windows)).alias("w")).where("w is not null").select("doc_id", "h", "w.*")
    place = F.xxhash64("doc_id", "h", F.col("at") + F.col("pick").cast("int"))
    w = written(w.withColumn("place", place).drop("pick"), "line-windows")
    selected = w.groupBy("fp").agg(F.min("place").alias("a"), F.max("place").alias("b"))
    shared = written(selected.where("a <> b").select("fp"), "line-fingerprints")
    near = written(w.join(shared, "fp", "left_semi").select("doc_id", "h", "at", "n", "one", "two"), "line-matches")
    first = near.groupBy("one", "two").agg(F.min(F.struct("doc_id", "h", "at")).alias("first"), F.count("*").alias("places"))
    first = written(first.where("places > 1").drop("places"), "line-firsts")
    again = near.join(first, ["one", "two"]).where("first < struct(doc_id, h, at)")
    gone = again.groupBy(F.col("doc_id").alias("id"), F.col("h").alias("g")).agg(F.sort_array(F.collect_set(F.struct("at", "n"))).alias("starts"))
    # a new run begins at a window that doesn't touch the one before it
    starts = F.aggregate(
        "starts", F.struct(F.lit(0).alias("runs"), F.lit(-1).alias("end")),
        lambda c, x: F.struct((c["runs"] + (x["at"] > c["end"]).cast("int")).alias("runs"), F.greatest(c["end"], x["at"] + x["n"]).alias("end")),
        lambda c: c["runs"],
    )
    out = d.join(gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("g")), "left")
    # the removed of the non-blank lines, numbered among all lines; then all others, in
    # time linear in the lines however many go
    among = F.flatten(F.transform("starts", lambda x: F.sequence(x["at"], x["at"] + x["n"] - 1)))
    numbers = lambda l: F.filter(F.transform(l, lambda x, i: F.when(_trimmed(x) != "", i)), lambda i: i.isNotNull())
    lost = let(numbers(_lines(F.col("text"))), lambda at: F.transform(F.array_distinct(among), lambda p: F.get(at, p)))
    out = out.withColumn("gone", F.when(F.col("starts").isNotNull(), lost))
    kept = let(_lines(F.col("text")), lambda l: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(l) - 1), F.col("gone")), lambda i: F.get(l, i)), "\n"))
    return out.select(
        "doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size(_lines(F.col("text")))).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), F.when(F.col("gone").isNull(), 0).otherwise(starts).cast("long").alias("n_runs"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
    )
