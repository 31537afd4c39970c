"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix has as many words as the documents, dealt in blocks of ``BLOCK``
words.  Sources get integer numbers of blocks by the highest quotients
target / (seat - 1/2); each source's blocks are dealt by the same rule to
groups of shards and then to shards, in proportion to their words.  A shard is
a seeded share of a source's documents of about ``SHARD`` words, laid end to
end in seeded order and cut into equal blocks; its quota gives full passes
over all blocks and a seeded run of the rest (the documents' order is random,
so the run is a random choice).  A document at an edge of that run is cut.

No window holds more than one shard, one group's shards or one source's
groups; sources of any size spread over their shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 8  # words
SHARD = 50_000  # words
GROUP = 1024  # shards
MOST = 3  # times a source is repeated at most
SEED = "mix"
ADDED = ("size", "source_size", "target", "taken", "passes", "a", "b", "c", "d")


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def draw(*parts) -> Column:
    """A seeded number of 48 bits."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(SEED), *parts)), 1, 12), 16, 10).cast("long")


def sainte_lague(rows: DataFrame, parent: list[str], key: str) -> DataFrame:
    """Adds ``won``: the seats each row wins of its parent's ``seats`` by the
    highest quotients ``ideal`` / (seat - 1/2), where the rows' ``ideal`` add up
    to ``seats``; ties go to the smaller key.

    A row surely wins its ideal share rounded at a divisor that leaves seats
    over, and surely no more than rounded at one that needs too many; only the
    few seats between are ranked.
    """
    all_rows = Window.partitionBy(*parent)
    slack = F.try_divide(F.count("*").over(all_rows) / 2 + 1, F.col("seats"))
    held = rows.withColumn("slack", F.when(F.col("seats") > 0, slack)).withColumn(
        "sure", F.floor(F.greatest(F.lit(0.0), 1 - F.col("slack")) * F.col("ideal") + 0.5)
    )
    held = held.withColumn("sure", F.coalesce("sure", F.lit(0))).withColumn(
        "open", F.col("seats") - F.sum("sure").over(all_rows)
    )
    most = F.floor((1 + F.col("slack")) * F.col("ideal") + 0.5)
    asked = held.select(*parent, key, "ideal", "open", F.explode(F.when(most > F.col("sure"), F.sequence(F.col("sure") + 1, most))).alias("seat"))
    best = Window.partitionBy(*parent).orderBy(F.desc(F.col("ideal") / (F.col("seat") - 0.5)), key)
    extra = asked.withColumn("at", F.row_number().over(best)).where("at <= open").groupBy(*parent, key).agg(F.count("*").alias("extra"))
    return held.join(extra, [*parent, key], "left").withColumn("won", F.col("sure") + F.coalesce("extra", F.lit(0))).drop("slack", "sure", "open", "extra")


def targets(sources: DataFrame) -> DataFrame:
    """``k``, ``words`` -> also ``target``: weights 1, 2, 3 repeating by key
    share all words; a target stops at MOST times its source's words."""
    everything, by_key = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy("k")
    s = sources.withColumn("w", (F.row_number().over(by_key) - 1) % 3 + 1).withColumn("cap", MOST * F.col("words"))
    before = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("w"), "k").rowsBetween(Window.unboundedPreceding, -1)
    left = lambda c, total: F.sum(total).over(everything) - F.coalesce(F.sum(c).over(before), F.lit(0))
    s = s.withColumn("full", F.col("cap") / F.col("w") <= left("cap", "words") / left("w", "w"))
    unfilled = lambda c, total: F.sum(total).over(everything) - F.sum(F.when(F.col("full"), F.col(c)).otherwise(0)).over(everything)
    # all sources are full only where there are no words at all
    level = F.when(~F.col("full"), F.col("w") * F.try_divide(unfilled("cap", "words"), unfilled("w", "w")))
    return s.withColumn("target", F.coalesce(level, F.col("cap").cast("double"))).select("k", "words", "target")


def allocate(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken``, and
    the parts taken: ``passes`` whole copies and the words ``a`` to ``b`` and
    ``c`` to ``d`` (numbered within the document) once more.

    Null texts have size 0 and nothing is taken of them; null sources are one
    source, the last; a row without doc_id draws by its text; repeated rows count
    each for itself; an empty table gives an empty result.  The added columns
    replace columns of these names, other columns stay.
    """
    k = F.coalesce(F.concat(F.lit("0"), F.col("source")), F.lit("1"))
    own = [c for c in docs.columns if c.lower() not in ADDED]
    sized = docs.select(*own, n_words().alias("size"), k.alias("__k"), draw(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null/"), F.md5(F.coalesce(F.col("text"), F.lit("")))))).alias("__draw"))
    sized = written(sized, "sized")
    sources = targets(sized.groupBy(F.col("__k").alias("k")).agg(F.sum("size").alias("words")))
    sources = sources.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("words") / SHARD)))
    total = F.sum("words").over(Window.partitionBy(F.lit(0)))
    sources = sources.withColumn("ideal", F.col("target") / BLOCK).withColumn("seats", F.round(total / BLOCK).cast("long"))
    sources = written(sainte_lague(sources.withColumn("root", F.lit(0)), ["root"], "k"), "sources")

    placed = sized.join(sources.select(F.col("k").alias("__k"), "shards", F.col("words").alias("source_size"), "target"), "__k").withColumn(
        "__shard", F.pmod(F.col("__draw"), F.col("shards"))
    )
    shards = placed.groupBy(F.col("__k").alias("k"), F.col("__shard").alias("shard")).agg(F.sum("size").alias("t"))
    shards = written(shards.withColumn("g", F.floor(F.col("shard") / GROUP)), "shards")
    groups = shards.groupBy("k", "g").agg(F.sum("t").alias("gt")).join(sources.select("k", "words", F.col("won").alias("seats")), "k")
    groups = sainte_lague(groups.withColumn("ideal", F.coalesce(F.col("seats") * F.try_divide("gt", "words"), F.lit(0.0))), ["k"], "g")
    parts = shards.join(groups.select("k", "g", "gt", F.col("won").alias("seats")), ["k", "g"])
    parts = sainte_lague(parts.withColumn("ideal", F.coalesce(F.col("seats") * F.try_divide("t", "gt"), F.lit(0.0))), ["k", "g"], "shard")
    n = F.greatest(F.lit(1), F.round(F.col("t") / BLOCK)).cast("long")
    # seats stand for BLOCK words, a shard's own blocks may be somewhat shorter or longer
    blocks = F.coalesce(F.least(F.round(F.col("won") * BLOCK * n / F.nullif("t", F.lit(0))).cast("long"), MOST * n), F.lit(0))
    parts = parts.select(F.col("k").alias("__k"), F.col("shard").alias("__shard"), F.col("t").alias("__t"), n.alias("__n"), blocks.alias("__won"),
                         F.pmod(draw(F.lit("run"), "k", F.col("shard").cast("string")), n).alias("__from"))

    line = Window.partitionBy("__k", "__shard").orderBy("__draw", F.col("doc_id").asc_nulls_last(), "size")
    laid = placed.join(parts, ["__k", "__shard"]).withColumn("__end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    start = F.col("__end") - F.col("size")
    edge = lambda block: F.expr(f"({block}) * __t div __n")
    lo, hi = edge("__from"), edge("__from + __won % __n")
    within = lambda x: F.greatest(F.lit(0), F.least(F.col("size"), x - start))
    out = laid.select(
        *own, "size", "source_size", "target", F.expr("__won div __n").alias("passes"),
        F.lit(0).cast("long").alias("a"), within(hi - F.col("__t")).alias("b"), within(lo).alias("c"), within(F.least(hi, "__t")).alias("d"),
    )
    return out.withColumn("taken", F.col("passes") * F.col("size") + F.col("b") - F.col("a") + F.col("d") - F.col("c"))


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents, in the columns of ``docs``: a row for each whole
    pass, and one with the words taken once more (whole, or cut at block
    edges).  Documents of which nothing is taken are left out."""
    d = allocate(docs.withColumns({f"__own_{c}": F.col(c) for c in docs.columns if c.lower() in ADDED}))
    whole = F.expr("passes + cast(taken - passes * size = size as long)")
    pieces = F.split(F.regexp_replace("text", r"^[\x20\x09-\x0D]+", ""), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    cut = F.transform(F.array(pieces), lambda w: F.concat(F.array_join(F.slice(w, (F.col("a") + 1).cast("int"), (F.col("b") - F.col("a")).cast("int")), ""),
                                                          F.array_join(F.slice(w, (F.col("c") + 1).cast("int"), (F.col("d") - F.col("c")).cast("int")), "")))[0]
    part = F.expr("taken > passes * size and taken - passes * size < size")
    texts = F.concat(F.array_repeat(F.col("text"), whole.cast("int")), F.when(part, F.array(cut)).otherwise(F.array().cast("array<string>")))
    own = [F.col(f"__own_{c}").alias(c) if f"__own_{c}" in d.columns else F.col(c) for c in docs.columns if c != "text"]
    mixed = d.where("taken > 0").withColumn("__texts", texts).select(*own, F.explode_outer("__texts").alias("text"))
    return mixed.select(*docs.columns)
