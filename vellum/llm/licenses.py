"""License scans: phrases, and an exact set-similarity join with templates.

A document has a template's label if one of its text blocks holds at least
``CONTAINMENT`` of the template's distinct words.  A text block of a template
of L words is 2 L words of the document, a new one beginning every L words, so
a template's words standing together are always whole in one block.

The join orders template words by how many documents of the whole corpus hold
them, rarest first.  *Prefix*: a match needs ``need`` of T words, so it has one
of the first T - need + 1 in that order.  *Length*: fewer than ``need`` words
can't match.  *Position*: with the first common word at place p of the template
and j of the document's own ordered template words, no more than
1 + min(T - p - 1, D - j - 1) can be common.  Only documents that pass all three
are read again, and their blocks counted exactly.  What comes to the driver is
one number for each word of the templates.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.common import written
from vellum.llm.decontaminate import let, words

CONTAINMENT = 0.8
#: The phrases of the base labels.
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
#: Opening words of public licenses and notices, by label.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
]


def _strings(values) -> Column:
    return F.array(*map(F.lit, values))


def _table(spark: SparkSession, rows: list[Column]) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def _places(w: Column, label: str, phrase: str) -> Column:
    """Starts of the phrase among the words (looked for where its longest word stands)."""
    p = phrase.split()
    same = lambda i: [F.get(w, i + j) == x for j, x in enumerate(p)]

    def at(i: Column) -> Column:
        first, *rest = same(i)
        for r in rest:
            first = first & r
        return first

    starts = F.filter(F.sequence(F.lit(0), F.size(w)), at)
    found = F.transform(starts, lambda i: F.struct(F.lit(label).alias("label"), i.alias("at")))
    return F.when(F.array_contains(w, max(p, key=len)), found).otherwise(F.array().cast("array<struct<label:string,at:int>>"))


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates=TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_base``,
    ``first_word``, ``last_word``, ``base_labels``, ``labels`` and ``score``
    (1 with a base label, else the largest containment that reached the
    threshold, else 0).

    Null and empty texts have no words, no labels and score 0; repeated rows
    give repeated results; an empty table gives none; other columns are not
    looked at; a null doc_id is a value like others.
    """
    s, met = _matches(docs, phrases, templates, containment)
    met = met.groupBy(F.col("doc_id").alias("id"), F.col("h").alias("g")).agg(F.collect_set("label").alias("more"), F.max("containment").alias("share"))

    out = s.join(met, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("g")), "left")
    starts = F.transform("places", lambda x: x["at"])
    base = F.array_distinct(F.transform("places", lambda x: x["label"]))
    return out.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"), F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def matching_blocks(docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """Every text block that holds ``containment`` or more of a template's words:
    ``doc_id``, ``label``, ``first_word`` (number of the block's first word) and
    ``containment``.  Blocks of a template of n words are 2 n words long and begin
    every n words, so every stretch of n words lies in one.  Rows as in ``scan``;
    rows with one doc_id and text give their blocks once for each."""
    return _matches(docs, PHRASES, templates, containment)[1].drop("h")


def _matches(docs: DataFrame, phrases: dict[str, str], templates, containment: float) -> tuple[DataFrame, DataFrame]:
    """What the words of each row say by themselves, and its matching blocks
    (``doc_id``, ``h`` of the text, ``label``, ``first_word``, ``containment``)."""
    spark = docs.sparkSession
    texts = [(i, label, text.split()) for i, (label, text) in enumerate(templates)]
    sets = {i: sorted(set(t)) for i, _, t in texts}
    need = {i: ceil(containment * len(s) - 1e-9) for i, s in sets.items()}
    vocabulary = sorted(set().union(*sets.values()))

    d = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("h"))
    of_doc = let(words(), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.concat(*[_places(w, *p) for p in phrases.items()]).alias("places"),
        F.array_intersect(w, _strings(vocabulary)).alias("held"),
    ))
    s = written(d.select("doc_id", "h", F.explode(F.array(of_doc)).alias("s")).select("doc_id", "h", "s.*"), "license-scan")

    count = {w: n for w, n in s.select(F.explode("held").alias("w")).groupBy("w").count().collect()}  # at most the templates' words
    place = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (count.get(w, 0), w)))}
    prefixes = []
    for i, members in sets.items():
        ordered = sorted(members, key=place.get)
        prefixes += [F.struct(F.lit(i).alias("t"), F.lit(w).alias("w"), F.lit(p).alias("p"), F.lit(len(ordered)).alias("size"), F.lit(need[i]).alias("need"))
                     for p, w in enumerate(ordered[: len(ordered) - need[i] + 1])]
    prefix = _table(spark, prefixes)
    rank = F.create_map(*[F.lit(x) for w in vocabulary for x in (w, place[w])])
    ordered = F.array_sort(F.transform("held", lambda w: F.struct(F.element_at(rank, w).alias("r"), w.alias("w"))))
    held = s.where(F.size("held") > 0).select("doc_id", "h", "n_words", F.size("held").alias("size_d"), F.posexplode(ordered).alias("j", "x")).select("*", "x.w")
    near = held.join(prefix, "w").where("n_words >= need").groupBy("doc_id", "h", "t", "size", "need", "size_d").agg(F.min(F.struct("p", "j")).alias("m"))
    near = near.where("1 + least(size - m.p - 1, size_d - m.j - 1) >= need").select(F.col("doc_id").alias("id"), F.col("h").alias("g"), "t").distinct()
    near = written(near, "license-candidates")

    again = d.join(near, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("g"))).select("doc_id", "h", "t", "text")

    def of_template(w: Column, i: int, length: int) -> Column:
        share = lambda at: F.size(F.array_intersect(F.slice(w, at + 1, 2 * length), _strings(sets[i]))) / len(sets[i])
        found = F.transform(F.sequence(F.lit(0), F.size(w), F.lit(length)), lambda at: F.struct(at.cast("long").alias("first_word"), share(at).alias("containment")))
        return F.filter(found, lambda b: b["containment"] >= need[i] / len(sets[i]))

    found, label = F.lit(None).cast("array<struct<first_word:long,containment:double>>"), F.lit(None).cast("string")
    for i, name, t in texts:
        found = F.when(F.col("t") == i, let(words(), lambda w: of_template(w, i, len(t)))).otherwise(found)  # noqa: B023
        label = F.when(F.col("t") == i, F.lit(name)).otherwise(label)
    met = again.select("doc_id", "h", label.alias("label"), F.explode_outer(found).alias("b")).where("b is not null")
    return s, met.select("doc_id", "h", "label", "b.first_word", "b.containment")
