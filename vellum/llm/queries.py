"""The registered queries of the training-data operators."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from itertools import cycle, islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm import conversations, decontaminate, embedding_dedup, fingerprints, licenses, line_dedup, mixing, periodic_runs, quality, simhash, suffix_dedup, token_output, toxicity
from vellum.llm.common import read_table
from vellum.session import scratch_path


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-word shingles, links of at most 2 of 64 bits."""
    g = simhash.simhash_groups(read_table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def word_tokenizer() -> str:
    """Path of the public word tokenizer (installed on every node)."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all texts written as range-coded blocks and read back."""
    path = scratch_path(spark, "tokens")
    token_output.write_tokens(read_table(spark, sf_dir, "documents"), path, word_tokenizer())
    return token_output.digest(spark, path)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later runs of 3 or more equal lines, or of fewer with 50 words, go."""
    r = line_dedup.drop_repeated_runs(read_table(spark, sf_dir, "documents"))
    return r.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that start in an earlier document go."""
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 10 words of the benchmark in every document."""
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many documents as the labelled share of good ones, drawn by importance."""
    return quality.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    a = mixing.allocate(d)
    return a.select("doc_id", "size", "source_size", "target", "taken")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases, and templates contained to 0.8 or more in a text block."""
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of 0.98 or more between vectors of one label."""
    return embedding_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"), least=0.98)


def plant(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A stretch of a tenth of the documents becomes periodic (none without an id)."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + list(islice(cycle(words[a : a + p]), n - a))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of 3 or more periods and 24 or more words."""
    d = periodic_runs.periodic_runs(read_table(spark, sf_dir, "documents"), least=24, times=3, change=plant)
    d = d.withColumn("best", periodic_runs.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return d.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults that a checksum of conv_id and turn deals out:
    rows dropped, emptied, cut, repeated or said by the user."""
    conv, turn, role, text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    d = rows.withColumn("deal", F.crc32(F.concat_ws(":", conv, turn).cast("binary")) % 20).where("deal > 0")
    text = F.when(F.col("deal") == 1, "").when(F.col("deal") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    d = d.select("conv_id", "turn", F.when(F.col("deal") == 4, "user").otherwise(role).alias("role"), text.alias("text"), "deal")
    return d.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.when(F.col("deal") == 3, 2).otherwise(1)))).drop("deal", "copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of damaged conversations."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.report(conversations.repair(damaged(rows)), rows.select("conv_id").distinct())


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text, its edited text and the next text."""
    d = fingerprints.edited_likeness(read_table(spark, sf_dir, "documents"))
    return d.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_token_ids, op3_line_dedup, op4_suffix_dedup, op5_decontaminate,
        op6_quality, op7_toxicity, op8_mix, op9_licenses, op10_embedding_dedup,
        op11_periodic_runs, op12_conversation_repair, op13_fingerprints,
    )
}
