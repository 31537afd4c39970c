"""The corpus pipeline: each stage works on all that the one before kept.

``run`` applies the stages to ``documents``; every stage's result is written
as Parquet into the shared folder and read back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vellum.llm import decontaminate, mixing, simhash, token_output, toxicity
from vellum.llm.common import read_table, written
from vellum.llm.queries import word_tokenizer
from vellum.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that ordinal regression finds toxic go."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the smallest doc_id."""
    return simhash.keep_one(docs, shingle=3, distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark window stands go."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, repeats as rows of their own."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as range-coded token ids; returns what the files hold of each row."""
    path = scratch_path(spark, "corpus-tokens")
    token_output.write_tokens(docs, path, word_tokenizer())
    return token_output.digest(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

#: The model, the groups and the tokenizer are beyond SQL: tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
