"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables (any path that Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: cuts the
    lineage, survives lost executors and is computed once for several readers."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c):
    """A-Z to lower case, every other character unchanged.  ``lower`` does just
    that on ASCII texts; others go through ``translate``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def text_hash(c) -> Column:
    """64 bits that tell rows of one doc_id, or without one, apart by their text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.xxhash64(c.cast("string")), F.lit(0))
