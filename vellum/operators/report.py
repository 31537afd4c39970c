"""Run reporting (R1-R3): per-file outcome, run summary, chunks per file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunks_per_file(chunks: DataFrame, key: str = "filepath") -> DataFrame:
    """Number of chunks written per file (map-side combined count)."""
    return chunks.groupBy(key).agg(F.count(F.lit(1)).alias("chunks"))


def file_outcome(files: DataFrame, skipped: DataFrame, chunks: DataFrame, errors: DataFrame) -> DataFrame:
    """One row per file: ``path, file_hash, status`` (processed / skipped /
    error), ``chunks`` (0 unless processed) and the first ``error``."""
    counts = chunks_per_file(chunks).withColumnRenamed("filepath", "path")
    err = errors.groupBy("path").agg(F.min("error").alias("error"))
    sk = skipped.select("path", F.lit(True).alias("__skip"))
    x = files.select("path", "file_hash").join(sk, "path", "left").join(err, "path", "left").join(counts, "path", "left")
    status = (
        F.when(F.col("__skip"), F.lit("skipped"))
        .when(F.col("error").isNotNull(), F.lit("error"))
        .otherwise(F.lit("processed"))
    )
    return x.select(
        "path",
        "file_hash",
        status.alias("status"),
        F.when(status == "processed", F.coalesce(F.col("chunks"), F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("chunks"),
        F.when(status == "error", F.col("error")).alias("error"),
    )


def outcome_of_chunks(todo: DataFrame, skipped: DataFrame, chunks: DataFrame, no_chunks: str) -> DataFrame:
    """R1 of a run in which a file fails only by having no chunk (``no_chunks`` is
    its error): the same rows as ``file_outcome``, with ``chunks`` evaluated once.
    ``todo`` and ``skipped`` are the two parts of the files (``changed_files``)."""
    counts = chunks_per_file(chunks).withColumnRenamed("filepath", "path")
    failed = F.col("chunks").isNull()
    done = todo.select("path", "file_hash").join(counts, "path", "left").select(
        "path", "file_hash", F.when(failed, "error").otherwise("processed").alias("status"),
        F.coalesce("chunks", F.lit(0)).cast("bigint").alias("chunks"), F.when(failed, F.lit(no_chunks)).alias("error"),
    )
    rest = skipped.select("path", "file_hash", F.lit("skipped").alias("status"), F.lit(0).cast("bigint").alias("chunks"), F.lit(None).cast("string").alias("error"))
    return done.unionByName(rest)


def run_summary(outcome: DataFrame, elapsed: float | None = None) -> DataFrame:
    """R2: total, processed, skipped, errors, chunks (and elapsed seconds)."""
    cols = [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "processed").alias("processed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.coalesce(F.sum("chunks"), F.lit(0)).cast("bigint").alias("chunks"),
    ]
    if elapsed is not None:
        cols.append(F.lit(float(elapsed)).alias("elapsed"))
    return outcome.agg(*cols)
