"""Table sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """Parquet scan.  Splits follow row groups, so a small file written as one
    row group is one task; such a scan is spread round-robin (deterministic:
    rows are sorted locally before the exchange) so per-row text work runs on
    every core.  Anything with several splits is left as it is (no shuffle)."""
    df = spark.read.parquet(path)
    try:
        splits = df.rdd.getNumPartitions()  # planning only, nothing is read
    except Exception:  # noqa: BLE001 - sessions without RDD access: leave the scan as is
        return df
    return df.repartition(min_partitions or spark.sparkContext.defaultParallelism) if splits <= 1 else df
