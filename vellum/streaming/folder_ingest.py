"""Continuous ingest of an append-only folder with Structured Streaming.

The ``binaryFile`` stream source lists new files; every micro-batch runs the
same G2 plan as the batch job (``run_index``) through ``foreachBatch``.  The
store upsert is keyed by deterministic ids and the state is written after the
points, so a micro-batch replayed after a failure converges to the same rows
(effectively exactly once).  ``trigger(availableNow=True)`` drains what is
there and stops, which is how a scheduled job uses it.

Limit: the file source reports a path once.  A file whose content changes
under the same path is not seen again; run the batch job (hash comparison
against the state) for folders that are edited in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vellum.functions.text import file_name, file_type
from vellum.plans import indexing
from vellum.sources.files import SUPPORTED_SUFFIXES
from vellum.sources.store import VectorStore

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_files(spark: SparkSession, folder: str, suffixes=SUPPORTED_SUFFIXES, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of new files below ``folder`` (S1 schema)."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    low = F.lower(F.col("path"))
    cond = F.lit(False)
    for s in suffixes:
        cond = cond | low.endswith(s.lower())
    return reader.load(folder).where(cond).select(
        "path", file_name("path").alias("filename"), file_type("path").alias("file_type"), "length", "content")


def start_folder_ingest(spark: SparkSession, folder: str, store: VectorStore, checkpoint: str, *,
                        suffixes=SUPPORTED_SUFFIXES, decoders=None, encoder=None, cfg: indexing.IndexConfig | None = None,
                        available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the stream; returns the query (``awaitTermination()`` for
    ``available_now``).  ``checkpoint`` must be on shared storage."""
    runs: list[dict] = []

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        runs.append(indexing.run_index(store, batch, decoders=decoders, encoder=encoder, cfg=cfg))

    w = stream_files(spark, folder, suffixes).writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    q = w.start()
    q.run_summaries = runs  # per micro-batch summaries (driver side, small)
    return q
