"""Ingest plans: G2 (hash-skip, blocks, recursive chunks, deterministic ids,
state) and G1 (known-hash skip, page concatenation, token windows, random ids).

``plan_*`` functions only declare DataFrames; ``run_*`` functions execute them
against a ``VectorStore``.  The chunk table is checkpointed once (to the
shared ``spark.checkpoint.dir``) because points, outcome and state all read
it; nothing else is materialised.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions.identity import point_id
from vellum.functions.text import MIN_CHUNK_LENGTH
from vellum.operators import blocks as B
from vellum.operators import chunking, dedup, embed
from vellum.operators.extract import chunk_files, chunk_rows, decode_files
from vellum.operators.report import run_summary
from vellum.session import scratch_path
from vellum.sources.files import SUPPORTED_SUFFIXES, default_decoders, discover_files, list_files, read_files, unreadable_files, with_hash
from vellum.sources.store import VectorStore, delete_path


@dataclass
class IndexConfig:
    chunk_size: int = chunking.CHUNK_SIZE
    chunk_overlap: int = chunking.CHUNK_OVERLAP
    min_chunk_length: int = MIN_CHUNK_LENGTH
    skip_already_indexed: bool = True
    remove_stale: bool = False  # D8 clean-up (off: the reference keeps old chunks)
    indexed_at: str | None = None  # one timestamp for the run (ISO string)


@dataclass
class IndexPlan:
    files: DataFrame
    skipped: DataFrame
    per_file: DataFrame  # path, file_hash, chunks array, error (one row per processed file)
    chunks: DataFrame
    points: DataFrame
    errors: DataFrame
    outcome: DataFrame
    new_state: DataFrame


def plan_index(files: DataFrame, state: DataFrame, *, decoders=None, encoder=None, cfg: IndexConfig | None = None,
               splitter=None) -> IndexPlan:
    """G2 as DataFrames: files(path, file_type, content[, file_hash]) and the
    previous state -> chunks, points, errors, per-file outcome, next state.

    Shuffles: the change test against the state (anti/semi join, broadcast
    when the state is small) and the outcome/state joins on the unique path.
    Decoding, blocks, chunking and numbering are row-local per file."""
    cfg = cfg or IndexConfig()
    decoders = decoders if decoders is not None else default_decoders()
    encoder = encoder or embed.HashingEncoder()
    indexed_at = cfg.indexed_at or datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
    if "file_hash" not in files.columns:
        files = with_hash(files, "md5")
    todo, skipped = dedup.changed_files(files, state, cfg.skip_already_indexed)
    decoded = decode_files(todo, decoders, cfg.min_chunk_length)
    per_file = chunk_files(decoded, cfg.chunk_size, cfg.chunk_overlap, cfg.min_chunk_length, splitter)
    return _finish(files, skipped, per_file, state, encoder, indexed_at)


def _finish(files, skipped, per_file, state, encoder, indexed_at) -> IndexPlan:
    chunks = chunk_rows(per_file, indexed_at)
    points = encoder.embed(chunks, "text", "vector").withColumn("point_id", point_id("file_hash", "chunk_id"))
    errors = per_file.where(F.col("error").isNotNull()).select("path", "error")
    outcome = outcome_from(files, skipped, per_file)
    ok = per_file.where(F.col("error").isNull()).select("path", "file_hash")
    return IndexPlan(files, skipped, per_file, chunks, points, errors, outcome, dedup.update_state(state, ok))


def outcome_from(files: DataFrame, skipped: DataFrame, per_file: DataFrame) -> DataFrame:
    """R1 from per-file rows.  The files are exactly the skipped ones plus the
    processed ones (``changed_files`` splits them), so the outcome is a union,
    not a join, and chunk counts are array sizes, not an aggregation."""
    sk = skipped.select("path", "file_hash", F.lit("skipped").alias("status"), F.lit(0).cast("bigint").alias("chunks"),
                        F.lit(None).cast("string").alias("error"))
    done = per_file.select(
        "path", "file_hash",
        F.when(F.col("error").isNull(), F.lit("processed")).otherwise(F.lit("error")).alias("status"),
        F.when(F.col("error").isNull(), F.size("chunks")).otherwise(F.lit(0)).cast("bigint").alias("chunks"),
        "error",
    )
    return sk.unionByName(done)


def run_index(store: VectorStore, files: DataFrame, *, decoders=None, encoder=None, cfg: IndexConfig | None = None,
              splitter=None, failed_at: str | None = None, unreadable: DataFrame | None = None,
              listing: DataFrame | None = None, unopened: DataFrame | None = None) -> dict:
    """Execute G2 against ``store``: upsert points, quarantine failures, then
    save the state (after the points, so a crash in between only repeats work
    with the same ids).  Returns the run summary as a dict.

    The change test runs on ``(path, file_hash)`` alone: contents are hashed
    where they are read and don't take part in it.  Those of changed paths are
    then read by a semi join on the path, which leaves them in place where
    Spark can broadcast the changed paths.  The per-file
    chunk table is written once to the shared folder (points, errors and the
    outcome read it) and deleted at the end.  ``unreadable``: path and error of
    files that could not be listed with their contents.

    With a ``listing`` (path, length, modified) ``files`` are those that the listing
    shows as new or touched, and ``unopened`` (path, file_hash) the others, which
    count as skipped.  Then contents are read once, hashed and decoded in the same
    pass; a file that was touched but not changed is dropped after it."""
    t0 = time.time()
    cfg = cfg or IndexConfig()
    encoder = encoder or embed.HashingEncoder(store.dim)
    spark = files.sparkSession
    stages = {name: scratch_path(spark, name) for name in ("hashes", "files", "outcome")}
    state = store.load_state()
    if "file_hash" not in files.columns:
        files = with_hash(files, "md5")

    def kept(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(stages[name])
        return spark.read.schema(df.schema).parquet(stages[name])

    def chunked(todo: DataFrame) -> DataFrame:
        decoded = decode_files(todo, decoders if decoders is not None else default_decoders(), cfg.min_chunk_length)
        return kept("files", chunk_files(decoded, cfg.chunk_size, cfg.chunk_overlap, cfg.min_chunk_length, splitter))

    if listing is not None:
        read = chunked(files)
        hashes = read.select("path", "file_hash")
        per_file, skipped = dedup.changed_files(read, state, cfg.skip_already_indexed)
    else:
        hashes = kept("hashes", files.select("path", "file_hash"))
        changed, skipped = dedup.changed_files(hashes, state, cfg.skip_already_indexed)
        todo = files.join(changed.select("path").distinct(), "path", "left_semi") if cfg.skip_already_indexed else files
        per_file = chunked(todo)
    indexed_at = cfg.indexed_at or datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
    plan = _finish(hashes, skipped, per_file, state, encoder, indexed_at)
    store.upsert(plan.points.select(*store.scan().columns))
    errors, outcome = plan.errors, plan.outcome
    if unreadable is not None:
        errors = errors.unionByName(unreadable.select("path", "error"))
        outcome = outcome.unionByName(unreadable.select(
            "path", F.lit(None).cast("string").alias("file_hash"), F.lit("error").alias("status"), F.lit(0).cast("bigint").alias("chunks"), "error"))
    if unopened is not None:
        outcome = outcome.unionByName(unopened.select("path", "file_hash", F.lit("skipped").alias("status"), F.lit(0).cast("bigint").alias("chunks"),
                                                      F.lit(None).cast("string").alias("error")))
    store.quarantine(errors, failed_at)
    if cfg.remove_stale:
        store.remove_stale(plan.new_state)
    outcome = kept("outcome", outcome)
    ok = outcome.where(F.col("status") == "processed").select("path", "file_hash")
    seen = None
    if listing is not None:  # of files that failed nothing is noted, so that they are read again
        now = listing.join(outcome.where("status <> 'error'").select("path", "file_hash").distinct(), "path")
        old = store.load_seen()
        seen = old.join(listing.select("path"), "path", "left_anti").unionByName(now.select(*old.columns))
    store.save_state(dedup.update_state(state, ok), seen)
    summary = run_summary(outcome, time.time() - t0).first().asDict()
    for path in stages.values():
        delete_path(spark, path)
    return summary


def run_index_folder(store: VectorStore, folder: str, *, suffixes=SUPPORTED_SUFFIXES, max_bytes: int | None = None,
                     always_hash: bool = False, cfg: IndexConfig | None = None, **kw) -> dict:
    """G2 over a folder tree: files that can't be read are reported as errors.

    Files that have the length and time of change of the last run are skipped
    unopened; ``always_hash`` opens them all (a file rewritten within its length
    and time of change is noticed only so)."""
    spark, cfg = store.spark, cfg or IndexConfig()
    path = scratch_path(spark, "listing")
    list_files(spark, folder, suffixes, max_bytes).write.parquet(path)
    listing = spark.read.parquet(path)
    if always_hash or not cfg.skip_already_indexed or store.manifest().get("seen") is None:
        files, unopened = discover_files(spark, folder, suffixes, max_bytes), None
    else:
        unopened = dedup.unopened_files(listing, store.load_seen(), store.load_state())
        files = read_files(spark, folder, listing.join(unopened, "path", "left_anti"), suffixes, max_bytes)
    summary = run_index(store, files, cfg=cfg, unreadable=unreadable_files(spark, folder, suffixes, max_bytes), listing=listing, unopened=unopened, **kw)
    delete_path(spark, path)
    return summary


# ---------------------------------------------------------------- G1

def plan_token_ingest(pages: DataFrame, known: DataFrame, *, encoder=None, tokenizer=None,
                      size: int = chunking.TOKEN_WINDOW, overlap: int = chunking.TOKEN_OVERLAP,
                      doc: str = "path", page: str = "page", text: str = "text"):
    """G1 as DataFrames: pages(path, page, text, file_hash) of new files ->
    (points without ids, empty documents).  Known hashes are skipped first."""
    encoder = encoder or embed.HashingEncoder()
    pages = dedup.drop_known(pages, known)
    docs = B.concat_pages(pages.select(doc, "file_hash", page, text).withColumnRenamed(doc, "__doc"), "__doc", page, text, keep=["file_hash"])
    ok, empty = B.empty_document_filter(docs, text)
    from vellum.functions.text import file_name

    chunks = chunking.token_window_chunks(
        ok.withColumn("source", file_name("__doc")), text, keep=["__doc", "source", "file_hash"],
        size=size, overlap=overlap, tokenizer=tokenizer,
    )
    points = encoder.embed(chunks, "text", "vector").withColumnRenamed("__doc", "path")
    return points, empty.withColumnRenamed("__doc", "path")


def token_store_schema():
    """G1 point: uuid id, vector and the flat payload (text, source, chunk, tokens, file_hash)."""
    from pyspark.sql import types as T

    return T.StructType([
        T.StructField("point_id", T.StringType()), T.StructField("vector", T.ArrayType(T.FloatType())),
        T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("chunk", T.IntegerType()), T.StructField("tokens", T.IntegerType()),
        T.StructField("file_hash", T.StringType()),
    ])


def run_token_ingest(store: VectorStore, pages: DataFrame, *, encoder=None, tokenizer=None,
                     failed_at: str | None = None) -> dict:
    """Execute G1: skip contents whose hash the store already holds (the set is
    read once, before the run), append the new chunks under random ids and
    quarantine documents without text.  ``pages``: path, page, text, file_hash."""
    spark = store.spark
    stages = {name: scratch_path(spark, name) for name in ("known", "points", "empty")}

    def kept(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(stages[name])
        return spark.read.schema(df.schema).parquet(stages[name])

    known = kept("known", dedup.known_hashes(store.scan(["file_hash"])))
    points, empty = plan_token_ingest(pages, known, encoder=encoder or embed.HashingEncoder(store.dim), tokenizer=tokenizer)
    points, empty = kept("points", points), kept("empty", empty.select("path"))
    cols = [c for c in store.scan().columns if c != "point_id"]
    store.append(points.select(*cols))
    store.quarantine(empty.select("path", F.lit("document without extractable text").alias("error")), failed_at)
    out = {"chunks": points.count(), "empty": empty.count()}
    for path in stages.values():
        delete_path(spark, path)
    return out


def run_token_ingest_files(store: VectorStore, files: DataFrame, decoder, *, encoder=None, tokenizer=None,
                           failed_at: str | None = None, unreadable: DataFrame | None = None) -> dict:
    """G1 from file rows: hash, skip known contents (on path and hash alone),
    decode the others to pages, quarantine those that fail, ingest the rest.
    ``decoder``: a plug-in decoder, or a native one whose items are the pages."""
    spark = store.spark
    files = with_hash(files, "sha256")
    new = dedup.drop_known(files.select("path", "file_hash"), dedup.known_hashes(store.scan(["file_hash"])))
    todo = files.join(new.select("path"), "path", "left_semi")
    if hasattr(decoder, "items_and_error"):
        read = decoder.items_and_error(F.col("content"))
    else:
        read = F.struct(decoder.items(F.col("content")).alias("items"), F.lit(None).cast("string").alias("error"))
    stage = scratch_path(spark, "decoded")
    todo.select("path", "file_hash", read.alias("d")).select("path", "file_hash", "d.error", F.transform("d.items", lambda i: i["text"]).alias("pages")).write.parquet(stage)
    decoded = spark.read.parquet(stage)
    errors = decoded.where(F.col("error").isNotNull()).select("path", "error")
    if unreadable is not None:
        errors = errors.unionByName(unreadable.select("path", "error"))
    store.quarantine(errors, failed_at)
    pages = decoded.where(F.col("error").isNull()).select("path", "file_hash", F.posexplode_outer("pages").alias("pos", "text"))
    out = run_token_ingest(store, pages.select("path", "file_hash", (F.coalesce("pos", F.lit(0)) + 1).alias("page"), "text"),
                           encoder=encoder, tokenizer=tokenizer, failed_at=failed_at)
    out["errors"] = errors.count()
    delete_path(spark, stage)
    return out
