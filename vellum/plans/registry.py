"""Registered queries: each reads the given tables and returns a DataFrame.

Every callable takes ``(spark, sf_dir)``.  Column names and types match the
oracle SQL in ``vellum.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.functions import identity, vectors
from vellum.functions import text as tx
from vellum.functions.arrays import keep_rows, posexplode_rows
from vellum.operators import ann, blocks, chunking, dedup, embed, lsh, per_file, report, search
from vellum.operators.extract import extract_blocks
from vellum.plans import indexing
from vellum.session import scratch_path, shared_dir
from vellum.sources import files as src
from vellum.sources.store import VectorStore, quarantine_rows, upsert_merge
from vellum.sources.tables import read_parquet
from vellum.sources.vector_index import IndexedStore

# tables whose rows carry real work (texts, vectors): spread small scans over the cores
WORK_TABLES = {"documents", "pages", "conversations", "embeddings"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return read_parquet(spark, path) if name in WORK_TABLES else spark.read.parquet(path)


def points_from_embeddings(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("point_id"), F.col("embedding").alias("vector"), "label"
    )


def q_search_topk(spark, sf_dir) -> DataFrame:
    """Q1+Q2+E4: every embedding searches all embeddings, top 5, score >= 0.35."""
    pts = points_from_embeddings(spark, sf_dir)
    qs = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    hits = search.topk(pts, qs, 5, threshold=0.35, payload=["label"])
    return hits.select("query_id", "rank", F.round("score", 4).alias("score"), "point_id", "label")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "search_topk": q_search_topk,
}


# ---------------------------------------------------------------- text, hashing, token windows


# Noise injected into `documents` so every clean-up step has work
# (the table itself has no control characters, curly quotes, tab runs or
# decomposed accents).
NOISE = [
    ("é", "é"),
    (". ", ".”  \t\x07 "),
    (", ", " – ‘"),
    ("\n", "\n \n\n\n \n"),
]


def noisy_text(c="text"):
    x = F.col(c)
    for a, b in NOISE:
        x = F.replace(x, F.lit(a), F.lit(b))
    return F.concat(F.lit("　 "), x, F.lit("\r\n "))


def q_normalize_text(spark, sf_dir):
    """Clean-up of every document (with injected noise)."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", tx.normalize_text(noisy_text()).alias("text")).withColumn(
        "char_count", F.length("text").cast("int")
    )


def q_min_length(spark, sf_dir):
    """T2 (+X7): per document, stripped non-blank lines and those >= 60 chars."""
    d = table(spark, sf_dir, "documents")
    lines = blocks.non_blank_lines("text")
    return d.select(
        "doc_id",
        F.size(lines).cast("int").alias("lines"),
        F.size(F.filter(lines, lambda l: tx.long_enough(l))).cast("int").alias("long_lines"),
    )


def q_file_hashes(spark, sf_dir):
    """Content hashes of every document."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", identity.file_sha256("text").alias("sha256"), identity.file_md5("text").alias("md5"))


def q_token_chunks(spark, sf_dir):
    """T3, T4 (G1 payload): 500-token windows every 450 tokens of every document."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "text", identity.file_sha256("text").alias("file_hash")
    )
    w = chunking.token_window_chunks(d, "text", keep=["doc_id", "source", "file_hash"])
    return w.select("doc_id", "source", "chunk", "tokens", "file_hash", F.md5("text").alias("text_md5"))


def doc_paths(d):
    """A file path per document: documents/<lang>/<source>_<doc_id>.<LANG>."""
    return F.concat(F.lit("documents/"), F.col("lang"), F.lit("/"), F.col("source"), F.lit("_"),
                    F.col("doc_id").cast("string"), F.lit("."), F.upper(F.col("lang")))


def q_chunk_metadata(spark, sf_dir):
    """Conversation turns as pages of a file, token windows as
    pieces, numbered across pages; payload and deterministic point ids."""
    c = table(spark, sf_dir, "conversations")
    pages = blocks.page_blocks(
        c.select(F.col("conv_id").alias("doc"), (F.col("turn") + 1).alias("page"), "text"), normalize=False, min_len=0
    )
    b = pages.select(
        F.concat(F.lit("conversations/"), F.col("doc").cast("string"), F.lit(".Pdf")).alias("path"),
        F.md5(F.concat(F.col("doc").cast("string"), F.lit("/conv"))).alias("file_hash"),
        F.col("page").cast("int").alias("block_no"),
        F.col("page").cast("int").alias("page"),
        "total_pages",
        "text",
    )
    splitter = lambda col: chunking.token_windows(col, 60, 10)
    ch = chunking.chunk_blocks(b, "2024-01-01T00:00:00", splitter=splitter)
    return ch.select(
        identity.point_id("file_hash", "chunk_id").alias("point_id"),
        "filename", "filepath", "file_type", "file_hash", "chunk_id", "char_count",
        "page", "total_pages", "total_chunks", F.md5("text").alias("text_md5"),
    )


def q_page_blocks(spark, sf_dir):
    """Conversation turns as pages; normalised, >= 60 chars, numbers kept."""
    c = table(spark, sf_dir, "conversations")
    p = blocks.page_blocks(c.select(F.col("conv_id").alias("doc"), (F.col("turn") + 1).alias("page"), "text"))
    return p.select(F.col("doc").alias("conv_id"), F.col("page").cast("int").alias("page"), "total_pages", "text")


def with_blank_files(c):
    """All conversations, and beside each a file without text, as a scan is,
    under an id below zero: its pages are empty or null by turns."""
    blank = c.withColumns({"conv_id": -1 - F.col("conv_id"), "text": F.when(F.col("turn") % 2 == 0, "")})
    return c.unionByName(blank)


def q_concat_pages(spark, sf_dir):
    """X3 + X4: G1 document text from its pages, with the blank-document flag."""
    c = with_blank_files(table(spark, sf_dir, "conversations"))
    docs = blocks.concat_pages(c.select(F.col("conv_id").alias("doc"), F.col("turn").alias("page"), "text"))
    ok, blank = blocks.empty_document_filter(docs)
    return ok.withColumn("blank", F.lit(False)).unionByName(blank.withColumn("blank", F.lit(True))).select(
        F.col("doc").alias("conv_id"), "blank", F.length("text").cast("int").alias("char_count"), F.md5("text").alias("text_md5")
    )


def q_section_blocks(spark, sf_dir):
    """Document lines as paragraphs, a line under 40 chars is a heading."""
    d = table(spark, sf_dir, "documents")
    el = d.select("doc_id", posexplode_rows(blocks.non_blank_lines("text"), "pos", "text")).where(keep_rows("pos"))
    el = el.withColumn("is_heading", F.length("text") < 40)
    return blocks.section_blocks(el, doc="doc_id")


def nation_cells(spark, sf_dir, tbl):
    """Nations as table rows (name, key, region, a blank cell) of each region."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_regionkey").alias("doc"), tbl.cast("int").alias("tbl"), F.col("n_nationkey").alias("row"),
        F.posexplode(F.array(F.col("n_name"), F.col("n_nationkey").cast("string"), F.concat(F.lit(" "), F.col("r_name")), F.lit("  "))).alias("col", "text"),
    )


def q_table_rows_text(spark, sf_dir):
    """One table per region."""
    return blocks.table_rows_text(nation_cells(spark, sf_dir, F.lit(0))).select(F.col("doc").alias("region"), "tbl", "text")


def q_append_tables(spark, sf_dir):
    """A region's nations as paragraphs (short names are headings), then its
    tables, one of even and one of odd nations, behind them in table order."""
    n = table(spark, sf_dir, "nation")
    pos = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")) - 1
    elements = n.select(F.col("n_regionkey").alias("doc"), pos.alias("pos"), (F.length("n_name") < 6).alias("is_heading"), F.col("n_name").alias("text"))
    out = blocks.append_tables(elements, blocks.table_rows_text(nation_cells(spark, sf_dir, F.col("n_nationkey") % 2)))
    return out.select(F.col("doc").alias("region"), F.col("pos").cast("int").alias("pos"), "is_heading", "text")


QUERIES.update({
    "normalize_text": q_normalize_text,
    "min_length": q_min_length,
    "file_hashes": q_file_hashes,
    "token_chunks": q_token_chunks,
    "chunk_metadata": q_chunk_metadata,
    "page_blocks": q_page_blocks,
    "concat_pages": q_concat_pages,
    "section_blocks": q_section_blocks,
    "table_rows_text": q_table_rows_text,
    "append_tables": q_append_tables,
})


# ---------------------------------------------------------------- incremental ingest over documents
#
# The documents table plays a folder of text files.  Documents that have a
# `labels` row were indexed by an earlier run: the state holds their hash, of
# the same text when quality = 1 and of an earlier version (text + " (v0)")
# otherwise, and the store holds the points of those earlier versions.


RUN_AT = "2024-12-01T14:34:35"


def doc_files(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    path = F.concat(F.lit("documents/"), F.col("lang"), F.lit("/"), F.col("source"), F.lit("_"),
                    F.col("doc_id").cast("string"), F.lit(".txt"))
    return d.select("doc_id", path.alias("path"), "text", identity.file_md5("text").alias("file_hash"))


def previous_files(spark, sf_dir):
    f = doc_files(spark, sf_dir)
    lab = table(spark, sf_dir, "labels")
    text = F.when(F.col("quality") == 1, F.col("text")).otherwise(F.concat(F.col("text"), F.lit(" (v0)")))
    return f.join(lab, "doc_id").select("doc_id", "path", text.alias("text")).withColumn("file_hash", identity.file_md5("text"))


def doc_chunks(files):
    """Each file is one block; 500-token windows (50 overlap) are its pieces,
    numbered inside the file row (no shuffle)."""
    from vellum.operators.extract import chunk_rows

    blocks = F.array(F.struct(
        F.lit(None).cast("int").alias("page"), F.lit(None).cast("int").alias("total_pages"),
        F.lit(None).cast("string").alias("section"), F.lit(None).cast("int").alias("section_idx"), F.col("text").alias("text")))
    splitter = lambda arr: F.transform(arr, lambda t: chunking.token_windows(t, 500, 50))
    ch = per_file.chunk_blocks_array(blocks, fields=["page", "total_pages", "section", "section_idx"], splitter=splitter)
    pf = files.select("path", "file_hash", ch.alias("chunks"), F.lit(None).cast("string").alias("error"))
    return chunk_rows(pf, RUN_AT)


def doc_points(files):
    return doc_chunks(files).withColumn("point_id", identity.point_id("file_hash", "chunk_id"))


NO_CHUNKS = "no valid chunks after extraction"


def _run(spark, sf_dir):
    """One G2 run over the documents: (files, skipped, chunks, errors, state)."""
    files = doc_files(spark, sf_dir)
    state = previous_files(spark, sf_dir).select("path", "file_hash")
    todo, skipped = dedup.changed_files(files, state)
    chunks = doc_chunks(todo)
    errors = chunking.require_chunks(todo.select("path"), chunks).select(
        "path", F.lit(NO_CHUNKS).alias("error")
    )
    return files, skipped, todo, chunks, errors, state


def q_known_hashes(spark, sf_dir):
    """D3: content hashes held by the store of the earlier run."""
    return dedup.known_hashes(doc_points(previous_files(spark, sf_dir)))


def q_drop_known(spark, sf_dir):
    """Files whose content is not in the store yet."""
    known = dedup.known_hashes(doc_points(previous_files(spark, sf_dir)))
    return dedup.drop_known(doc_files(spark, sf_dir), known).select("doc_id", "path", "file_hash")


def q_changed_files(spark, sf_dir):
    """Files to process (new or changed) and files skipped (same hash)."""
    files = doc_files(spark, sf_dir)
    todo, skipped = dedup.changed_files(files, previous_files(spark, sf_dir))
    return todo.select("doc_id", "path", F.lit("process").alias("status")).unionByName(
        skipped.select("doc_id", "path", F.lit("skip").alias("status"))
    )


def q_last_wins(spark, sf_dir):
    """One row per point id of all documents; copies keep the last path."""
    pts = dedup.last_wins(doc_points(doc_files(spark, sf_dir)))
    return pts.select("point_id", "filepath", "chunk_id", "total_chunks")


def q_stale_points(spark, sf_dir):
    """Stored points of files whose content changed since."""
    store = doc_points(previous_files(spark, sf_dir))
    state = doc_files(spark, sf_dir).select("path", "file_hash")
    return dedup.stale_points(store, state).select("point_id", "filepath", "file_hash")


def q_upsert_points(spark, sf_dir):
    """The store after upserting the points of new and changed files."""
    old = dedup.last_wins(doc_points(previous_files(spark, sf_dir)))
    _, _, todo, chunks, _, _ = _run(spark, sf_dir)
    new = chunks.withColumn("point_id", identity.point_id("file_hash", "chunk_id"))
    cols = ["point_id", "filepath", "file_hash", "chunk_id"]
    return upsert_merge(old.select(*cols), new.select(*cols))


def q_update_state(spark, sf_dir):
    """The state after the run (failed files keep their old entry)."""
    files, skipped, todo, chunks, errors, state = _run(spark, sf_dir)
    ok = todo.join(errors, "path", "left_anti")
    return dedup.update_state(state, ok)


def q_quarantine(spark, sf_dir):
    """Failed files with their error and quarantine name."""
    *_, errors, _ = _run(spark, sf_dir)
    return quarantine_rows(errors, RUN_AT.replace("T", " ")).drop("failed_at")


def q_file_outcome(spark, sf_dir):
    """Per-file status and chunk count."""
    _, skipped, todo, chunks, _, _ = _run(spark, sf_dir)
    return report.outcome_of_chunks(todo, skipped, chunks, NO_CHUNKS).select("path", "status", "chunks", "error")


def q_run_summary(spark, sf_dir):
    """R2: totals of the run."""
    _, skipped, todo, chunks, _, _ = _run(spark, sf_dir)
    return report.run_summary(report.outcome_of_chunks(todo, skipped, chunks, NO_CHUNKS))


def q_chunks_per_file(spark, sf_dir):
    """Chunks written per file."""
    *_, chunks, _, _ = _run(spark, sf_dir)
    return report.chunks_per_file(chunks)


QUERIES.update({
    "known_hashes": q_known_hashes,
    "drop_known": q_drop_known,
    "changed_files": q_changed_files,
    "last_wins": q_last_wins,
    "stale_points": q_stale_points,
    "upsert_points": q_upsert_points,
    "update_state": q_update_state,
    "quarantine": q_quarantine,
    "file_outcome": q_file_outcome,
    "run_summary": q_run_summary,
    "chunks_per_file": q_chunks_per_file,
})


# ---------------------------------------------------------------- encoding and search over documents


DIM = 64


def corpus_points(spark, sf_dir):
    """E1 + D6 + D7: encoded chunk points of every document (copies: last
    path), materialised once with ``checkpoint()`` in the shared folder as a
    stored collection would be (the search reads it twice: vectors, payload)."""
    shared_dir(spark)
    pts = dedup.last_wins(doc_points(doc_files(spark, sf_dir)))
    return embed.embed_passages(pts, embed.HashingEncoder(DIM)).checkpoint()


def q_embed_passages(spark, sf_dir):
    """Hashed passage vectors of every chunk, as (chunk, dimension, weight)."""
    ch = embed.embed_passages(doc_chunks(doc_files(spark, sf_dir)), embed.HashingEncoder(DIM))
    x = ch.select("filepath", "chunk_id", F.posexplode("vector").alias("dim", "w"))
    return x.where(F.col("w") != 0).select(
        "filepath", "chunk_id", F.col("dim").cast("int").alias("dim"), F.round(F.col("w").cast("double"), 6).alias("weight")
    )


def benchmark_queries(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def q_embed_search(spark, sf_dir):
    """E2 + Q1 + Q2: every benchmark text searches the document chunks, top 5, >= 0.35."""
    pts = corpus_points(spark, sf_dir)
    qs = embed.embed_queries(benchmark_queries(spark, sf_dir), embed.HashingEncoder(DIM))
    hits = search.topk(pts, qs, 5, threshold=0.35, payload=["filepath", "chunk_id"])
    return hits.select("query_id", "rank", F.round("score", 4).alias("score"), "point_id", "filepath", "chunk_id")


def batch_queries(spark, sf_dir):
    """Q5 input: benchmark texts (short ones as G1 does: k=3, no threshold;
    longer: k=5, 0.35) and the whole text of every document, searched inside
    its own file (``filename=<name>``)."""
    b = table(spark, sf_dir, "benchmark")
    short = F.length("text") < 150
    bq = b.select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"),
        F.when(short, 3).otherwise(5).alias("top"), F.when(~short, F.lit(0.35)).alias("threshold"),
        F.lit(None).cast("string").alias("filter"),
    )
    dq = doc_files(spark, sf_dir).select(
        (-1 - F.col("doc_id")).alias("query_id"), F.col("text").alias("query"), F.lit(5).alias("top"),
        F.lit(0.35).alias("threshold"), F.concat(F.lit("filename="), tx.file_name("path")).alias("filter"),
    )
    return search.clean_queries(bq.unionByName(dq))


def batch_hits(spark, sf_dir, payload):
    pts = corpus_points(spark, sf_dir)
    qs = batch_queries(spark, sf_dir).withColumn("fname", search.parse_filter_arg("filter"))
    qs = embed.embed_queries(qs, embed.HashingEncoder(DIM))
    return search.topk(pts, qs, "top", threshold="threshold", query_filter="fname", point_filter="filename", payload=payload)


def q_batch_search(spark, sf_dir):
    """Q5, Q3, Q4: many queries with their own k, threshold and filename filter."""
    hits = batch_hits(spark, sf_dir, ["filename", "chunk_id"])
    return hits.select("query_id", "rank", F.round("score", 4).alias("score"), "point_id", "filename", "chunk_id")


def q_result_view_g1(spark, sf_dir):
    """Q6: G1 result cards (source, chunk, 600-character preview)."""
    hits = batch_hits(spark, sf_dir, ["filename", "chunk_id", "text"])
    return search.result_view_g1(hits.withColumnRenamed("filename", "source").withColumnRenamed("chunk_id", "chunk"))


def made_up_cards(spark, sf_dir):
    """Hits made up from the nations, so that every way of showing a payload
    occurs (pages with and without a total, long sections, missing fields)."""
    n = table(spark, sf_dir, "nation")
    key, name = F.col("n_nationkey").cast("bigint"), F.col("n_name")
    by = lambda m, r=0: key % m == r
    return n.select(
        (-1_000_000_000 - key).alias("query_id"), F.lit(1).alias("rank"), (key / 25).alias("score"), key.alias("point_id"),
        F.when(~by(5), name).alias("filename"), F.when(~by(11), key).alias("chunk_id"), F.when(~by(7), key + 1).alias("total_chunks"),
        F.when(~by(13), key * 10).alias("char_count"), F.when(~by(2), F.repeat(F.concat(name, F.lit("\n")), 40)).alias("text"),
        F.when(by(3), key + 1).alias("page"), F.when(by(6), key + 2).alias("total_pages"), F.when(by(3, 1), F.repeat(name, 9)).alias("section"),
    )


def q_result_view_g2(spark, sf_dir):
    """Q7: G2 result cards of the batch's hits, and of made-up ones."""
    hits = batch_hits(spark, sf_dir, ["filename", "chunk_id", "total_chunks", "char_count", "text"])
    cards = hits.unionByName(made_up_cards(spark, sf_dir), allowMissingColumns=True)
    return search.result_view_g2(cards)


def q_empty_queries(spark, sf_dir):
    """Q8: queries of the batch that found nothing."""
    hits = batch_hits(spark, sf_dir, None)
    return search.empty_queries(batch_queries(spark, sf_dir), hits).select("query_id", "query")


def q_parse_filter_arg(spark, sf_dir):
    """Q4: ``key=value`` arguments built from documents (English ones carry a
    second '=', others have no '=' at all)."""
    d = table(spark, sf_dir, "documents")
    arg = F.when(F.col("lang") == "en", F.concat(F.lit("filename="), F.col("source"), F.lit("=x"))).otherwise(F.col("source"))
    return d.select("doc_id", arg.alias("arg"), search.parse_filter_arg(arg).alias("value"))


def q_text_preview(spark, sf_dir):
    """Previews, file-name parts and encoder prefixes."""
    f = doc_files(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    # vary the path shape by language: plain, double suffix, no suffix, hidden file
    p = (
        F.when(F.col("lang") == "fr", F.concat(F.col("path"), F.lit(".PDF")))
        .when(F.col("lang") == "de", F.regexp_replace("path", r"\.txt$", ""))
        .when(F.col("lang") == "es", F.regexp_replace("path", r"/([^/]*)$", "/.$1"))
        .otherwise(F.col("path"))
    )
    return f.select(
        "doc_id",
        tx.preview("text", 600).alias("preview600"),
        tx.preview("text", 300, flatten=True).alias("preview300"),
        tx.file_name(p).alias("filename"), tx.file_stem(p).alias("stem"), tx.file_suffix(p).alias("suffix"),
        tx.file_type(p).alias("file_type"),
        F.length(tx.passage_text("text", "example/bge-large")).cast("int").alias("passage_len"),
        F.length(tx.passage_text("text", "example/text-encoder")).cast("int").alias("plain_len"),
        F.md5(tx.query_text("text")).alias("query_md5"),
    )


def q_l2_normalize(spark, sf_dir):
    """Embeddings scaled by (label + 1) and normalised back, per component."""
    e = table(spark, sf_dir, "embeddings")
    scaled = e.select("vec_id", F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 1)).alias("v"))
    n = vectors.l2_normalize(scaled, "v")
    return n.select("vec_id", F.posexplode("v").alias("dim", "x")).select(
        "vec_id", F.col("dim").cast("int").alias("dim"), F.round(F.col("x").cast("double"), 6).alias("x")
    )


def q_cosine_score(spark, sf_dir):
    """Cosine of every embedding with the mean vector of its label."""
    e = table(spark, sf_dir, "embeddings")
    dims = e.select("label", F.posexplode("embedding").alias("dim", "x"))
    mean = dims.groupBy("label", "dim").agg(F.avg("x").alias("m"))
    cent = mean.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "m"))), lambda s: s["m"]).alias("centroid")
    )
    j = e.join(cent, "label")  # 10 centroids: the planner broadcasts them
    return j.select(
        "vec_id", "label", F.round(vectors.cosine_score("embedding", "centroid"), 6).alias("cosine"),
        F.round(vectors.dot("embedding", "embedding"), 6).alias("self_dot"),
    )


QUERIES.update({
    "embed_passages": q_embed_passages,
    "embed_search": q_embed_search,
    "batch_search": q_batch_search,
    "result_view_g1": q_result_view_g1,
    "result_view_g2": q_result_view_g2,
    "empty_queries": q_empty_queries,
    "parse_filter_arg": q_parse_filter_arg,
    "text_preview": q_text_preview,
    "l2_normalize": q_l2_normalize,
    "cosine_score": q_cosine_score,
})


# ---------------------------------------------------------------- operators without a SQL oracle



def embedding_queries(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


def rounded(hits):
    return hits.select("query_id", "rank", F.round("score", 4).alias("score"), "point_id")


def q_ann_topk(spark, sf_dir):
    """Q9: top-5 of every embedding by an IVF index whose cells and probes are
    fitted to a recall of 0.9."""
    idx, probes = ann.fit_ivf(points_from_embeddings(spark, sf_dir), goal=0.9)
    return rounded(ann.ann_topk(idx, embedding_queries(spark, sf_dir), 5, nprobe=probes))


def q_ann_lsh(spark, sf_dir):
    """Q9: the same by random-hyperplane tables fitted to a recall of 0.9."""
    pts = points_from_embeddings(spark, sf_dir)
    plan = lsh.fit_lsh(pts, goal=0.9)
    return rounded(lsh.lsh_topk(lsh.keyed(pts, plan), plan, embedding_queries(spark, sf_dir), 5))


def q_ann_recall(spark, sf_dir):
    """Q9 against Q1: whether each index finds 0.9 of the exact hits."""
    exact = search.topk(points_from_embeddings(spark, sf_dir), embedding_queries(spark, sf_dir), 5)
    shared_dir(spark)
    exact = exact.checkpoint()  # searched once, read by three
    found = {"cells": q_ann_topk, "tables": q_ann_lsh, "given": q_ann_topk_given}
    told = [ann.recall_at_k(q(spark, sf_dir), exact).select(F.lit(n).alias("name"), "exact_hits", (F.col("recall") >= 0.9).alias("reached")) for n, q in found.items()]
    return told[0].unionByName(told[1]).unionByName(told[2])


def q_recursive_chunks(spark, sf_dir, split=chunking.recursive_chunks):
    """T5: recursive character chunks (512 / 52) of every document."""
    d = table(spark, sf_dir, "documents")
    x = d.select("doc_id", posexplode_rows(split("text"), "chunk", "text")).where(keep_rows("chunk"))
    return x.select("doc_id", F.col("chunk").cast("int").alias("chunk"), F.length("text").cast("int").alias("char_count"),
                    F.md5("text").alias("text_md5"))


def q_recursive_chunks_native(spark, sf_dir):
    """T5 as one expression, without Python workers."""
    return q_recursive_chunks(spark, sf_dir, chunking.recursive_chunks_native)


def mixed_files(spark, sf_dir):
    """Documents as .txt files, web pages as .html files and conversations as
    .json files (a type without a decoder)."""
    docs = doc_files(spark, sf_dir).select("path", F.col("text").alias("content"))
    pages = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("pages/"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"), F.col("html").alias("content"))
    turns = F.array_sort(F.collect_list(F.struct("turn", "text")))
    conv = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda t: t["text"]), "\n").alias("content"))
    conv = conv.select(F.concat(F.lit("conversations/"), F.col("conv_id").cast("string"), F.lit(".json")).alias("path"), "content")
    allf = docs.unionByName(pages).unionByName(conv)
    return src.with_hash(src.files_from_table(allf, F.col("path"), F.col("content")))


DECODERS = {"txt": src.TextDecoder(heading_below=40), "html": src.HtmlDecoder()}


def q_extract_blocks(spark, sf_dir):
    """Dispatch on file type, blocks and per-file errors (integer columns
    are 0 on error rows)."""
    rows = extract_blocks(mixed_files(spark, sf_dir), DECODERS, together=True)
    ok = F.col("error").isNull()
    return rows.select("path", F.when(ok, F.col("block_no")).otherwise(0).cast("int").alias("block_no"), "section",
                       F.when(ok, F.length("text")).otherwise(0).cast("int").alias("char_count"), F.md5("text").alias("text_md5"), "error")


def q_index_documents(spark, sf_dir):
    """G2 end to end (S1 stand-in, D2, D5, X1, T5, T6, T7, T8, E1, D6, R1):
    per-file outcome of one run over documents, pages and conversations,
    with the labelled documents already in the state."""
    files = mixed_files(spark, sf_dir)
    state = previous_files(spark, sf_dir).select("path", "file_hash")
    plan = indexing.plan_index(files, state, decoders=DECODERS, encoder=embed.HashingEncoder(DIM),
                               cfg=indexing.IndexConfig(indexed_at=RUN_AT))
    return plan.outcome.select("path", "status", "chunks", "error")


def q_token_ingest(spark, sf_dir):
    """G1 end to end (D1, D4, X3, X4, T3, T4, E1): conversations as paged
    files, some without text (quarantined); conversations whose first turn is
    by the assistant count as known."""
    c = with_blank_files(table(spark, sf_dir, "conversations"))
    path = F.concat(F.lit("conversations/"), F.col("conv_id").cast("string"), F.lit(".pdf"))
    doc_hash = c.groupBy("conv_id").agg(
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]), "\f"), 256).alias("file_hash"))
    doc_hash = doc_hash.withColumn("file_hash", F.sha2(F.concat_ws("/", F.col("conv_id").cast("string"), "file_hash"), 256))
    pages = c.join(doc_hash, "conv_id").select(path.alias("path"), (F.col("turn") + 1).alias("page"), "text", "file_hash")
    first = c.where("turn = 0 and role = 'assistant'").join(doc_hash, "conv_id").select("file_hash")
    points, empty = indexing.plan_token_ingest(pages, first, encoder=embed.HashingEncoder(DIM))
    points = points.select("path", "source", "chunk", "tokens", "file_hash", F.md5("text").alias("text_md5"), F.lit("indexed").alias("status"))
    return points.unionByName(empty.select(
        "path", F.lit("").alias("source"), F.lit(-1).alias("chunk"), F.lit(0).alias("tokens"), "file_hash", F.lit("").alias("text_md5"), F.lit("empty").alias("status")))


def q_discover_files(spark, sf_dir):
    """Documents written by the tasks as one text file per document, then
    listed back recursively by suffix (any case) and hashed (D2)."""
    root = scratch_path(spark, "corpus")
    src.write_text_files(table(spark, sf_dir, "documents"), root, "doc_id", "text", flat=True)
    f = src.with_hash(src.discover_files(spark, root, (".TXT",)))
    doc = F.regexp_extract("path", r"doc_id=(\d+)", 1).cast("bigint")
    return f.select(doc.alias("doc_id"), "file_type", "length", "file_hash")


QUERIES.update({
    "ann_topk": q_ann_topk,
    "ann_lsh": q_ann_lsh,
    "ann_recall": q_ann_recall,
    "recursive_chunks": q_recursive_chunks,
    "recursive_chunks_native": q_recursive_chunks_native,
    "extract_blocks": q_extract_blocks,
    "index_documents": q_index_documents,
    "token_ingest": q_token_ingest,
    "discover_files": q_discover_files,
})


# ---------------------------------------------------------------- per-file (row-local) forms, same oracles



def q_page_blocks_per_file(spark, sf_dir):
    """X2 row-local: a conversation is one file row holding its turns as pages."""
    c = table(spark, sf_dir, "conversations")
    docs = c.groupBy("conv_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]).alias("pages"))
    b = docs.select("conv_id", posexplode_rows(per_file.page_blocks_array(F.col("pages")), "i", "b")).where(keep_rows("i"))
    return b.select("conv_id", F.col("b.page").alias("page"), F.col("b.total_pages").alias("total_pages"), F.col("b.text").alias("text"))


def q_section_blocks_per_file(spark, sf_dir):
    """X5-X7 row-local: each document row's lines are its paragraphs (a line
    under 40 characters after stripping is a heading)."""
    d = table(spark, sf_dir, "documents")
    els = F.transform(F.split("text", "\n"), lambda l: F.struct(
        F.when(F.length(tx.strip_ws(l)) < 40, F.lit("Heading 1")).otherwise(F.lit("Normal")).alias("style"), l.alias("text")))
    b = d.select("doc_id", posexplode_rows(per_file.section_blocks_array(els), "i", "b")).where(keep_rows("i"))
    return b.select("doc_id", F.col("b.section").alias("section"), F.col("b.section_idx").alias("section_idx"), F.col("b.text").alias("text"))


def q_chunk_metadata_per_file(spark, sf_dir):
    """T6, T7, D6 row-local: conversation pages cut into 60/10 token windows,
    numbered inside the file row (same result as ``chunk_metadata``)."""
    from vellum.operators.extract import chunk_rows

    c = table(spark, sf_dir, "conversations")
    docs = c.groupBy("conv_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]).alias("pages"))
    blocks = F.transform(F.col("pages"), lambda t, i: F.struct(
        (i + 1).cast("int").alias("page"), F.size("pages").cast("int").alias("total_pages"),
        F.lit(None).cast("string").alias("section"), F.lit(None).cast("int").alias("section_idx"), t.alias("text")))
    splitter = lambda arr: F.transform(arr, lambda t: chunking.token_windows(t, 60, 10))
    ch = per_file.chunk_blocks_array(blocks, fields=["page", "total_pages", "section", "section_idx"], splitter=splitter)
    pf = docs.select(
        F.concat(F.lit("conversations/"), F.col("conv_id").cast("string"), F.lit(".Pdf")).alias("path"),
        F.md5(F.concat(F.col("conv_id").cast("string"), F.lit("/conv"))).alias("file_hash"),
        ch.alias("chunks"), F.lit(None).cast("string").alias("error"))
    rows = chunk_rows(pf, RUN_AT)
    return rows.select(
        identity.point_id("file_hash", "chunk_id").alias("point_id"),
        "filename", "filepath", "file_type", "file_hash", "chunk_id", "char_count",
        "page", "total_pages", "total_chunks", F.md5("text").alias("text_md5"),
    )


QUERIES.update({
    "page_blocks_per_file": q_page_blocks_per_file,
    "section_blocks_per_file": q_section_blocks_per_file,
    "chunk_metadata_per_file": q_chunk_metadata_per_file,
})


def g1_points(spark, sf_dir):
    """G1 collection: 500/50 token windows of every document with the G1
    payload; each chunk gets its own id (copies are all kept, as G1 does)."""
    f = doc_files(spark, sf_dir).select("path", "text", identity.file_sha256("text").alias("file_hash"))
    w = chunking.token_window_chunks(f.withColumn("source", tx.file_name("path")), "text", keep=["path", "source", "file_hash"])
    w = w.withColumn("point_id", identity.point_id(F.md5("path"), "chunk"))
    shared_dir(spark)
    return embed.embed_passages(w, embed.HashingEncoder(DIM, "example/text-encoder")).checkpoint()


def q_g1_search(spark, sf_dir):
    """G1 search (E2 without prefix, Q1 with k = 3 and no threshold, Q6 view)."""
    pts = g1_points(spark, sf_dir)
    qs = embed.embed_queries(benchmark_queries(spark, sf_dir), embed.HashingEncoder(DIM), with_prefix=False)
    hits = search.topk(pts, qs, 3, payload=["source", "chunk", "text"])
    return search.result_view_g1(hits)


QUERIES["g1_search"] = q_g1_search


# ---------------------------------------------------------------- the physical store



def q_store_roundtrip(spark, sf_dir):
    """Create a store in the shared folder, upsert the
    encoded chunk points of the earlier run, then of all documents (ids
    repeat, last path wins), and scan it back."""
    store = VectorStore(spark, scratch_path(spark, "store"), buckets=16).ensure(DIM)
    cols = store.scan().columns

    def points(files):
        p = dedup.last_wins(doc_points(files))
        return embed.embed_passages(p, embed.HashingEncoder(DIM)).select(*cols)

    store.upsert(points(previous_files(spark, sf_dir)))
    store.upsert(points(doc_files(spark, sf_dir)))
    n = store.count()
    return store.scan(["point_id", "filepath", "file_hash", "chunk_id", "total_chunks"]).withColumn(
        "points", F.lit(n).cast("bigint"))


def q_store_filter(spark, sf_dir):
    """A store with declared filter columns (file type as folder),
    asked for the points of five files by name and type."""
    store = VectorStore(spark, scratch_path(spark, "filtered"), buckets=8).ensure(DIM)
    store.declare_filter_columns(partition="file_type")
    pts = embed.embed_passages(dedup.last_wins(doc_points(doc_files(spark, sf_dir))), embed.HashingEncoder(DIM))
    store.upsert(pts.select(*store.scan().columns))
    wanted = doc_files(spark, sf_dir).where(F.col("doc_id").isin(1, 10, 20, 30, 40)).select(tx.file_name("path").alias("n"))
    names = [r.n for r in wanted.collect()]  # five names at most
    return store.scan(["point_id", "filename", "chunk_id", "file_type"]).where(F.col("filename").isin(names) & (F.col("file_type") == "txt"))


def q_store_append(spark, sf_dir):
    """S7 + G1 run: conversations as paged files appended under random ids;
    read back without the ids."""
    from vellum.plans.indexing import run_token_ingest, token_store_schema

    store = VectorStore(spark, scratch_path(spark, "g1store"), buckets=8).ensure(DIM, token_store_schema())
    c = table(spark, sf_dir, "conversations")
    path = F.concat(F.lit("conversations/"), F.col("conv_id").cast("string"), F.lit(".pdf"))
    pages = c.select(path.alias("path"), (F.col("turn") + 1).alias("page"), "text",
                     F.md5(F.col("conv_id").cast("string")).alias("file_hash"))
    run_token_ingest(store, pages, failed_at=RUN_AT.replace("T", " "))
    return store.scan(["point_id", "source", "chunk", "tokens", "file_hash"]).select(
        "source", "chunk", "tokens", "file_hash", F.length("point_id").cast("int").alias("id_len"))


QUERIES["store_roundtrip"] = q_store_roundtrip
QUERIES["store_append"] = q_store_append
QUERIES["store_filter"] = q_store_filter


def q_ann_topk_all_cells(spark, sf_dir):
    """Q9 machinery check: IVF with all 16 cells probed and small buckets
    (cells split over several cogroup groups) returns the exact top 5."""
    pts = points_from_embeddings(spark, sf_dir)
    qs = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    idx = ann.build_ivf(pts, 16)
    hits = ann.ann_topk(idx, qs, 5, nprobe=16, points_per_bucket=64, payload=["label"])
    return hits.select("query_id", "rank", F.round("score", 4).alias("score"), "point_id", "label")


QUERIES["ann_topk_all_cells"] = q_ann_topk_all_cells


def q_index_documents_windows(spark, sf_dir):
    """G2 plan wiring (D5, X1, T4 as the splitter, T6-T8, R1): the same run as
    ``index_documents`` with 500/50 token windows cutting the blocks."""
    files = mixed_files(spark, sf_dir)
    state = previous_files(spark, sf_dir).select("path", "file_hash")
    splitter = lambda arr: F.transform(arr, lambda t: chunking.token_windows(t, 500, 50))
    plan = indexing.plan_index(files, state, decoders=DECODERS, encoder=embed.HashingEncoder(DIM),
                               cfg=indexing.IndexConfig(indexed_at=RUN_AT), splitter=splitter)
    return plan.outcome.select("path", "status", "chunks", "error")


QUERIES["index_documents_windows"] = q_index_documents_windows


def q_search_copies(spark, sf_dir):
    """Q1 on exact copies: every embedding stands twice among the points, the
    copies in other partitions; of equal scores the smaller id comes first."""
    e = table(spark, sf_dir, "embeddings")
    pts = e.select(F.col("vec_id").alias("point_id"), F.col("embedding").alias("vector"))
    pts = pts.unionByName(pts.withColumn("point_id", F.col("point_id") + 1_000_000_000))
    hits = search.topk(pts, e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")), 5)
    return hits.select("query_id", "rank", F.round("score", 4).alias("score"), "point_id")


def q_g1_store_search(spark, sf_dir):
    """G1 end to end on its own store (S7, Q1, Q6): conversations are ingested
    under random string ids and that very store is searched (without the ids)."""
    from vellum.plans.indexing import run_token_ingest, token_store_schema

    store = VectorStore(spark, scratch_path(spark, "g1search"), buckets=8).ensure(DIM, token_store_schema())
    c = with_blank_files(table(spark, sf_dir, "conversations"))
    path = F.concat(F.lit("conversations/"), F.col("conv_id").cast("string"), F.lit(".pdf"))
    pages = c.select(path.alias("path"), (F.col("turn") + 1).alias("page"), "text", F.md5(F.col("conv_id").cast("string")).alias("file_hash"))
    run_token_ingest(store, pages, failed_at=RUN_AT.replace("T", " "))
    qs = embed.embed_queries(benchmark_queries(spark, sf_dir), embed.HashingEncoder(DIM), with_prefix=False)
    hits = search.topk(store.scan(), qs, 3, payload=["text"])
    return hits.select("query_id", "rank", F.round("score", 4).alias("score"), F.md5("text").alias("text_md5"))


GIVEN_PROBES = 26  # of 40 cells


def given_centres(spark, sf_dir):
    """The mean vectors of four parts of each label."""
    e = table(spark, sf_dir, "embeddings").select("label", F.pmod("vec_id", F.lit(4)).alias("part"), F.posexplode("embedding").alias("i", "x"))
    means = e.groupBy("label", "part", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    rows = means.groupBy("label", "part").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).orderBy("label", "part").collect()  # four rows a label
    return [[p["x"] for p in r["v"]] for r in rows]


def q_ann_topk_given(spark, sf_dir):
    """Q9 with given centres."""
    idx = ann.build_ivf(points_from_embeddings(spark, sf_dir), centres=given_centres(spark, sf_dir))
    return rounded(ann.ann_topk(idx, embedding_queries(spark, sf_dir), 5, nprobe=GIVEN_PROBES))


def q_ann_stored(spark, sf_dir):
    """Q9 + S5 + S6: an index stored as a table.  Every second vector is written
    turned round, then all are upserted as they are, so ids change their cells;
    the search equals that of an index built afresh."""
    schema = points_from_embeddings(spark, sf_dir).select("point_id", "vector", F.col("label").cast("string").alias("filepath")).schema
    store = IndexedStore(spark, scratch_path(spark, "index")).ensure_index(given_centres(spark, sf_dir), GIVEN_PROBES, schema)
    pts = points_from_embeddings(spark, sf_dir).select("point_id", "vector", F.col("label").cast("string").alias("filepath"))
    store.upsert(pts.where("point_id % 2 = 0").withColumn("vector", F.transform("vector", lambda x: -x)))
    store.upsert(pts)
    return rounded(store.search(embedding_queries(spark, sf_dir), 5))


QUERIES.update({"search_copies": q_search_copies, "g1_store_search": q_g1_store_search, "ann_topk_given": q_ann_topk_given, "ann_stored": q_ann_stored})
