"""Benchmark: headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR.

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries",
"sf", ...}.  Each query is fully computed into the ``noop`` sink (nothing is
collected to the driver); a small warm-up runs first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vellum.operators.embed import HashingEncoder  # noqa: E402
from vellum.plans import indexing, registry  # noqa: E402
from vellum.session import local_session, scratch_path  # noqa: E402
from vellum.sources.store import VectorStore  # noqa: E402

HEADLINE = [
    "search_topk",        # exact top-5 of every embedding over all embeddings
    "embed_search",       # encode benchmark texts, top-5 over encoded document chunks
    "batch_search",       # per-query k / threshold / filename filter
    "ann_topk",           # IVF k-means cells, 4 probed
    "normalize_text",     # T1 over every document
    "token_chunks",       # G1 500-token windows
    "recursive_chunks",   # G2 recursive character chunks
    "section_blocks_per_file",
    "index_documents",    # G2 outcome: change test, decode, blocks, chunks
    "upsert_points",      # store merge as a DataFrame
    "store_roundtrip",    # the store itself: two upserts and a scan
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="vellum-bench")
    spark.conf.set("spark.sql.shuffle.partitions", str(max(8, int(cpus) * 2)) if cpus.isdigit() else "16")
    # warm-up on the smallest tables: JVM code paths and Python workers (Arrow UDFs)
    warm = sf_dir.replace(os.path.basename(sf_dir.rstrip("/")), "sf0.001") if os.path.isdir("/root/testdata/sf0.001") else sf_dir
    for name in ("file_hashes", "search_topk", "normalize_text", "embed_search"):
        registry.QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        fn = registry.QUERIES[name]
        t0 = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    # ingest throughput in chunks per second: change test, decode, blocks, chunks,
    # encode, write to the store, quarantine and state
    store = VectorStore(spark, scratch_path(spark, "bench-store")).ensure(registry.DIM)
    t0 = time.time()
    run = indexing.run_index(store, registry.mixed_files(spark, sf_dir), decoders=registry.DECODERS, encoder=HashingEncoder(registry.DIM))
    out, ingest = run["chunks"] or 0, time.time() - t0
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "index_chunks": int(out),
        "index_chunks_per_sec": round(out / ingest, 1) if ingest > 0 else None,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
