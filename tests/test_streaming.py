import os

from vellum.session import scratch_path
from vellum.sources import files as src
from vellum.sources.store import VectorStore
from vellum.streaming.folder_ingest import start_folder_ingest

TEXT = ("Streaming ingest keeps the index current as new files arrive in the folder. " * 10).strip()


def test_available_now_ingest(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "one.txt").write_text(TEXT)
    (folder / "two.txt").write_text(TEXT.replace("current", "fresh"))
    store = VectorStore(spark, scratch_path(spark, "sstore")).ensure(64)
    ckpt = scratch_path(spark, "sckpt")
    decoders = {"txt": src.TextDecoder()}
    q = start_folder_ingest(spark, str(folder), store, ckpt, suffixes=(".txt",), decoders=decoders)
    q.awaitTermination()
    n1 = store.count()
    assert n1 > 0 and sum(r["processed"] for r in q.run_summaries) == 2
    os.makedirs(folder / "later")
    (folder / "later" / "three.txt").write_text(TEXT.replace("index", "table"))
    q = start_folder_ingest(spark, str(folder), store, ckpt, suffixes=(".txt",), decoders=decoders)
    q.awaitTermination()
    assert sum(r["processed"] for r in q.run_summaries) == 1  # only the new file
    assert store.count() > n1
