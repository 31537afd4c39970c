import numpy as np
from pyspark.sql import functions as F

from vellum.operators import chunking
from vellum.operators import embed
from vellum.operators.extract import decode_files
from vellum.sources import files as src

# Stand-ins are defined inside the tests: Python workers cannot import this
# module, and functions defined in a test body are shipped by value.


def test_model_encoder_plugin(spark):
    def load():
        class CountModel:
            """vector = (length, vowels, digits)"""

            def encode(self, texts):
                return np.array([[len(t), sum(c in "aeiou" for c in t), sum(c.isdigit() for c in t)] for t in texts],
                                dtype=float)

        return CountModel()

    df = spark.createDataFrame([(1, "abc1"), (2, ""), (3, "zzz")], "id int, text string")
    enc = embed.ModelEncoder(load, dim=3, model_name="example/bge-small", batch_size=2)
    got = {r["id"]: r["vector"] for r in enc.embed(df).collect()}
    pre = "Represent this passage for searching relevant queries: "
    t = pre + "abc1"
    v = np.array([len(t), sum(c in "aeiou" for c in t), 1], float)
    assert np.allclose(got[1], v / np.linalg.norm(v), atol=1e-6)
    assert abs(np.linalg.norm(got[3]) - 1) < 1e-6
    q = embed.embed_queries(df.withColumnRenamed("text", "query"), enc).collect()
    assert all(abs(np.linalg.norm(r["vector"]) - 1) < 1e-6 for r in q)


def test_udf_decoder_errors_and_pages(spark):
    def parse_pages(b: bytes) -> list:
        """pages separated by form feeds; content starting with 'BAD' fails"""
        t = b.decode("utf-8")
        if t.startswith("BAD"):
            raise ValueError("cannot parse")
        return t.split("\f")

    page = "p" * 70
    rows = [("a.pdf", f"{page}\f{'q' * 10}\f{page}"), ("bad.pdf", "BAD file"), ("empty.pdf", "x\fy"), ("n.txt", page)]
    files = src.with_hash(src.files_from_table(
        spark.createDataFrame(rows, "p string, c string").select("p", F.col("c").cast("binary").alias("c")),
        F.col("p"), F.col("c")))
    decoders = {"pdf": src.UdfDecoder(parse_pages, "pages"), "txt": src.TextDecoder()}
    out = {r["path"]: r for r in decode_files(files, decoders).collect()}
    assert [(b["page"], b["total_pages"]) for b in out["a.pdf"]["blocks"]] == [(1, 3), (3, 3)]
    assert out["bad.pdf"]["error"] == "ValueError: cannot parse" and out["bad.pdf"]["blocks"] is None
    assert out["empty.pdf"]["error"].startswith("no extractable text")
    assert out["n.txt"]["error"] is None and out["n.txt"]["blocks"][0]["section"] == "Sección 1"


def test_python_tokenizer_windows(spark):
    """A stand-in for a tokenizer that runs in Python: two characters a token."""

    class PairTokenizer:
        stable = False

        def codec(self):
            return lambda t: [t[i : i + 2] for i in range(0, len(t), 2)], lambda ids: "".join(ids)

    d = spark.createDataFrame([(1, "abcdefghijk"), (2, ""), (3, None), (4, "ab")], "id int, text string")
    w = chunking.token_window_chunks(d, "text", keep=["id"], size=3, overlap=1, tokenizer=PairTokenizer())
    assert sorted(tuple(r) for r in w.collect()) == [
        (1, 0, "abcdef", 3), (1, 1, "efghij", 3), (1, 2, "ijk", 2), (4, 0, "ab", 1)]
    got = d.select(chunking.token_windows("text", 3, 1, PairTokenizer()).alias("w")).first()["w"]
    assert got == ["abcdef", "efghij", "ijk"]
