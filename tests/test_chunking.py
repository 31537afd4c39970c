from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellum.operators import chunking, per_file
from vellum.operators.extract import chunk_rows


def windows(spark, n):
    text = " ".join(["w"] * n) if n else ""
    df = spark.createDataFrame([(1, text)], "id int, text string")
    rows = chunking.token_window_chunks(df, "text", keep=["id"]).orderBy("chunk").collect()
    return [r["tokens"] for r in rows]


def test_token_windows_golden(spark):
    assert windows(spark, 0) == []
    assert windows(spark, 1) == [1]
    assert windows(spark, 450) == [450]
    assert windows(spark, 451) == [451, 1]
    assert windows(spark, 500) == [500, 50]
    assert windows(spark, 950) == [500, 500, 50]


@settings(max_examples=15, deadline=None)
@given(st.integers(min_value=0, max_value=2000))
def test_token_windows_property(spark, n):
    got = windows(spark, n)
    assert all(t <= 500 for t in got)
    assert len(got) == (0 if n == 0 else (n - 1) // 450 + 1)
    if got:
        assert got[-1] == min(500, n - 450 * (len(got) - 1))


def test_recursive_golden():
    split = chunking.split_recursive
    assert split("short text") == ["short text"]
    assert split("   \n  ") == []
    p1, p2 = "a" * 300, "b" * 300
    assert split(p1 + "\n\n" + p2) == [p1, p2]
    # separator kept at the start of the next piece
    assert split("x" * 400 + ". " + "y" * 200) == ["x" * 400, ". " + "y" * 200]
    # a piece of exactly 512 is split again with the next separator
    w = ("word " * 103)[:512]
    assert len(w) == 512 and all(len(c) <= 512 for c in split(w + "\n\n" + "z" * 10))
    # no separator at all: characters, chunks of 512 with 52 of overlap
    c = split("q" * 1000)
    assert [len(x) for x in c] == [512, 512, 80]


@settings(max_examples=30, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab .,;!?\n")), max_size=3000))
def test_recursive_property(text):
    for c in chunking.split_recursive(text):
        assert 0 < len(c) <= 512
        assert c == c.strip()


def test_chunk_numbering_drops_short(spark):
    long1, long2 = "l" * 70, "m" * 80
    blocks = F.array(
        F.struct(F.lit(1).alias("page"), F.lit("s" * 59).alias("text")),
        F.struct(F.lit(2).alias("page"), F.lit(long1).alias("text")),
        F.struct(F.lit(3).alias("page"), F.lit(long2).alias("text")),
    )
    ch = per_file.chunk_blocks_array(blocks, fields=["page"])
    df = spark.range(1).select(F.lit("d/x.pdf").alias("path"), F.lit("h").alias("file_hash"),
                               ch.alias("chunks"), F.lit(None).cast("string").alias("error"))
    df = df.withColumn("chunks", F.transform("chunks", lambda c: F.struct(
        c["page"].alias("page"), F.lit(None).cast("int").alias("total_pages"), F.lit(None).cast("string").alias("section"),
        F.lit(None).cast("int").alias("section_idx"), c["text"].alias("text"))))
    rows = chunk_rows(df, "t").orderBy("chunk_id").collect()
    assert [(r["chunk_id"], r["page"], r["total_chunks"]) for r in rows] == [(0, 2, 2), (1, 3, 2)]
    assert rows[0]["filename"] == "x.pdf" and rows[0]["file_type"] == "pdf" and rows[0]["char_count"] == 70


def test_row_and_per_file_numbering_agree(spark):
    rows = [("p1", 1, "a" * 100 + "\n\n" + "b" * 30), ("p1", 2, "c" * 61), ("p2", 5, "d" * 59), ("p2", 7, "e" * 600)]
    b = spark.createDataFrame(rows, "path string, block_no int, text string").withColumn("file_hash", F.lit("h"))
    a = chunking.chunk_blocks(b, "t").select("filepath", "chunk_id", "total_chunks", "text").collect()
    assert sorted((r[0], r[1], r[2]) for r in a) == [("p1", 0, 2), ("p1", 1, 2), ("p2", 0, 2), ("p2", 1, 2)]


def test_native_splitter_equals_the_rule(spark):
    import random

    from pyspark.sql import functions as F

    r = random.Random(3)
    rows = [None, "", " ", "a" * 511, "a" * 512, "a" * 513, "x" * 2000, " " * 700, "\n\n" * 400, "é" * 1300 + "\n" + "b " * 800]
    tokens = ["\n\n", "\n", ". ", "? ", "! ", "; ", ", ", " ", " ", " ", "w", "wordy", "é"]
    rows += ["".join(r.choice([*tokens, "z" * r.choice([3, 3, 3, 600])]) for _ in range(r.choice([5, 100, 400, 1500]))) for _ in range(80)]
    d = spark.createDataFrame(list(enumerate(rows)), "id int, text string")
    d = d.select("id", chunking.recursive_chunks_native("text").alias("n"), chunking.recursive_chunks("text").alias("u"), chunking.recursive_chunks_native("text", 40, 12).alias("small"))
    for i, native, udf, small in d.collect():
        want = [] if rows[i] is None else chunking.split_recursive(rows[i])
        assert native == udf == want
        assert small == ([] if rows[i] is None else chunking.split_recursive(rows[i], size=40, overlap=12))
