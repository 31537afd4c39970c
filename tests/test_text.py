import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellum.functions import identity, text as tx
from vellum.operators import search


def one(spark, value, fn):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(fn(F.col("x")).alias("y")).first()["y"]


def many(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["y"] for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_normalize_golden(spark):
    cases = {
        "é": "é",
        "a\u0007b": "ab",
        "a\tb": "a b",
        "a \t  b": "a b",
        "‘q’ “q” – —": "'q' \"q\" - -",
        "a\n \nb": "a\n\nb",
        "a\n\n\n\nb": "a\n\nb",
        "\r a\rb \r\n": "a\rb",
        "　 x  ": "x",
    }
    got = many(spark, list(cases), tx.normalize_text)
    assert got == list(cases.values())


_ALPHABET = st.sampled_from(list("ab é\t\n\r\u0007́ ’“—　 x"))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=_ALPHABET, max_size=30), min_size=1, max_size=8))
def test_normalize_invariants(spark, values):
    once = many(spark, values, tx.normalize_text)
    twice = many(spark, once, tx.normalize_text)
    assert once == twice  # idempotent
    for s in once:
        assert s == s.strip()
        assert "\n\n\n" not in s
        assert not re.search(r"[ \t]{2,}", s)
        assert "\t" not in s and "\u0007" not in s
        assert not re.search("[‘’“”–—]", s)


def test_preview(spark):
    a600, a601 = "a" * 600, "a" * 601
    assert many(spark, [a600, a601], lambda c: tx.preview(c, 600)) == [a600, a600 + "..."]
    t300, t301 = "a\n" * 150, "a\n" * 150 + "b"
    got = many(spark, [t300, t301], lambda c: tx.preview(c, 300, flatten=True))
    assert got == ["a " * 150, "a " * 150 + "..."]


def test_file_name_parts(spark):
    paths = ["d/Informe.PDF", "d/a.tar.gz", "d/.bashrc", "d/noext", "x/y/z.docx"]
    assert many(spark, paths, tx.file_name) == ["Informe.PDF", "a.tar.gz", ".bashrc", "noext", "z.docx"]
    assert many(spark, paths, tx.file_suffix) == [".PDF", ".gz", "", "", ".docx"]
    assert many(spark, paths, tx.file_stem) == ["Informe", "a.tar", ".bashrc", "noext", "z"]
    assert many(spark, paths, tx.file_type) == ["pdf", "gz", "", "", "docx"]


def test_prefixes(spark):
    assert one(spark, "t", lambda c: tx.passage_text(c, "example/bge-large")) == tx.PASSAGE_PREFIX + "t"
    assert one(spark, "t", lambda c: tx.passage_text(c, "example/text-encoder")) == "t"
    assert one(spark, "t", tx.query_text) == tx.QUERY_PREFIX + "t"


def test_filter_argument(spark):
    got = many(spark, ["filename=a=b", "page=3", "abc"], search.parse_filter_arg)
    assert got == ["a=b", "3", None]


def test_hashes_and_point_id(spark):
    df = spark.createDataFrame([("abc", 3)], "h string, c int")
    r = df.select(identity.point_id("h", "c").alias("p"), identity.file_md5("h").alias("m"),
                  identity.file_sha256("h").alias("s")).first()
    assert r["p"] == int(hashlib.md5(b"abc_3").hexdigest(), 16) % 2**63
    assert r["m"] == hashlib.md5(b"abc").hexdigest()
    assert r["s"] == hashlib.sha256(b"abc").hexdigest()
