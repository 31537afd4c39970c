import random

from pyspark.sql import functions as F

from vellum.operators import blocks, per_file


def sections_rows(spark, docs):
    rows = [(d, i, h, t) for d, els in docs.items() for i, (h, t) in enumerate(els)]
    df = spark.createDataFrame(rows, "doc int, pos int, is_heading boolean, text string")
    out = blocks.section_blocks(df, normalize=True).collect()
    return sorted((r["doc"], r["section_idx"], r["section"], r["text"]) for r in out)


def sections_array(spark, docs):
    rows = [(d, [("Heading 1" if h else "Normal", t) for h, t in els]) for d, els in docs.items()]
    df = spark.createDataFrame(rows, "doc int, els array<struct<style:string,text:string>>")
    out = df.select("doc", F.explode(per_file.section_blocks_array(F.col("els"))).alias("b")).collect()
    return sorted((r["doc"], r["b"]["section_idx"], r["b"]["section"], r["b"]["text"]) for r in out)


B = "x" * 70  # a body line long enough to make a section


def test_sections_golden(spark):
    docs = {
        1: [(True, "H1"), (False, B)],                          # heading first -> body of section 1
        2: [(False, B), (True, "H1"), (True, "H2"), (False, B)],  # H1 boundary, H2 body
        3: [(False, "short"), (True, "H"), (False, B)],          # short section dropped, no index used
        4: [(False, B)],                                        # no heading
        5: [(False, B), (True, "Trailing")],                    # trailing heading -> nothing
    }
    want = [
        (1, 1, "Sección 1", "H1\n" + B),
        (2, 1, "Sección 1", B),
        (2, 2, "H1", "H2\n" + B),
        (3, 1, "H", B),
        (4, 1, "Sección 1", B),
        (5, 1, "Sección 1", B),
    ]
    assert sections_rows(spark, docs) == want
    assert sections_array(spark, docs) == want


def test_sections_random_forms_agree(spark):
    rnd = random.Random(7)
    docs = {}
    for d in range(40):
        els = []
        for _ in range(rnd.randint(0, 25)):
            h = rnd.random() < 0.4
            els.append((h, f"T{rnd.randint(0, 99)}" if h else "w" * rnd.randint(1, 90)))
        if els:
            docs[d] = els
    assert sections_rows(spark, docs) == sections_array(spark, docs)


def test_tables_in_last_section(spark):
    cells = spark.createDataFrame(
        [(1, 0, 0, 0, " a "), (1, 0, 0, 1, "b"), (1, 0, 0, 2, "  "), (1, 0, 1, 0, ""), (1, 0, 2, 0, "c"), (1, 1, 0, 0, " ")],
        "doc int, tbl int, row int, col int, text string")
    t = blocks.table_rows_text(cells).collect()
    assert [(r["doc"], r["tbl"], r["text"]) for r in t] == [(1, 0, "a | b\nc")]
    els = spark.createDataFrame([(1, 0, False, B), (1, 1, True, "Last")], "doc int, pos int, is_heading boolean, text string")
    el2 = blocks.append_tables(els, blocks.table_rows_text(cells), doc="doc")
    out = blocks.section_blocks(el2).collect()
    assert sorted((r["section"], r["text"]) for r in out) == [("Sección 1", B)]
    el3 = blocks.append_tables(els.union(spark.createDataFrame([(1, 2, False, B)], els.schema)), blocks.table_rows_text(cells))
    out = sorted((r["section"], r["text"]) for r in blocks.section_blocks(el3).collect())
    assert out == [("Last", B + "\na | b\nc"), ("Sección 1", B)]


def test_page_blocks(spark):
    pages = spark.createDataFrame([("d", 1, "p" * 59), ("d", 2, "q" * 60)], "doc string, page int, text string")
    got = [(r["page"], r["total_pages"]) for r in blocks.page_blocks(pages).collect()]
    assert got == [(2, 2)]
    arr = spark.createDataFrame([(["p" * 59, "q" * 60],)], "pages array<string>")
    got = arr.select(F.explode(per_file.page_blocks_array(F.col("pages"))).alias("b")).collect()
    assert [(r["b"]["page"], r["b"]["total_pages"]) for r in got] == [(2, 2)]


def test_concat_and_empty(spark):
    pages = spark.createDataFrame([("d", 2, "b"), ("d", 1, "a"), ("d", 3, ""), ("e", 1, "  \n ")], "doc string, page int, text string")
    docs = blocks.concat_pages(pages)
    ok, empty = blocks.empty_document_filter(docs)
    assert [(r["doc"], r["text"]) for r in ok.collect()] == [("d", "a\nb\n")]
    assert [r["doc"] for r in empty.collect()] == ["e"]
