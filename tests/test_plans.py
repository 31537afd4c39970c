from pyspark.sql import functions as F

from vellum.plans import registry
from vellum.sources import files as src
from vellum.sources.tables import read_parquet

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_search_has_no_pair_join(spark):
    p = plan(registry.q_search_topk(spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "MapInPandas" in p  # numpy block scan
    q = plan(registry.q_ann_topk(spark, SF))
    assert "CartesianProduct" not in q and "BroadcastNestedLoopJoin" not in q and "FlatMapCoGroupsInPandas" in q


def test_filter_and_columns_reach_the_scan(spark):
    from vellum.operators import search

    pts = registry.points_from_embeddings(spark, SF)
    qs = registry.table(spark, SF, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    p = plan(search.topk(search.payload_filter(pts, "label", 3), qs, 5, payload=["label"]))
    assert "EqualTo(label,3)" in p
    assert "ReadSchema: struct<vec_id:bigint,label:int>" in p  # payload scan reads two columns


def test_small_scans_are_spread(spark):
    df = read_parquet(spark, f"{SF}/documents.parquet")
    assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert df.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_html_decoder(spark):
    html = ("<html><head><title>T</title><script>var x='<p>no</p>';</script></head><body>"
            "<nav><a>menu</a></nav><h1>Big &amp; Bold</h1><p>One &lt;two&gt;<br>three</p><!-- c --><h3>Small</h3>"
            "<p>Four</p><style>p{}</style></body></html>")
    df = spark.createDataFrame([(html,)], "content string")
    items = df.select(src.HtmlDecoder().items(F.col("content")).alias("i")).first()["i"]
    kept = [(r["style"], r["text"]) for r in items if r["text"].strip()]
    assert kept == [("Normal", "menu"), ("Heading 1", "Big & Bold"), ("Normal", "One <two>"), ("Normal", "three"),
                    ("Heading 3", "Small"), ("Normal", "Four")]


def test_files_are_decoded_once(spark):
    """Blocks and errors as one frame read the pages once; the two frames hold its rows."""
    from vellum.operators.extract import extract_blocks

    assert plan(registry.q_extract_blocks(spark, SF)).count("ReadSchema: struct<page_id") == 1
    files = registry.mixed_files(spark, SF)
    both = extract_blocks(files, registry.DECODERS, together=True)
    blocks, errors = extract_blocks(files, registry.DECODERS)
    assert sorted(map(str, both.where("error is null").drop("error").collect())) == sorted(map(str, blocks.collect()))
    assert sorted(map(str, both.where("error is not null").select("path", "error").collect())) == sorted(map(str, errors.collect()))


def test_words_are_counted_in_slices():
    import pyarrow as pa

    from vellum.operators import embed

    words = [[f"w{i % 13}" for i in range(n)] for n in (0, 3, 900, 5, 0, 40)] + [None]
    rb = pa.RecordBatch.from_pydict({"id": list(range(7)), "__words": words})
    whole = pa.Table.from_batches(list(embed._arrow_buckets(8, "v")([rb])))
    old, embed.SLICE_WORDS = embed.SLICE_WORDS, 10
    try:
        parts = list(embed._arrow_buckets(8, "v")([rb]))
    finally:
        embed.SLICE_WORDS = old
    assert len(parts) > 3 and pa.Table.from_batches(parts).to_pydict() == whole.to_pydict()
