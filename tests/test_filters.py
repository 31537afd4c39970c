"""Declared filter columns: what a filtered scan opens and reads."""

import pytest
from pyspark.sql import functions as F

from vellum.session import scratch_path
from vellum.sources.store import VectorStore


def points(spark, n, types=("pdf", "docx")):
    d = spark.range(n).select(
        F.col("id").alias("point_id"), F.array(*[F.lit(0.5).cast("float")] * 4).alias("vector"),
        # many files in no order of their names, so minima and maxima of a row group tell little
        F.md5((F.col("id") % 400).cast("string")).alias("filename"), F.concat(F.lit("p/"), F.col("id").cast("string")).alias("filepath"),
        F.element_at(F.array(*[F.lit(t) for t in types]), (F.col("id") % len(types) + 1).cast("int")).alias("file_type"),
        F.sha2((F.col("id") % 400).cast("string"), 256).alias("file_hash"), F.repeat(F.md5(F.col("id").cast("string")), 20).alias("text"))
    return d.withColumns({c: F.lit(None).cast(t) for c, t in (("chunk_id", "int"), ("char_count", "int"), ("indexed_at", "string"), ("page", "int"),
                                                              ("total_pages", "int"), ("section", "string"), ("section_idx", "int"), ("total_chunks", "int"))})


def rows_of_scan(df):
    """Rows that the reader handed on, before Spark's own filter."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


def test_filters_skip_row_groups_and_folders(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        store = VectorStore(spark, scratch_path(spark, "filters"), buckets=2, files_per_bucket=1).ensure(4)
        store.declare_filter_columns(partition="file_type", row_group_bytes=64 << 10)
        p = points(spark, 12_000).select(*store.scan().columns)
        store.upsert(p)
        store.upsert(p.where("point_id < 500").withColumn("text", F.lit("new")))
        assert store.count() == 12_000 and store.scan().where("text = 'new'").count() == 500
        absent = F.md5(F.lit("no such file"))
        name = p.where("point_id = 7").first().filename
        by_name = store.scan(["point_id", "filename"]).where(F.col("filename") == name)
        assert sorted(r.point_id for r in by_name.collect()) == [i for i in range(12_000) if i % 400 == 7]
        assert rows_of_scan(by_name) < 0.2 * 12_000
        assert rows_of_scan(store.scan(["point_id"]).where(F.col("file_hash") == spark.range(1).select(absent).first()[0])) < 0.2 * 12_000
        docx = store.scan(["point_id", "file_type"]).where("file_type = 'docx'")
        assert docx.count() == 6000 and rows_of_scan(docx) == 6000
        assert {r.file_type for r in store.scan().select("file_type").distinct().collect()} == {"pdf", "docx"}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_what_can_be_declared(spark):
    store = VectorStore(spark, scratch_path(spark, "filters"), buckets=2).ensure(4)
    with pytest.raises(ValueError):
        store.declare_filter_columns(("no_such",))
    store.upsert(points(spark, 10).select(*store.scan().columns))
    with pytest.raises(ValueError):
        store.declare_filter_columns(partition="file_type")
    store.declare_filter_columns(("page",))
    assert VectorStore(spark, store.root).filters()["columns"] == ["page"]
    store.upsert(points(spark, 30).select(*store.scan().columns))
    assert store.count() == 30
