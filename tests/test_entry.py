import __spark_entry__ as entry


def test_entry_and_registry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["query_id", "rank", "score", "point_id", "label"]
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 40


def test_small_queries_run(spark):
    qs = entry.queries()
    for name in ["normalize_text", "token_chunks", "section_blocks_per_file", "run_summary", "batch_search"]:
        assert qs[name](spark, "/root/testdata/sf0.001").count() >= 0
