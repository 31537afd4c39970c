"""The registered queries and the pipeline on the smallest tables."""

import corpus_pipeline
import duckdb
import pytest
from tests.llm.test_simhash import slow_components, slow_fingerprint
from tests.llm.test_text_filters import slow_contamination

from vellum.llm import mixing, oracle, queries
from vellum.llm.common import read_table

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_one_after_another(spark):
    docs = read_table(spark, SF, "documents")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "decontamination", "source_mix", "token_ids"]
    kept = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == columns
        kept.append(docs.collect())
    everything, civil, single, clean, mixed = kept
    labels = {r.doc_id: r.toxic for r in read_table(spark, SF, "labels").collect()}
    gone = {r.doc_id for r in everything} - {r.doc_id for r in civil}
    assert sum(labels.get(i, 1) == 0 for i in gone) <= 1
    ids = [r.doc_id for r in civil]
    roots = slow_components(ids, [slow_fingerprint(r.text) for r in civil], 2)
    assert {r.doc_id for r in single} == set(roots)
    items = [(r.item_id, r.text) for r in read_table(spark, SF, "benchmark").collect()]
    hit = {x[0] for x in slow_contamination([(r.doc_id, r.text) for r in single], items) if x[-1]}
    assert {r.doc_id for r in clean} == {r.doc_id for r in single} - hit
    size = sum(len(r.text.split()) for r in clean)
    assert abs(sum(len(r.text.split()) for r in mixed) - size) < 0.02 * size
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in mixed)
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, out))


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_queries_agree_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = con.sql(oracle.SQL[name])
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r[c] for c in order) for r in got.collect()), key=key) == sorted(want.project(", ".join(order)).fetchall(), key=key)


def test_all_are_registered():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
    assert mixing.MOST == 3
