"""Rows without a doc_id, or with a repeated one, are decided by their text."""

import corpus_pipeline
from tests.llm.test_text_filters import corpus, labelled

from vellum.llm import decontaminate, simhash, toxicity

LEAK = "one two three four five six seven eight nine ten"


def texts(df):
    return sorted(r.text for r in df.collect())


def test_one_row_of_each_group_without_ids(frame):
    rows = [(None, "alpha beta gamma delta"), (None, "alpha beta gamma delta"), (None, "quite another text stands here"),
            (7, "a third text of seven"), (7, "and a fourth, also of seven words"), (9, "a third text of seven"), (None, "a third text of seven")]
    got = simhash.keep_one(frame(rows))
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted(
        [("7", rows[3][1]), ("7", rows[4][1]), ("None", rows[0][1]), ("None", rows[2][1])]
    )


def test_a_toxic_row_takes_no_other_row_of_its_id(spark, frame):
    rows, toxic = corpus()
    labels = labelled(spark, [(i, 1, int(t)) for i, t in enumerate(toxic)])
    bad, good = "insultx vilena insultx vileno", "alpha beta gamma delta omega sigma"
    docs = frame(rows + [(None, bad), (None, good), (5000, bad), (5000, good), (None, None)])
    kept = toxicity.drop_toxic(docs, labels)
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.where("doc_id is null or doc_id = 5000").collect()) == sorted(
        [("None", good), ("5000", good), ("None", "None")]
    )


def test_a_contaminated_row_takes_no_other_row_of_its_id(spark, frame):
    items = spark.createDataFrame([(1, LEAK)], "item_id long, text string")
    kept = decontaminate.clean(frame([(None, LEAK + " more"), (None, "clean"), (3, LEAK), (3, "clean too"), (None, None)]), items)
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [("3", "clean too"), ("None", "None"), ("None", "clean")]


def test_the_stages_keep_every_clean_text_without_an_id(spark, frame, tmp_path):
    rows, toxic = corpus()
    own = ["the first clean text that has no id", "quite a different second one stands in this row"]
    docs = frame(rows + [(None, own[0]), (None, own[1]), (None, "insultx vilena insultx vileno"), (None, LEAK)], clash=False)
    labelled(spark, [(i, 1, int(t)) for i, t in enumerate(toxic)]).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, LEAK)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
    assert texts(docs.where("doc_id is null")) == sorted(own)
