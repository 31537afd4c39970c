"""License blocks of a document, and rows without an id spread over tasks."""

import random

from pyspark.sql import functions as F
from tests.llm.conftest import MESSY
from tests.llm.test_text_filters import words

from vellum.llm import licenses, mixing, token_output
from vellum.llm.queries import word_tokenizer


def slow_blocks(i, text):
    w = words(text)
    for label, t in licenses.TEMPLATES:
        t = t.split()
        for at in range(0, len(w) + 1, len(t)):
            share = len(set(w[at : at + 2 * len(t)]) & set(t)) / len(set(t))
            if share >= licenses.CONTAINMENT - 1e-9:
                yield str((i, label, at, round(share, 9)))


def test_every_matching_block(frame):
    r = random.Random(8)
    rows = list(MESSY)
    for i in range(25):  # several notices in one document
        parts = [x for _ in range(r.randrange(4)) for x in ["filler"] * r.randrange(40) + [y for y in r.choice(licenses.TEMPLATES)[1].split() if r.random() < 0.95]]
        rows.append((100 + i, " ".join(parts)))
    want = sorted(x for i, t, *_ in rows for x in slow_blocks(i, t))
    got = sorted(str((b.doc_id, b.label, b.first_word, round(b.containment, 9))) for b in licenses.matching_blocks(frame(rows)).collect())
    assert got == want and len(want) > 30
    assert licenses.matching_blocks(frame([])).count() == 0


def test_rows_without_an_id_are_spread(spark, frame, tmp_path):
    rows = [(None, f"text number {i} of those without an id", "s") for i in range(10_000)] + [(i, f"own {i}", "s") for i in range(20)]
    docs = frame(rows, clash=False)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be put together again
    try:
        token_output.write_tokens(docs, str(tmp_path / "t"), word_tokenizer())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    found = spark.read.parquet(str(tmp_path / "t"))
    of_shard = {r[0]: r[1] for r in found.groupBy("shard").agg(F.sum(F.size("doc_ids"))).collect()}
    assert sum(of_shard.values()) == 10_020 and max(of_shard.values()) < 5000
    digest = token_output.digest(spark, str(tmp_path / "t"))
    assert digest.count() == 10_020 and digest.where("doc_id is not null").agg(F.min("start")).first()[0] == digest.where("doc_id is null").agg(F.sum("n_tokens")).first()[0]
    taken = mixing.allocate(docs)
    assert taken.count() == 10_020 and 0.9 < taken.agg(F.sum("taken") / F.sum("size")).first()[0] < 1.1
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null/"), F.md5("text")))
    assert docs.select(mixing.draw(key)).distinct().count() == 10_020
