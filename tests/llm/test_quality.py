"""Importance resampling against plain Python, and batches without words."""

import math
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F
from tests.llm.conftest import LONG, MESSY
from tests.llm.test_text_filters import labelled

from vellum.llm import queries, quality
from vellum.llm.common import text_hash


def grams(text):
    """Bucket numbers of the words and neighbouring word pairs of a text."""
    h = [xxhash.xxh32_intdigest(w, quality.SEED) for w in (text or "").encode().lower().split()]
    pairs = [((a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F) % 2**64) >> 20 for a, b in zip(h, h[1:])]
    return [x % quality.BUCKETS for x in h + pairs]


def by_hand(rows, good, noise, k):
    raw, target = Counter(), Counter()
    for i, text in rows:
        raw.update(grams(text))
        if i in good:
            target.update(grams(text))
    n, m = sum(raw.values()) + quality.BUCKETS, sum(target.values()) + quality.BUCKETS
    weights = [sum(math.log((target[b] + 1) / m) - math.log((raw[b] + 1) / n) for b in grams(text)) for _, text in rows]
    keys = [w - math.log(-math.log(((x % (1 << 52)) + 0.5) / (1 << 52))) for w, x in zip(weights, noise)]
    best = sorted(range(len(rows)), key=lambda j: (-keys[j], rows[j][0]))[:k]
    return weights, keys, set(best)


def test_equal_to_plain_python_on_the_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    noise = F.xxhash64(F.lit(quality.SEED), F.lit(False), "doc_id", text_hash("text"))
    held = [(r.doc_id, r.text, r.noise) for r in docs.select("doc_id", "text", noise.alias("noise")).collect()]
    marks = [r.quality for r in labels.collect() if r.quality is not None]
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    k = round(sum(marks) / len(marks) * len(held))
    weights, keys, best = by_hand([x[:2] for x in held], good, [x[2] for x in held], k)
    got = {r.doc_id: r for r in queries.op6_quality(spark, sf).collect()}
    assert len(got) == len(held)
    for j, (i, _, _) in enumerate(held):
        assert math.isclose(got[i].log_weight, weights[j], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(got[i].gumbel_key, keys[j], rel_tol=1e-9, abs_tol=1e-9)
        assert got[i].kept == (j in best)


@pytest.mark.parametrize("rows", [
    [(1, None)], [(1, "")], [(1, None), (2, ""), (3, " \n")], [(i, "some words") for i in range(512)] + [(512, "")], MESSY,
    [(1, LONG * 3), (1, LONG * 3), (None, LONG), (2, "")],
])
def test_texts_without_words(spark, frame, rows):
    got = quality.resample(frame(rows), labelled(spark, [(1, 1, 0), (3, 0, 0)]), keep=0.5).collect()
    assert len(got) == len(rows)
    assert all(r.log_weight == 0 for r, x in zip(sorted(got, key=str), sorted(rows, key=str)) if not (x[1] or "").split() and len(rows) < 4)


def test_rows_without_an_id_draw_apart(spark, frame):
    docs = frame([(None, f"text {i}") for i in range(10_000)] + [(-1, "text 0"), (5, "one"), (5, "two")])
    got = quality.resample(docs, labelled(spark, []), keep=0.5)
    assert got.select("gumbel_key").distinct().count() == 10_003
    assert 5000 <= got.where("kept").count() <= 5002
