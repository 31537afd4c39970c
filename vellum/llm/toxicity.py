"""Toxicity by cumulative-link ordinal regression on sparse text features.

Severity has three ordered grades: 0 not toxic, 1 toxic, 2 toxic with many
different toxic words.  The labels say only whether a text is toxic; grades 1
and 2 part the toxic texts at the median number of such words.  One weight
vector serves both thresholds: P(grade <= k) = sigmoid(threshold_k - score),
and a text's severity is its expected grade.

A feature is a word or the first 4, 5 or 6 characters of one (inflected forms
share those), present or not.  The model is fitted on a bounded sample of
labelled texts (``SAMPLE``, the smallest hashes of doc_id; equal texts once):
features are counted in Spark, at most ``FEATURES`` with the strongest
association and a z-score of ``Z`` or more are kept, and the sample's rows of
those few features come to the driver.  Every row of the table is scored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import text_hash, written

SAMPLE = 12_000  # labelled texts
FEATURES = 4096
Z = 5.0
PREFIXES = (4, 5, 6)
RIDGE, STEPS, RATE = 1e-5, 800, 0.1
HELD_WORDS = 300_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def text_words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def word_features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, grade: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and the two ordered thresholds of the cumulative-link model over
    present features (row, column), by gradient steps with momentum scaling."""
    w, t = np.zeros(n_features), np.array([1.0, 0.0])  # first threshold, log of the gap
    n = max(1, len(grade))
    m, v = np.zeros(n_features + 2), np.zeros(n_features + 2)
    for step in range(1, STEPS + 1):
        score = np.bincount(rows, w[cols], len(grade)) if len(rows) else np.zeros(len(grade))
        gap = np.exp(t[1])
        p0, p1 = _sigmoid(t[0] - score), _sigmoid(t[0] + gap - score)
        d0, d1 = p0 * (1 - p0), p1 * (1 - p1)
        p = np.maximum(np.choose(grade, [p0, p1 - p0, 1 - p1]), 1e-12)
        by0 = np.choose(grade, [d0, -d0, 0 * d0]) / p  # of the log-likelihood, by each threshold
        by1 = np.choose(grade, [0 * d1, d1, -d1]) / p
        g_w = np.bincount(cols, -(by0 + by1)[rows], n_features) if len(rows) else np.zeros(n_features)
        g = -np.r_[g_w / n - RIDGE * w, (by0 + by1).sum() / n, by1.sum() * gap / n]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, t = w - move[:-2], t - move[-2:]
    return w, np.array([t[0], t[0] + np.exp(t[1])])


def _sample(docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """text and toxic of the bounded sample, equal texts once."""
    chosen = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = written(chosen.orderBy(F.xxhash64("id"), "id").limit(size), "labelled")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = texts.join(chosen, texts["doc_id"] == chosen["id"]).where("text is not null")
    return written(found.groupBy("text").agg(F.max("toxic").alias("toxic")), "toxic-sample")


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> tuple[dict[str, float], np.ndarray]:
    """Feature weights and thresholds; without toxic or without other labelled
    texts there is nothing to learn and no text is toxic."""
    sample = _sample(docs, labels, size)
    totals = dict(sample.groupBy("toxic").count().collect())
    n1, n0 = sum(n for k, n in totals.items() if k > 0), totals.get(0, 0)
    if not n1 or not n0:
        return {}, np.array([50.0, 51.0])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = (Counter(), Counter())
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen[toxic > 0].update({f for w in set(text_words(text)) for f in word_features(w)})
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.record_batch([pa.array(names), pa.array([seen[1][f] for f in names]), pa.array([seen[0][f] for f in names])], ["f", "a", "b"])

    found = sample.mapInArrow(count, "f string, a long, b long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    share = (F.col("a") + F.col("b")) / (n1 + n0)
    z = (F.col("a") / n1 - F.col("b") / n0) / F.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    best = found.where("a + b >= 3").where(F.col("a") + F.col("b") < n1 + n0).withColumn("z", z).where(F.abs("z") >= Z)
    best = best.orderBy(F.desc(F.abs("z")), "f").limit(FEATURES).collect()
    names = {r["f"]: i for i, r in enumerate(best)}
    toxic_words = {r["f"] for r in best if r["z"] > 0}

    def rows(batches):
        for b in batches:
            has, part = [], []
            for text in b.column(0).to_pylist():
                words = set(text_words(text))
                has.append(sorted({names[f] for w in words for f in word_features(w) if f in names}))
                part.append(sum(any(f in toxic_words for f in word_features(w)) for w in words))
            yield pa.record_batch([pa.array(has, pa.list_(pa.int32())), pa.array(part, pa.int64()), b.column(1)], ["has", "part", "toxic"])

    got = sample.mapInArrow(rows, "has array<int>, part long, toxic int").toPandas()  # at most `size` rows of a few numbers
    toxic = got["toxic"].to_numpy() > 0
    part = got["part"].to_numpy()
    grade = np.where(toxic, 1 + (part > np.median(part[toxic])), 0)
    lens = got["has"].map(len).to_numpy()
    cols = np.concatenate([np.asarray(x, np.int64) for x in got["has"]]) if lens.sum() else np.zeros(0, np.int64)
    weights, thresholds = fit_ordinal(np.repeat(np.arange(len(got)), lens), cols, grade, len(names))
    return {f: float(weights[i]) for f, i in names.items()}, thresholds


def score(docs: DataFrame, weights: dict[str, float], thresholds: np.ndarray, least: float = 0.5, rest: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``severity`` (expected grade, 0 to 2), ``grade`` (most likely)
    and ``toxic`` (probability of a grade above 0 is ``least`` or more),
    and the long columns ``rest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[str, ...]] = {}
        for b in batches:
            if len(held) > HELD_WORDS:
                held = {}
            scores = []
            for text in b.column(1):
                present: set[str] = set()
                for w in set(text_words(text.as_py())):
                    fs = held.get(w)
                    if fs is None:
                        fs = held[w] = tuple(f for f in word_features(w) if f in weights)
                    if fs:
                        present.update(fs)
                scores.append(sum(weights[f] for f in sorted(present)))
            s = np.array(scores, np.float64)
            above = [1 - _sigmoid(t - s) for t in thresholds]
            p = np.stack([1 - above[0], above[0] - above[1], above[1]])
            yield pa.record_batch(
                [b.column(0), pa.array(above[0] + above[1]), pa.array(p.argmax(0) if len(s) else s.astype(np.int64)), pa.array(above[0] >= least), *b.columns[2:]],
                ["doc_id", "severity", "grade", "toxic", *rest],
            )

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *rest)
    return d.mapInArrow(run, ", ".join(["doc_id long, severity double, grade long, toxic boolean", *(f"{c} long" for c in rest)]))


def toxicity(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs`` (see ``score``).  Null and empty texts have
    no features; repeated rows get equal results; a null doc_id stays; labels
    without toxic or doc_id are left out; an empty table gives no rows; other
    columns are not looked at."""
    return score(docs, *fit(docs, labels, size))


def drop_toxic(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows whose text is found toxic."""
    bad = score(docs.select("doc_id", "text", text_hash("text").alias("h")), *fit(docs, labels, size), rest=("h",))
    bad = bad.where("toxic").select(F.col("doc_id").alias("__bad"), F.col("h").alias("__h")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__bad"]) & (text_hash(docs["text"]) == bad["__h"]), "left_anti")
