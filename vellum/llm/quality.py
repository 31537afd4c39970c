"""Quality by importance resampling.

Two generative models of hashed word and word-pair counts are estimated, one
of the target (texts labelled as good) and one of all raw texts.  A text's log
importance weight is the sum of log ratios over its n-grams.  Adding seeded
Gumbel noise to the log weights and keeping the largest k draws k texts without
replacement in proportion to their weights.

Counts cover every text: each task adds up its own vector of ``BUCKETS`` counts
and Spark adds the vectors.  The k-th largest key is found by histograms of
fixed size over narrowing ranges, not by sorting all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import text_hash, written

BUCKETS = 10_000
HELD_WORDS = 300_000
BINS = 4096
SORTED = 10_000  # rows of the last bin that are sorted
SEED = 11


class Hasher:
    """Bucket numbers of all words and neighbouring word pairs of texts."""

    def __init__(self):
        self.held: dict[bytes, int] = {}

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all n-grams, and the text that each is of."""
        if len(self.held) > HELD_WORDS:
            self.held = {}
        held, hashes, of = self.held, [], []
        for t in texts:
            words = t.encode("utf-8", "surrogatepass").lower().split() if t else []
            for w in words:
                if w not in held:
                    held[w] = xxhash.xxh32_intdigest(w, SEED)
            hashes += [held[w] for w in words]
            of.append(len(words))
        h, row = np.array(hashes, np.uint64), np.repeat(np.arange(len(of)), of)
        pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(20)
        same = row[:-1] == row[1:]
        n = np.uint64(BUCKETS)
        return np.r_[(h % n), (pair % n)[same]].astype(np.int64), np.r_[row, row[:-1][same]]


def log_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log of target over raw probability for each bucket, add-one smoothed."""
    good = labels.where("quality = 1").select(F.col("doc_id").alias("id")).distinct().withColumn("good", F.lit(True))
    # a merge join at every size: the labels grow with the corpus, so a plan that
    # broadcasts them while they are few would change its costs later
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    texts = texts.join(written(good, "target").hint("merge"), F.col("doc_id") == F.col("id"), "left")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, raw, target = Hasher(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                buckets, row = hasher(part.column(0).to_pylist())
                raw += np.bincount(buckets, minlength=BUCKETS)
                target += np.bincount(buckets[part.column(1).to_numpy(zero_copy_only=False)[row]], minlength=BUCKETS)
        k = np.flatnonzero(raw)
        yield pa.record_batch([pa.array(k), pa.array(raw[k]), pa.array(target[k])], ["k", "raw", "target"])

    parts = texts.select("text", F.coalesce("good", F.lit(False)).alias("good")).mapInArrow(count, "k long, raw long, target long")
    rows = parts.groupBy("k").agg(F.sum("raw"), F.sum("target")).collect()  # at most BUCKETS rows
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for k, a, b in rows:
        raw[k] += a
        target[k] += b
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weigh(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``doc_id``, ``log_weight`` and ``gumbel_key`` of every row."""

    def run(batches):
        hasher = Hasher()
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                buckets, row = hasher(part.column(1).to_pylist())
                # bincount gives integers where there is no word at all
                weights = np.bincount(row, ratios[buckets], part.num_rows).astype(np.float64)
                yield pa.record_batch([part.column(0), pa.array(weights), part.column(2)], ["doc_id", "log_weight", "noise"])

    # a row draws by its id and text: rows without an id, or of one id, are drawn apart
    noise = F.xxhash64(F.lit(SEED), F.col("doc_id").isNull(), "doc_id", text_hash("text"))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), noise.alias("noise"))
    u = (F.pmod("noise", F.lit(1 << 52)) + 0.5) / float(1 << 52)
    d = d.mapInArrow(run, "doc_id long, log_weight double, noise long")
    return d.select("doc_id", "log_weight", (F.col("log_weight") - F.log(-F.log(u))).alias("gumbel_key"))


def kth_largest(rows: DataFrame, key: str, tie: str, k: int) -> tuple[float, int]:
    """Key and tie of row number k in the order of falling key, rising tie
    (nulls first).  Every pass brings at most BINS counts to the driver."""
    lo, hi = rows.agg(F.min(key), F.max(key)).first()
    part = rows
    while True:
        size = part.count()
        if size <= SORTED or lo == hi:
            r = part.orderBy(F.desc(key), F.col(tie).asc_nulls_first()).limit(k).orderBy(key, F.col(tie).desc_nulls_last()).first()
            return r[key], r[tie]
        step = (hi - lo) / BINS
        bin_of = F.least(F.lit(BINS - 1), F.floor((F.col(key) - lo) / step)).cast("int")
        counts = dict(part.groupBy(bin_of.alias("b")).count().collect())
        for b in range(BINS - 1, -1, -1):
            if counts.get(b, 0) >= k:
                break
            k -= counts.get(b, 0)
        part = part.where(bin_of == b)
        lo, hi = part.agg(F.min(key), F.max(key)).first()


def resample(docs: DataFrame, labels: DataFrame, keep: float | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``log_weight``, ``gumbel_key``
    and ``kept`` (among the k largest keys).

    k is ``keep`` of all rows, rounded; by default the share of good texts
    among the labelled ones.  Null and empty texts have log weight 0; rows of
    equal id and text have equal keys (ties at the k-th are all kept), rows
    without an id draw by their text; labels without
    quality are left out, and with none all weights are 0 and half is kept; an
    empty table gives no rows; other columns are not looked at.
    """
    if keep is None:
        keep = labels.agg(F.avg(F.when(F.col("quality") == 1, 1.0).when(F.col("quality").isNotNull(), 0.0))).first()[0]
        keep = 0.5 if keep is None else keep
    rows = written(weigh(docs, log_ratios(docs, labels)), "weights")
    k = round(keep * rows.count())
    if not k:
        return rows.withColumn("kept", F.lit(False))
    key, tie = kth_largest(rows, "gumbel_key", "doc_id", k)
    at_tie = F.col("doc_id").isNull() if tie is None else F.col("doc_id").isNull() | (F.col("doc_id") <= tie)
    return rows.withColumn("kept", (F.col("gumbel_key") > key) | ((F.col("gumbel_key") == key) & at_tie))
