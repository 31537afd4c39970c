"""Document fingerprints by one-permutation MinHash.

Every word shingle is hashed once: the upper bits of the hash choose one of
``bins`` bins, and a bin keeps the smallest rest.  A bin that no shingle falls
into takes the value of the first filled bin in an order of its own (optimal
densification: the order is a seeded permutation that differs from bin to bin
and is the same for all documents, so two documents that share a share of their
shingles agree in that share of their bins, filled or not).  Of each value the
lowest ``bits`` bits are stored, packed.

Different values agree in their low bits with chance 2^-bits, so the share of
equal bins e overstates the likeness j: e = j + (1 - j) 2^-bits.  ``likeness``
takes that bias off.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions.arrays import arrow_udf
from vellum.llm.common import written

SHINGLE, BINS, BITS = 5, 512, 4
SEED = 13
HELD_WORDS = 300_000
ROWS = 256  # to a batch of results


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _orders(bins: int) -> np.ndarray:
    """For each bin (row) the rank of every bin in its own order."""
    draws = _mix(np.arange(1, bins * bins + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(bins, bins)
    return draws.argsort(axis=1).argsort(axis=1).astype(np.uint16)


class Signer:
    """Packed fingerprints of texts (UTF-8); ``bins`` is a power of 2, ``bits`` divides 8."""

    def __init__(self, shingle: int = SHINGLE, bins: int = BINS, bits: int = BITS):
        if bins & (bins - 1) or bins < 8 or bits not in (1, 2, 4, 8):
            raise ValueError("bins must be a power of 2 from 8 on, bits 1, 2, 4 or 8")
        self.shingle, self.bins, self.bits = shingle, bins, bits
        self.turns = np.arange(1, bins + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.held: dict[bytes, int] = {}

    def hashes(self, text: bytes) -> np.ndarray:
        """A 64-bit hash of each shingle of lower-cased (A-Z) words between ASCII
        white space; of all words where there are fewer."""
        if len(self.held) > HELD_WORDS:
            self.held = {}
        held, words = self.held, text.lower().split()
        for w in set(words).difference(held):
            held[w] = xxhash.xxh64_intdigest(w, SEED)
        h = np.fromiter(map(held.__getitem__, words), np.uint64, len(words))
        n = min(self.shingle, len(h))
        many = len(h) - n + 1
        s = np.full(many if n else 0, n, np.uint64)
        for i in range(n):
            s = _mix(s * np.uint64(0x9E3779B97F4A7C15) + h[i : many + i])
        return s

    def __call__(self, text: bytes) -> bytes:
        s = self.hashes(text)
        if not len(s):
            return b""
        s.sort()
        at = (s >> np.uint64(64 - self.bins.bit_length() + 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        filled, value = at[first], s[first]
        values = np.zeros(self.bins, np.uint64)
        values[filled] = value
        if len(filled) < self.bins:
            bare = np.ones(self.bins, bool)
            bare[filled] = False
            bare = np.flatnonzero(bare)
            values[bare] = values[filled[_orders(self.bins)[bare[:, None], filled].argmin(1)]]
        # hashed with the bin's number: a value borrowed by many bins has other bits in each
        low = (_mix(values + self.turns) & np.uint64((1 << self.bits) - 1)).astype(np.uint8)
        packed = np.zeros(self.bins * self.bits // 8, np.uint8)
        for i in range(8 // self.bits):
            packed |= low[i :: 8 // self.bits] << np.uint8(i * self.bits)
        return packed.tobytes()


def likeness(a: bytes, b: bytes, bits: int = BITS) -> float:
    """Estimated share of common shingles of two fingerprints, 0 to 1.  Two texts
    without words are alike, one without and one with words are not."""
    if not a or not b:
        return float(a == b)
    differs = np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)
    mask = np.uint8((1 << bits) - 1)
    equal = sum(int(np.count_nonzero((differs >> np.uint8(i) & mask) == 0)) for i in range(0, 8, bits))
    chance = 2.0**-bits
    return max(0.0, (equal / (len(a) * 8 // bits) - chance) / (1 - chance))


def likeness_of(a, b, bits: int = BITS):
    """``likeness`` of two fingerprint columns; null where one is null."""
    pairs = lambda x, y: x.combine(y, lambda p, q: None if p is None or q is None else likeness(p, q, bits))
    return arrow_udf(pairs, "double")(a, b)


def document_fingerprints(docs: DataFrame, shingle: int = SHINGLE, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``fingerprint`` (binary).

    Equal texts have equal fingerprints; null, empty and blank texts have an empty
    one; repeated rows and ids stay; an empty table gives no rows; other columns
    are not looked at.  Rows are worked on where they lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = Signer(shingle, bins, bits)
        for b in batches:
            prints = [sign(t.as_py() or b"") for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(prints, pa.binary())], ["doc_id", "fingerprint"])

    d = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    return d.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint binary")


EDITED = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _edited(sign: Signer, text: str, own: bytes, after: str, of_after: bytes, bits: int) -> tuple:
    """The columns ``EDITED`` of a text and the one after it."""
    q = len(text) // 4
    edited = (text[: len(text) - q] + after[:q]).encode()
    changed = sign(edited)
    return len(text), hashlib.sha256(edited).hexdigest(), own, changed, likeness(own, changed, bits), likeness(own, of_after, bits)


def edited_likeness(docs: DataFrame, shingle: int = SHINGLE, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Each document's fingerprint beside those of its edited text, whose last
    quarter of code points gives way to the first as many of the next document,
    and of the next document: ``doc_id`` and the columns ``EDITED``.

    The next document is the next by doc_id, null first; of equal ids by the
    text's hash; after the last comes the first (itself where there is one only).
    Null texts are empty; repeated rows follow each other; an empty table gives no
    rows; other columns are not looked at.

    Texts are sorted once, over as many ranges as the session has shuffle
    partitions; rows of one id, or without one, are spread by their text.  A task
    streams its range; only the last document of each range waits for the first
    one of the next, joined as rows that carry their texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = Signer(shingle, bins, bits)
        rows, last = [], None

        def out():
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for b in batches:
            for part, i, t in zip(*(c.to_pylist() for c in b.columns)):
                text = (t or b"").decode()
                own = sign(t or b"")
                if last is None:
                    rows.append((part, "head", i, text, len(text), None, own, None, None, None))
                else:
                    rows.append((part, "row", last[0], None, *_edited(sign, *last[1:], text, own, bits)))
                last = i, text, own
                if len(rows) >= ROWS:
                    yield out()
                    rows = []
        if last is not None:
            rows.append((part, "tail", last[0], last[1], len(last[1]), None, last[2], None, None, None))
            yield out()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = Signer(shingle, bins, bits)
        for b in batches:
            done = [(i, *_edited(sign, text, own, after, of_after, bits)) for i, text, own, after, of_after in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), [types[2], *types[4:]])], ["doc_id", *names[4:]])

    types = [pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
    names = ["part", "kind", "doc_id", "text", *[c.split()[0] for c in EDITED.split(", ")]]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col("doc_id").asc_nulls_first(), "h", "place"]
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    d = d.withColumns({"h": F.xxhash64("text"), "place": F.monotonically_increasing_id()}).repartitionByRange(n, *by).sortWithinPartitions(*by)
    d = d.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(run, f"part int, kind string, doc_id long, text string, {EDITED}")
    d = written(d, "edited")

    # two rows a range: every tail meets the head of the next range that has rows
    heads = d.where("kind = 'head'")
    line = Window.orderBy("part")
    ranges = heads.select("part").select("part", F.lead("part").over(line).alias("following"), F.min("part").over(Window.partitionBy(F.lit(0))).alias("origin"))
    ranges = ranges.select("part", F.coalesce("following", "origin").alias("of"))
    tails = d.where("kind = 'tail'").join(ranges, "part").select("of", "doc_id", "text", "fingerprint")
    heads = heads.select(F.col("part").alias("of"), F.col("text").alias("after"), F.col("fingerprint").alias("of_after"))
    ends = tails.join(heads, "of").select("doc_id", "text", "fingerprint", "after", "of_after").mapInArrow(finish, f"doc_id long, {EDITED}")
    return d.where("kind = 'row'").select(*ends.columns).unionByName(ends)
