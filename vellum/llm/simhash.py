"""SimHash near-duplicates by anchor-point covering.

The anchors are the words of a covering code: two [23,12] Golay codes side by
side cover 46 of the 64 fingerprint bits, and every fingerprint has exactly
one anchor within radius 3 + 3 (its home).  A fingerprint is replicated to
every anchor within the covering radius plus the threshold (6 + 2 bits), so
whatever differs from a fingerprint in at most 2 of 64 bits stands at that
fingerprint's home.  Per anchor, homes are compared with all that stand there.

Rows that reach an anchor are distinct fingerprints (copies are aggregated
first), so a group of copies never weighs more than one row.  An anchor
compares all its rows while they are few; beyond ``DENSE`` rows it looks up
the at most 2,081 neighbours of each home instead, so its work stays linear.
Per anchor only a star from each member to the smallest one it reaches is
emitted, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import text_hash, written
from vellum.llm.graph import components

GOLAY = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
BITS, RADIUS = 23, 3
SEED = 42
PAIRS = 1 << 21  # compared at once in a task
DENSE = 4096  # rows of an anchor from which neighbours are looked up
LOOP = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of lower-cased (A-Z) words; no words: 0."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        ends = list(accumulate(map(len, words), lambda at, n: at + n + 1))
        starts = [0, *(e + 1 for e in ends[: len(words) - shingle])]
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :])]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), LOOP):
        octets = np.array(hashes[i : i + LOOP], np.uint64).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3, rest: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a signed long) of every row, and the
    long columns ``rest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.record_batch([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]], ["doc_id", "fp", *rest])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *rest)
    return d.mapInArrow(run, ", ".join(f"{c} long" for c in ["doc_id", "fp", *rest]))


@lru_cache(maxsize=4)
def _patterns(reach: int) -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome, the error patterns of at most ``reach`` bits (padded
    by a copy of weight 99) and their weights, lightest first."""
    lists: list[list[tuple[int, int]]] = [[] for _ in range(1 << (BITS - 12))]
    for weight in range(reach + 1):
        values = np.array([sum(1 << i for i in c) for c in combinations(range(BITS), weight)], np.int64)
        for v, s in zip(values.tolist(), _syndrome(values).tolist()):
            lists[s].append((weight, v))
    width = max(map(len, lists))
    weights = np.full((len(lists), width), 99, np.int64)
    errors = np.zeros((len(lists), width), np.int64)
    for s, found in enumerate(lists):
        weights[s, : len(found)] = [w for w, _ in found]
        errors[s, : len(found)] = [v for _, v in found]
    return errors, weights


def _syndrome(values: np.ndarray) -> np.ndarray:
    v = values.copy()
    for bit in range(BITS - 1, 10, -1):
        v ^= ((v >> bit) & 1) * (GOLAY << (bit - 11))
    return v


def anchors(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, anchor and whether it is the home, for every anchor within
    2 * RADIUS + distance bits."""
    errors, weights = _patterns(RADIUS + distance)
    low, high = fps & ((1 << BITS) - 1), (fps >> BITS) & ((1 << BITS) - 1)
    s, t = _syndrome(low), _syndrome(high)
    near = weights[s][:, :, None] + weights[t][:, None, :] <= 2 * RADIUS + distance
    row, i, j = np.nonzero(near)
    anchor = ((high[row] ^ errors[t[row], j]) << BITS) | (low[row] ^ errors[s[row], i])
    return row, anchor, (i == 0) & (j == 0)


def _linked(fp: np.ndarray, home: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (home, other) of the rows of one large anchor that are near;
    one near partner a mask, found by lookup."""
    order = np.argsort(fp)
    ordered = fp[order]
    at = np.flatnonzero(home)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for n in range(1, distance + 1):
        for bits in combinations(range(64), n):
            mask = np.array([sum(1 << b for b in bits)], np.uint64).view(np.int64)[0]
            want = fp[at] ^ mask
            k = np.minimum(np.searchsorted(ordered, want), len(ordered) - 1)
            hit = ordered[k] == want
            found.append((at[hit], order[k[hit]]))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _stars(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest position reachable over the pairs, for each of n positions."""
    label = np.arange(n)
    while True:
        m = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(anchor: np.ndarray, fp: np.ndarray, home: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (fingerprints) among the rows of whole anchors, sorted by anchor."""
    start = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    size = np.diff(np.r_[start, len(anchor)])
    group = np.repeat(np.arange(len(start)), size)
    ones, twos = [], []
    dense = size > DENSE
    for g in np.flatnonzero(dense):
        part = slice(start[g], start[g] + size[g])
        a, b = _linked(fp[part], home[part], distance)
        ones.append(a + start[g])
        twos.append(b + start[g])
    rows = np.flatnonzero(home & ~dense[group] & (size[group] > 1))
    total = np.cumsum(size[group[rows]])
    for lo in range(0, int(total[-1]) if len(total) else 0, PAIRS):
        some = rows[np.searchsorted(total, lo, "right") : np.searchsorted(total, lo + PAIRS, "right")]
        n = size[group[some]]
        a = np.repeat(some, n)
        b = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[group[some]], n)
        # as unsigned: of signed integers, bitwise_count takes the absolute value
        d = np.bitwise_count((fp[a] ^ fp[b]).view(np.uint64))
        near = (d <= distance) & (d > 0)
        ones.append(a[near])
        twos.append(b[near])
    if not ones or not sum(map(len, ones)):
        return fp[:0], fp[:0]
    a, b = np.concatenate(ones), np.concatenate(twos)
    label = _stars(a, b, len(fp))
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def near_links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Edges ``a``, ``b`` that connect exactly the fingerprints connected by
    links of at most ``distance`` bits.  ``fps``: distinct values ``fp``."""

    def replicate(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy()
            for i in range(0, len(fp), 2048):
                some = fp[i : i + 2048]
                row, anchor, home = anchors(some, distance)
                yield pa.record_batch([pa.array(anchor), pa.array(some[row]), pa.array(home)], ["anchor", "fp", "home"])

    def compare(batches):
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]

        def out(cols):
            a, b = _compare(*cols, distance)
            return pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            new = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)]
            held = [np.concatenate(x) for x in zip(held, new)]
            whole = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if whole >= 1 << 16:
                yield out([x[:whole] for x in held])
                held = [x[whole:] for x in held]
        if len(held[0]):
            yield out(held)

    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = fps.select("fp").mapInArrow(replicate, "anchor long, fp long, home boolean")
    return placed.repartition(n, "anchor").sortWithinPartitions("anchor", "fp").mapInArrow(compare, "a long, b long")


def _classes(f: DataFrame, rep: Column, distance: int) -> DataFrame:
    """``fp``, ``rep`` (of its rows) and ``class``: equal for linked fingerprints."""
    classes = written(f.groupBy("fp").agg(rep.alias("rep")), "classes")
    links = near_links(classes, distance)
    nodes = components(links, "a", "b")
    return classes.join(nodes, classes.fp == nodes.node, "left").select("fp", "rep", F.coalesce("component", "fp").alias("class"))


def simhash_groups(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row per input row: ``doc_id``, ``fp`` and ``component_id`` (smallest
    doc_id reachable over links of at most ``distance`` differing bits).

    Null and empty texts have fingerprint 0 and link like any other; repeated
    rows stay repeated; other columns are not looked at; an empty table gives
    an empty result; a row whose doc_id is null takes part in its group.
    """
    f = written(fingerprints(docs, shingle), "fingerprints")
    known = written(_classes(f, F.min("doc_id"), distance), "known")
    smallest = known.groupBy("class").agg(F.min("rep").alias("component_id"))
    of = known.join(smallest, "class").select("fp", "component_id")
    return f.join(of, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` with one row of each group: the smallest doc_id, a null one only
    where the group has no other.  Rows are told apart by doc_id and text, so
    different texts of one doc_id, or without one, each stand in their own
    group; of equal rows one stays.  Columns as they are."""
    h = text_hash("text")
    f = fingerprints(docs.select("doc_id", "text", h.alias("h")), shingle, ("h",))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h"))
    kept = _classes(f, least, distance).groupBy("class").agg(F.min("rep").alias("r"))
    kept = kept.select(F.col("r.doc_id").alias("__id"), F.col("r.h").alias("__g"))
    d = docs.withColumns({"__key": F.col("doc_id").cast("long"), "__h": h})
    d = d.join(kept, F.col("__key").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__g")), "left_semi")
    # of rows with one id and text the first by all columns that can be ordered
    first = F.struct(*[c for c, t in docs.dtypes if "map<" not in t and "variant" not in t])
    return d.groupBy("__key", "__h").agg(F.min_by(F.struct(*docs.columns), first).alias("__r")).select("__r.*")
