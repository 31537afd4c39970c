"""Embedding near-duplicates by spherical-cap filters.

The filter directions are a structured random product code: the dimensions
are cut into two halves, each with its own seeded set of random unit
directions, and a filter is one direction of each.  A vector's cap is as high
as leaves ``CAPS`` filter directions over it, and it is list-decoded to all of
those: the directions of each half are ranked by product, and only the pairs
of ranks (i, j) with i * j <= CAPS can be among the best.  Vectors of one label
that share a filter are compared in double precision.  Of isotropic pairs at
cosine 0.981, over 0.999 share one (tested); closer pairs share more.  The number of
filters grows with the largest label by one rule, so the expected rows of a
filter stay the same.

Exact copies are aggregated first.  A filter with many rows is cut into
pieces, compared piece against piece.  A pair that shares several filters is
counted at the smallest of them only, so degrees are sums of per-filter
counts and no pair is ever emitted; connectivity leaves each task as stars.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import written
from vellum.llm.graph import components

CAPS = 16  # filter directions over a vector's cap
ROWS = 16  # rows of an average filter of the largest label
PIECE = 512  # rows of a filter compared in one block
SEED = 7


def directions(dim: int, per_half: int) -> list[np.ndarray]:
    """Unit directions of both halves, scaled so that a product direction has norm 1."""
    rng = np.random.default_rng(SEED)
    out = []
    for size in (dim - dim // 2, dim // 2):
        g = rng.standard_normal((per_half, size))
        out.append(g / np.maximum(np.linalg.norm(g, axis=1, keepdims=True), 1e-300) * np.sqrt(size / dim))
    return out


def decode(unit: np.ndarray, codes: list[np.ndarray], caps: int) -> np.ndarray:
    """For each row the numbers of its ``caps`` filters of largest product."""
    per_half, half = len(codes[0]), codes[0].shape[1]
    caps = min(caps, per_half**2)
    rank = np.arange(1, per_half + 1)
    i, j = np.nonzero(np.multiply.outer(rank, rank) <= caps)
    a, b = unit[:, :half] @ codes[0].T, unit[:, half:] @ codes[1].T
    best_a, best_b = np.argsort(-a, axis=1, kind="stable")[:, i], np.argsort(-b, axis=1, kind="stable")[:, j]
    sums = np.take_along_axis(a, best_a, 1) + np.take_along_axis(b, best_b, 1)
    top = np.argsort(-sums, axis=1, kind="stable")[:, :caps]
    return np.take_along_axis(best_a * per_half + best_b, top, 1)


def _star(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    label = np.arange(n)
    while True:
        new = label.copy()
        m = np.minimum(label[a], label[b])
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of row pairs, each product summed in the same order."""
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))


def compare(rep, copies, piece, across: bool, this: int, lists, x, least: float):
    """Links within one piece pair of one filter (rows in order of ``rep``):
    for each row with any, the number of rows it links to, copies included
    (pairs counted at their smallest common filter only), and its star."""
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    a, b = np.nonzero(np.triu(unit @ unit.T >= least - 1e-9, 1))
    if across:  # rows of one piece meet elsewhere
        apart = piece[a] != piece[b]
        a, b = a[apart], b[apart]
    near = _exact(x[a], x[b]) >= least
    a, b = a[near], b[near]
    if not len(a):
        return None
    used = np.unique(np.r_[a, b])
    smaller = {i: lists[i][lists[i] < this] for i in used.tolist()}
    names = np.unique(np.concatenate(list(smaller.values())))
    first = np.ones(len(a), bool)
    if len(names):
        member = np.zeros((len(rep), len(names)), np.float32)
        for i, mine in smaller.items():
            member[i, np.searchsorted(names, mine)] = 1
        first = (member @ member.T)[a, b] == 0
    n = np.bincount(a[first], copies[b[first]], len(rep)) + np.bincount(b[first], copies[a[first]], len(rep))
    return rep[used], n[used].astype(np.int64), rep[_star(a, b, len(rep))[used]]


def _groups(batches, least: float):
    """Batches sorted by key (``g``: label, dim, filter and piece pair) -> links."""
    held = None
    for batch in (*batches, None):
        last = batch is None
        if not last:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
        if held is None or not held.num_rows:
            continue
        g = held.column("g").combine_chunks().to_numpy(zero_copy_only=False)
        start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        end = np.r_[start[1:], len(g)]
        if not last:
            start, end = start[:-1], end[:-1]
        if not len(start):
            continue
        part = held.slice(0, int(end[-1])).combine_chunks()
        held = held.slice(int(end[-1]))
        flat = lambda name: part.column(name).combine_chunks()
        vectors, filters = flat("vector"), flat("filters")
        v_at, f_at = vectors.offsets.to_numpy(), filters.offsets.to_numpy()
        v, f = vectors.values.to_numpy(), filters.values.to_numpy()
        rep, copies, piece, lo, hi, this = (flat(c).to_numpy() for c in ("rep", "copies", "piece", "lo", "hi", "filter"))
        out = []
        for s, e in zip(start.tolist(), end.tolist()):
            if e - s > 1:
                x = v[v_at[s] : v_at[e]].reshape(e - s, -1)
                lists = [f[f_at[i] : f_at[i + 1]] for i in range(s, e)]
                found = compare(rep[s:e], copies[s:e], piece[s:e], lo[s] != hi[s], this[s], lists, x, least)
                if found:
                    out.append(found)
        if out:
            yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], ["rep", "n", "to"])


def near_vectors(vectors: DataFrame, least: float = 0.98, caps: int = CAPS) -> DataFrame:
    """One row per input row: ``vec_id``, ``n_links`` (other rows linked
    directly), ``component_id`` (smallest vec_id reachable) and ``kept``.

    Rows link when their labels are equal and not null and their cosine is
    ``least`` or more.  Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, nor do vectors of different
    length; repeated rows are copies of each other; an empty table gives an
    empty result; other columns are not looked at.
    """
    spark = vectors.sparkSession
    v = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
        F.col("label").alias("label"),
    )
    finite = ~F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = F.coalesce(
        F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda c: c != 0), F.lit(False)
    )
    # +0.0: both zeros become one value
    v = written(v.withColumn("usable", usable).withColumn("vector", F.when(F.col("usable"), F.transform("vector", lambda c: c + F.lit(0.0)))), "vectors")
    classes = written(
        v.where("usable").groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vector-classes"
    )
    sizes = classes.groupBy("label", F.size("vector").alias("dim")).count().agg(F.max("count"), F.max("dim")).first()
    most = int(sizes[0] or 1)
    per_half = max(2, int(np.ceil(np.sqrt(most * caps / ROWS))))

    def place(batches):
        codes: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                b = batch.slice(i, 1024)
                dims = b.column("vector").value_lengths().to_numpy()
                for dim in np.unique(dims).tolist():
                    part = b.filter(pa.array(dims == dim))
                    x = part.column("vector").flatten().to_numpy().reshape(-1, dim)
                    scale = np.abs(x).max(1, keepdims=True)
                    x = x / scale
                    unit = x / np.sqrt((x * x).sum(1, keepdims=True))
                    if dim not in codes:
                        codes[dim] = directions(dim, per_half)
                    filt = np.sort(decode(unit, codes[dim], caps), axis=1)
                    ends = np.arange(part.num_rows + 1, dtype=np.int32) * filt.shape[1]
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(filt.ravel()))
                    yield pa.record_batch([part.column("label"), pa.array(np.full(part.num_rows, dim, np.int32)), part.column("rep"), lists], ["label", "dim", "rep", "filters"])

    label = dict(classes.dtypes)["label"]
    placed = written(
        classes.select("label", "rep", "vector").mapInArrow(place, f"label {label}, dim int, rep long, filters array<long>"), "filters"
    )
    members = placed.select("label", "dim", "rep", F.explode("filters").alias("filter"))
    # a filter of many rows is cut into pieces of about PIECE rows; piece pairs are compared
    counts = members.groupBy("label", "dim", "filter").count().where("count > 1").withColumn("pieces", F.ceil(F.col("count") / PIECE).cast("int"))
    cut = members.join(counts, ["label", "dim", "filter"]).withColumn("piece", F.pmod(F.xxhash64("rep"), F.col("pieces")).cast("int"))
    paired = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(
        "label", "filter", "rep", "piece", F.least("piece", "other").alias("lo"), F.greatest("piece", "other").alias("hi")
    )
    full = paired.join(placed.select("rep", "filters"), "rep").join(classes.select("rep", "vector", "copies"), "rep")
    key = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in (F.size("vector"), "filter", "lo", "hi", "label")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = written(
        full.select(F.concat_ws("/", *key).alias("g"), "rep", "copies", "piece", "lo", "hi", "filter", "filters", "vector")
        .repartition(n, "g").sortWithinPartitions("g", "rep")
        .mapInArrow(lambda batches: _groups(batches, least), "rep long, n long, to long"),
        "vector-links",
    )
    degree = found.groupBy("rep").agg(F.sum("n").alias("n"))
    nodes = components(found, "rep", "to")
    known = (
        classes.join(degree, "rep", "left").join(nodes, classes.rep == nodes.node, "left")
        .select("label", "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    out = v.where("usable").join(known, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = v.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
