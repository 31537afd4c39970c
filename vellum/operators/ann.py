"""Q9: approximate top-k with an inverted-file (IVF) index.

Cells are k-means centres fitted with ``pyspark.ml`` on a bounded sample of the
unit vectors; every point is stored with its cell.  ``fit_ivf`` also picks how
many cells a query probes, so that held-out queries reach a recall goal.  A query scores the centres (a literal
array of ``cells x dim`` values, bounded by ``MAX_CENTRE_VALUES``), probes its
``nprobe`` best cells, and meets only the points of those cells through the
same cogroup kernel as exact search.  Small cells are put together to regions of
bounded size, to which a query goes once whatever it probes there; large ones are
cut, so a hot cell never lands in one task.  The
answer is approximate: ``recall_at_k`` measures it against exact search.
"""

from __future__ import annotations

from dataclasses import dataclass

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from vellum.functions.arrays import arrow_udf, keep_rows, posexplode_rows
from vellum.operators import search
from vellum.session import shared_dir

MAX_CENTRE_VALUES = 4_000_000  # centres shipped as one broadcast value (checked size)
SAMPLE = 20_000  # points beside HELD_OUT queries that recall is fitted on, and the least that centres are fitted on
HELD_OUT = 256
PER_CELL = 32  # sampled points to a fitted centre
MAX_CELLS = 4096
FLAT_CELLS = 256  # more centres start from points of the sample
REGIONS = 32  # about as many regions, whatever the bucket size, while their points stay under search.POINTS_PER_BUCKET
_SCORES = 1 << 18  # centre scores of a batch of vectors at once


@dataclass
class IvfIndex:
    centres: list[list[float]]
    points: DataFrame  # point columns + ``cell`` (int)
    cell_counts: DataFrame  # cell, n


def sample_of(points: DataFrame, n: int, vector: str = "vector", point_id: str = "point_id", seed: int = 42) -> DataFrame:
    """``n`` points (all, where there are fewer) by the smallest seeded hash of their id."""
    p = points.where(F.col(vector).isNotNull()).select(point_id, vector)
    return p.orderBy(F.xxhash64(F.lit(seed), point_id), point_id).limit(n)


def held_out(sample: DataFrame, k: int, vector: str = "vector") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points, queries and the queries' exact ``k`` best points, from at most SAMPLE +
    HELD_OUT rows brought to the driver; queries are not among the points.
    Neighbours in a sample are farther off than among all points, so what finds
    them finds those of all points the sooner."""
    rows = np.array([r[0] for r in sample.select(vector).limit(SAMPLE + HELD_OUT).collect()], dtype=np.float64)
    rows = rows.reshape(len(rows), -1) if len(rows) else np.zeros((0, 0))
    n = min(HELD_OUT, len(rows) // 5)
    q, x = rows[:n], rows[n:]
    k = min(k, len(x))
    return x, q, np.argsort(-(q @ x.T), axis=1, kind="stable")[:, :k]


def fit_ivf(points: DataFrame, *, goal: float = 0.9, k: int = 5, cells: int | None = None, vector: str = "vector",
            point_id: str = "point_id", seed: int = 42, max_iter: int = 10) -> tuple[IvfIndex, int]:
    """An index and the number of cells to probe, for a recall@``k`` of ``goal``.

    Centres (4 sqrt(n) of them at most MAX_CELLS, unless ``cells`` says) are fitted
    on a sample of PER_CELL points each, SAMPLE at least; the probes are the fewest
    that reach the goal on HELD_OUT further queries.  Every point is indexed."""
    n = points.count()
    cells = cells or min(MAX_CELLS, int(4 * n**0.5), n // 4)
    if cells < 2:  # few points or none: one cell, no fit
        return open_ivf([[0.0]], points.where(F.col(vector).isNotNull()).withColumn("cell", F.lit(0))), 1
    sample = sample_of(points, max(SAMPLE, PER_CELL * cells) + HELD_OUT, vector, point_id, seed)
    shared_dir(points.sparkSession)
    sample = sample.checkpoint()
    x, q, best = held_out(sample, k, vector)
    index = build_ivf(points, cells, vector=vector, seed=seed, max_iter=max_iter, train=sample)
    if not best.size:
        return index, len(index.centres)
    c = np.array(index.centres)
    rank = np.argsort(np.argsort(-(q @ c.T), axis=1, kind="stable"), axis=1)
    need = np.sort(np.take_along_axis(rank, (x @ c.T).argmax(1)[best], axis=1), axis=None)
    return index, int(need[int(np.ceil(goal * len(need))) - 1]) + 1


def build_ivf(points: DataFrame, cells: int = 16, *, vector: str = "vector", seed: int = 42, max_iter: int = 20,
              centres: list[list[float]] | None = None, train: DataFrame | None = None) -> IvfIndex:
    """Assign every point to a cell.  The centres are given, or fitted
    (k-means|| on ``train``, by default all points; scaled to unit length).  ``points`` of the result can be written with
    ``cell`` as a partition column and searched again (``open_ivf``): a search
    then reads the probed cells only."""
    if centres is not None:
        _check_centres(centres)
        assigned = probe_cells(points.where(F.col(vector).isNotNull()), centres, 1, vector)
        return open_ivf(centres, assigned)
    from pyspark import StorageLevel

    # k-means reads its input once per iteration: keep the vectors for the fit
    # (spilling to disk when memory is short), release them afterwards
    train = (points if train is None else train).where(F.col(vector).isNotNull())
    train = train.select(array_to_vector(F.col(vector)).alias("__f"))
    start = "k-means||"
    if cells > FLAT_CELLS:
        # k-means|| clusters its candidates on the driver in a time that grows with the
        # square of the cells; and a sample stands in one partition
        start, train = "random", train.repartition(train.sparkSession.sparkContext.defaultParallelism)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = KMeans(k=cells, seed=seed, maxIter=max_iter, initMode=start, featuresCol="__f", predictionCol="cell").fit(train)
    finally:
        train.unpersist()
    fitted = [np.asarray(c, dtype=np.float64) for c in model.clusterCenters()]
    return build_ivf(points, vector=vector, centres=[(c / (np.sqrt((c**2).sum()) or 1.0)).tolist() for c in fitted])


def open_ivf(centres: list[list[float]], points: DataFrame) -> IvfIndex:
    """An index over points that carry their ``cell`` already (a stored one)."""
    return IvfIndex(centres, points, points.groupBy("cell").agg(F.count(F.lit(1)).alias("n")))


def _check_centres(centres: list[list[float]]) -> None:
    if len(centres) * len(centres[0]) > MAX_CENTRE_VALUES:
        raise ValueError("too many centre values to ship with the plan; lower `cells`")


def probe_cells(queries: DataFrame, centres: list[list[float]], nprobe: int, vector: str = "vector") -> DataFrame:
    """Each query row repeated for its ``nprobe`` centres of largest dot product
    (``cell``), ties by the lower cell number.  Products are added up component
    by component, so a near-tie falls the same way in every batch."""
    best = _probe_udf(queries.sparkSession, centres, nprobe)(F.col(vector))
    cols = [F.col(c) for c in queries.columns]
    x = queries.select(*cols, posexplode_rows(best, "__i", "cell")).where(keep_rows("__i"))
    return x.withColumn("cell", F.col("cell").cast("int")).drop("__i")


def _nearest(vectors: pd.Series, c: np.ndarray, nprobe: int):
    """Start and cells (rows x nprobe) of slices of the vectors: scores of all
    centres are held for a slice only."""
    x, step = vectors.tolist(), max(1, _SCORES // len(c))
    for lo in range(0, len(x), step):
        q = np.stack(x[lo : lo + step]).astype(np.float64)
        scores = np.zeros((len(q), c.shape[0]))
        for j in range(c.shape[1]):
            scores += q[:, j : j + 1] * c[None, :, j]
        yield lo, np.argsort(-scores, axis=1, kind="stable")[:, :nprobe].astype(np.int32)


def _probe_udf(spark, centres, nprobe):
    bc = spark.sparkContext.broadcast(np.asarray(centres, dtype=np.float64))

    def run(s: pd.Series) -> pd.Series:
        return pd.Series([row for _, near in _nearest(s, bc.value, nprobe) for row in near], dtype=object)

    return arrow_udf(run, ArrayType(IntegerType()))


def cells_asked(queries: DataFrame, centres: list[list[float]], nprobe: int, vector: str) -> dict[int, int]:
    """How many queries probe each cell (at most the number of cells come to the driver)."""
    bc = queries.sparkSession.sparkContext.broadcast(np.asarray(centres, dtype=np.float64))

    def run(batches):
        n = np.zeros(len(bc.value), np.int64)
        for b in batches:
            for _, near in _nearest(b.column(0).to_pandas(), bc.value, nprobe):
                n += np.bincount(near.ravel(), minlength=len(n))
        cell = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(cell, pa.int32()), "n": pa.array(n[cell], pa.int64())})

    found = queries.select(vector).mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    return {r["cell"]: r["n"] for r in found.collect()}


def _regions(counts: dict[int, int], per_bucket: int) -> dict[int, tuple[int, int]]:
    """First region and number of regions of each cell: cells of up to ``per_bucket``
    points are put together up to that, larger ones are cut."""
    out, region, held = {}, 0, 0
    for cell, n in sorted(counts.items()):
        pieces = math.ceil(n / per_bucket)
        if pieces > 1 or held + n > per_bucket:
            region, held = region + (held > 0), 0
        out[cell] = (region, pieces)
        if pieces > 1:
            region += pieces
        else:
            held += n
    return out


def _region_scan(q, points, centres, counts, asked, nprobe, kmax, per_query, limit, per_bucket, scored) -> DataFrame:
    """Queries and the points of their probed cells, region by region.

    A query goes to a region once, with the cells it probes there, not once for
    each cell; a region that more queries ask than ``limit`` bytes hold is met block
    by block."""
    spark = q.sparkSession
    share = math.ceil(sum(counts.values()) / REGIONS)
    place = _regions(counts, min(max(per_bucket, search.POINTS_PER_BUCKET), max(min(per_bucket, search.LEAST_PER_BUCKET), share)))
    first, pieces = np.zeros(len(centres), np.int32), np.zeros(len(centres), np.int32)
    for cell, (a, b) in place.items():
        first[cell], pieces[cell] = a, b
    asking = {}
    for cell, (a, b) in place.items():
        for r in range(a, a + b):
            asking[r] = asking.get(r, 0) + asked.get(cell, 0)
    whole = q.count()
    blocks = np.array([max(1, math.ceil(min(whole, asking[r]) * per_query / limit)) for r in range(len(asking))], np.int32)
    bc = spark.sparkContext.broadcast((np.asarray(centres, dtype=np.float64), first, pieces, blocks))

    def deal(batches):
        c, first, pieces, blocks = bc.value
        for b in batches:
            for lo, near in _nearest(b.column(vec).to_pandas(), c, nprobe):
                row, cell = np.repeat(np.arange(lo, lo + len(near)), near.shape[1]), near.ravel()
                times = pieces[cell]
                row, cell = np.repeat(row, times), np.repeat(cell, times)
                region = first[cell] + np.arange(len(cell)) - np.repeat(np.cumsum(times) - times, times)
                order = np.lexsort((cell, region, row))
                row, cell, region = row[order], cell[order], region[order]
                start = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (region[1:] != region[:-1])]) if len(row) else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[start, len(row)], pa.int32()), pa.array(cell, pa.int32()))
                sent = b.take(pa.array(row[start]))
                yield pa.RecordBatch.from_arrays([*sent.columns, pa.array(region[start], pa.int32()), pa.array(blocks[region[start]], pa.int32()), lists],
                                                 names=[*b.schema.names, "__pb", "__nqb", "__cells"])

    vec = q.columns.index("__qvec")
    schema = StructType([*q.schema.fields, StructField("__pb", IntegerType()), StructField("__nqb", IntegerType()), StructField("__cells", ArrayType(IntegerType()))])
    qx = q.mapInArrow(deal, schema).withColumn("__qb", F.pmod(F.xxhash64("__qid"), F.col("__nqb")).cast("int")).drop("__nqb")
    where = spark.createDataFrame([(c, a, b) for c, (a, b) in place.items()], "cell int, __first int, __pieces int")  # at most the number of cells
    load = spark.createDataFrame([(r, int(n)) for r, n in enumerate(blocks)], "__pb int, __nqb int")  # as many and the cuts of large cells
    px = points.join(F.broadcast(where), "cell").withColumn("__pb", (F.col("__first") + F.pmod(F.xxhash64("__pid"), F.col("__pieces"))).cast("int"))
    px = px.drop("__first", "__pieces").join(F.broadcast(load), "__pb").withColumn("__qb", F.explode(F.sequence(F.lit(0), F.col("__nqb") - 1))).drop("__nqb")
    return search._score_pairs(qx, px, ["__pb", "__qb"], kmax, scored)


def ann_topk(index: IvfIndex, queries: DataFrame, k: int = 5, *, nprobe: int = 4, threshold=None,
             point_id: str = "point_id", point_vec: str = "vector", query_id: str = "query_id",
             query_vec: str = "vector", query_filter: str | None = None, point_filter: str | None = None,
             payload: list[str] | None = None,
             broadcast_limit_bytes: int = search.DEFAULT_BROADCAST_LIMIT,
             points_per_bucket: int = search.POINTS_PER_BUCKET, scored=None) -> DataFrame:
    """Approximate ``k`` best points per query among the points of its
    ``nprobe`` closest cells; filter and threshold as in ``search.topk``, whose
    output this has.  Only points of probed cells are read."""
    if (query_filter is None) != (point_filter is None):
        raise ValueError("query_filter and point_filter go together")
    q = search._prepare_queries(queries, query_id, query_vec, k, threshold, query_filter).where("__qvec is not null")
    shared_dir(index.points.sparkSession)
    q = q.checkpoint()  # read by the size check and by the probe
    stats = q.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("__qvec")).alias("dim"), F.max("__k").alias("kmax")).first()
    n_q, dim, kmax = int(stats["n"]), int(stats["dim"] or 0), int(stats["kmax"] or 0)
    counts = {r["cell"]: r["n"] for r in index.cell_counts.collect()}  # at most the number of cells
    asked = cells_asked(q, index.centres, nprobe, "__qvec") if kmax > 0 else {}
    if not set(asked) & set(counts):
        return search.topk(index.points, queries.limit(0), k, point_id=point_id, point_vec=point_vec, query_id=query_id, query_vec=query_vec, payload=payload)
    counts = {c: n for c, n in counts.items() if c in asked}
    pcols = [search.point_key(index.points, point_id).alias("__pid"), F.col(point_vec).alias("__pvec"), "cell"]
    if point_filter is not None:
        pcols.append(F.col(point_filter).cast("string").alias("__pfilter"))
    points = index.points if len(asked) == len(index.centres) else index.points.where(F.col("cell").isin(sorted(asked)))
    p = points.select(*pcols)
    p = p.where("__pid is not null and __pvec is not null")
    per_query = max(dim, 1) * 8 + 48 + search._HIT_BYTES * kmax
    cands = _region_scan(q, p, index.centres, counts, asked, nprobe, kmax, per_query, broadcast_limit_bytes, points_per_bucket, scored)
    hits = search.final_topk(cands, kmax)
    if payload:
        small = n_q * kmax * search._HIT_BYTES <= broadcast_limit_bytes
        hits = search.attach_payload(hits, index.points, point_id, payload, proven_small=small)
    return hits


def recall_at_k(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of exact (query, point) hits that the approximate search found."""
    e = exact.select("query_id", "point_id").withColumn("__e", F.lit(1))
    a = approx.select("query_id", "point_id").withColumn("__a", F.lit(1))
    j = e.join(a, ["query_id", "point_id"], "left")
    return j.agg((F.sum(F.coalesce("__a", F.lit(0))) / F.count(F.lit(1))).alias("recall"), F.count(F.lit(1)).alias("exact_hits"))
