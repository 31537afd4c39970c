"""Similarity search: filtered, thresholded top-k by cosine (Q1-Q8).

Exact top-k is a block scan, never a row-pair join:

* **Broadcast path** - when the query side is proven small (row count x
  dimension under ``broadcast_limit_bytes``), the query matrix travels as one
  broadcast value and every points partition scores itself with numpy inside
  ``mapInPandas``.  Points are read in place (no shuffle); each task keeps a
  running top-k per query, so at most ``tasks x queries x k`` candidates are
  shuffled to the final per-query window.
* **Block path** - beyond that size queries are hashed into query blocks, each
  under the limit, and points into point buckets of bounded size; the two sides
  meet with ``cogroup`` on ``(query_block, point_bucket)`` and each group runs the
  same numpy kernel.  No task ever holds more than one query block and one
  point bucket, both of a size that doesn't depend on the tables.
* **Routed path** - beyond it, queries with a filter value meet only the points
  of that value, dealt together by the value; only queries without one take the
  block path.

Within a task a query with a filter meets the points of its value only, and for
many queries a batch of points is parted into cells that are left out where
their upper bound is below a query's k-th score (see ``_Scorer``).

All paths share one kernel that ranks by sums of a fixed order, so they return
identical rows however the points are split.  Ties in score are broken by the
smaller point id; a threshold keeps scores equal to it.  Rows with a null
vector or id are not searched; vectors of another size raise an error.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.functions.text import preview, strip_ws
from vellum.session import shared_dir

DEFAULT_BROADCAST_LIMIT = 32 << 20  # bytes of queries (a query block) that a task holds
POINTS_PER_BUCKET = 1 << 15  # block path: points per cogroup bucket
LEAST_PER_BUCKET = 1 << 12  # buckets are made smaller, down to this, where there are too few for the cores
_TILE, _TILE_ROWS = 1 << 19, 1024  # score-matrix entries, and queries, scored at once inside a task
_NO_FILTER = -1
_NO_MATCH = -2
_SCORE_ROWS = 1 << 12  # candidate pairs scored again at once
_FEW_PAIRS = 256  # of a filter value: scored one by one, without a matrix product
_PAIRS = 1 << 16  # such pairs listed at once
_HIT_BYTES = 64  # of a candidate or hit row, at most
BOUND_QUERIES, BOUND_POINTS = 64, 1024  # from which a batch of points is parted into cells
BOUND_GAIN = 0.8  # share of the pairs that cells may leave to be scored


# ---------------------------------------------------------------- numpy kernel

def _sums(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Dot product of the rows ``i`` of ``a`` and ``j`` of ``b``, added up component by
    component: the same bits for a pair wherever and with whatever else it is scored."""
    out = np.zeros(len(i))
    for lo in range(0, len(i), _SCORE_ROWS):
        if a.shape[1]:
            x = a[i[lo : lo + _SCORE_ROWS]].astype(np.float64) * b[j[lo : lo + _SCORE_ROWS]]
            out[lo : lo + _SCORE_ROWS] = np.cumsum(x, axis=1)[:, -1]
    return out


def _ids(col: pd.Series) -> np.ndarray:
    return col.to_numpy(np.int64) if col.dtype != object else np.array(col.tolist(), dtype=str).astype(object)


def _matrix(col: pd.Series, size: int | None = None) -> np.ndarray:
    """Vectors as rows: of 32 bits where they came so, else of 64."""
    rows = [np.asarray(v) for v in col.tolist()]
    sizes = {len(v) for v in rows}
    if size is not None and rows and sizes != {size} or len(sizes) > 1:
        raise ValueError(f"vectors of one search must have one size; found {sorted(sizes | ({size} if size is not None else set()))}")
    if not rows:
        return np.zeros((0, size or 0), np.float32)
    out = np.concatenate(rows).reshape(len(rows), -1) if len(rows[0]) else np.zeros((len(rows), 0), np.float32)
    return out if out.dtype == np.float32 else out.astype(np.float64)


def _norms(mat: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(mat, dtype=np.float64).sum(1))


class _Best:
    """The best k (score, id) of every query row so far; ties by smaller id.
    ``once``: a pair may be added several times and counts once."""

    def __init__(self, k: int, rows: int, once: bool = False):
        self.k, self.once, self.n, self.id = k, once, np.zeros(rows, np.int64), None
        self.score = np.zeros((rows, k))
        self.kth = np.full(rows, -np.inf)  # score of each row's k-th, once it has k

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(row):
            return
        if self.id is None:
            self.id = np.zeros(self.score.shape, ids.dtype)
        rows = np.unique(row)
        held = np.arange(self.k) < self.n[rows][:, None]
        row, score = np.r_[np.repeat(rows, self.n[rows]), row], np.r_[self.score[rows][held], score]
        ids = np.concatenate([self.id[rows][held], ids])
        order = np.lexsort((ids if ids.dtype != object else ids.astype(str), -score, row))
        row, score, ids = row[order], score[order], ids[order]
        if self.once:
            new = np.r_[True, (row[1:] != row[:-1]) | (ids[1:] != ids[:-1])]
            row, score, ids = row[new], score[new], ids[new]
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        many = np.diff(np.r_[first, len(row)])
        at = np.arange(len(row)) - np.repeat(first, many)
        keep = at < self.k
        self.score[row[keep], at[keep]], self.id[row[keep], at[keep]] = score[keep], ids[keep]
        self.n[rows] = np.minimum(many, self.k)
        full = rows[many >= self.k]
        self.kth[full] = self.score[full, self.k - 1]


class _QueryBlock:
    """Query matrix plus per-query k, threshold, filter code and probed cells or buckets."""

    def __init__(self, pdf: pd.DataFrame, kmax: int):
        self.ids = pdf["__qid"].to_numpy(np.int64)
        self.mat = _matrix(pdf["__qvec"])
        self.norm = _norms(self.mat)
        self.k = pdf["__k"].to_numpy(np.int64)
        thr = pdf["__thr"].to_numpy(np.float64, na_value=np.nan)
        self.thr = np.where(np.isnan(thr), -np.inf, thr)
        self.kmax = kmax
        if "__qfilter" in pdf.columns:
            # filter values are coded from this block's own queries (no driver-side dictionary)
            vals = [None if v is None or (isinstance(v, float) and math.isnan(v)) else v for v in pdf["__qfilter"].tolist()]
            self.codes = {v: i for i, v in enumerate(sorted({v for v in vals if v is not None}))}
            self.fcode = np.array([_NO_FILTER if v is None else self.codes[v] for v in vals], dtype=np.int64)
        else:
            self.codes, self.fcode = None, None
        # a list of cells of any length, or the same number of buckets of each table
        self.cells = pdf["__cells"].tolist() if "__cells" in pdf.columns else None
        self.keys = _whole(pdf["__keys"]) if "__keys" in pdf.columns else None


def _whole(col: pd.Series) -> np.ndarray:
    rows = col.tolist()
    return np.concatenate(rows).reshape(len(rows), -1) if rows else np.zeros((0, 0), np.int64)


class _Scorer:
    """Running top-k of a query block over batches of points.

    A matrix product, whose last bits depend on its shape, only picks
    candidates: everything within its rounding error of the k-th score or the
    threshold.  Those are scored again by ``_sums`` and ranked by that.  The product
    is made tile by tile, so what a task holds doesn't depend on the batch.

    A query with a filter meets only the points of its value, one with cells or
    buckets the points that share one.  A batch for many queries without any is
    parted into cells around some of its own points; by the largest distance r from
    a cell's centre c no point x of it has q.x > q.c + |q| r, and a cell whose bound
    is below a query's k-th score so far (or threshold) is left out.  A task in
    which that saves little stops trying.
    """

    def __init__(self, qb: _QueryBlock, scored=None):
        self.qb, self.scored, self.wide = qb, scored, None
        self.best = _Best(qb.kmax, len(qb.ids), once=qb.keys is not None)
        self.free = np.arange(len(qb.ids)) if qb.fcode is None else np.flatnonzero(qb.fcode == _NO_FILTER)
        self.bounds = len(self.free) >= BOUND_QUERIES
        if qb.fcode is not None:
            self.of_code = np.argsort(qb.fcode, kind="stable")
            self.code_edges = np.searchsorted(qb.fcode[self.of_code], np.arange(len(qb.codes) + 1))

    def batch(self, b: pd.DataFrame) -> None:
        self.pids, self.pmat = _ids(b["__pid"]), _matrix(b["__pvec"], self.qb.mat.shape[1])
        self._measure()
        codes = None
        if self.qb.codes:
            codes = np.array([self.qb.codes.get(v, _NO_MATCH) for v in b["__pfilter"].tolist()], dtype=np.int64)
        if self.qb.cells is not None:
            self._cells_met(b["cell"].to_numpy(np.int64), codes)
        elif self.qb.keys is not None:
            self._buckets_met(_whole(b["__keys"]))
        else:
            if len(self.free):
                if self.bounds and len(self.pids) >= BOUND_POINTS:
                    self._by_cell()
                else:
                    self._meet(self.free, np.arange(len(self.pids)))
            if codes is not None:
                self._values_met(codes)

    def _measure(self) -> None:
        """Precision of the product and its rounding error, for this batch."""
        qb, norm = self.qb, _norms(self.pmat)
        finite = norm[np.isfinite(norm)]
        long = finite.max() if len(finite) else 0.0
        self.strange = len(finite) < len(norm) or not np.isfinite(qb.norm).all()
        most = qb.norm[np.isfinite(qb.norm)].max(initial=0.0)
        kind = np.float32 if qb.mat.dtype == self.pmat.dtype == np.float32 and most < 1e18 and long < 1e18 else np.float64
        if kind == qb.mat.dtype:
            self.q = qb.mat
        else:  # made once
            self.wide = self.q = qb.mat.astype(np.float64) if self.wide is None else self.wide
        self.p = self.pmat if self.pmat.dtype == kind else self.pmat.astype(kind)
        with np.errstate(invalid="ignore"):
            self.error = (self.pmat.shape[1] + 2) * (4 * np.finfo(kind).eps * qb.norm * long + np.finfo(kind).tiny)

    def _meet(self, rows: np.ndarray, cols: np.ndarray) -> None:
        """The queries ``rows`` against the points ``cols`` of the batch."""
        qb, k, n = self.qb, self.qb.kmax, len(cols)
        if not n:
            return
        if self.scored is not None:
            self.scored.add(len(rows) * n)
        p = self.p if n == len(self.p) else self.p[cols]
        step = max(_TILE_ROWS, _TILE // max(n, 64))
        for lo in range(0, len(rows), step):
            some, at, w = rows[lo : lo + step], 0, max(64, _TILE // (4 * step))
            q, error = self.q[some], self.error[some]
            while at < n:  # the first tiles are narrow: their k-th scores spare the others candidates
                s = q @ p[at : at + w].T
                if self.strange:  # not a number would sort last, as the best
                    s[~np.isfinite(s)] = -np.inf
                least = self._least(np.maximum(qb.thr[some], self.best.kth[some]), error, s.dtype)
                hit = s >= least[:, None]
                many = np.count_nonzero(hit)
                if many > 4 * k * len(some) and s.shape[1] > k:
                    kth = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k].astype(np.float64)
                    hit = s >= np.maximum(least, self._least(kth, error, s.dtype))[:, None]
                    many = 1
                if self.strange:
                    hit &= s > -np.inf
                if many:
                    r, c = np.divmod(np.flatnonzero(hit), s.shape[1])
                    self._add(some[r], cols[at + c])
                at += w
                w = min(2 * w, max(64, _TILE // step))

    @staticmethod
    def _least(score: np.ndarray, error: np.ndarray, kind) -> np.ndarray:
        """Below it a product can't belong to that score."""
        return np.nextafter((score - 2 * error).astype(kind), kind.type(-np.inf))

    def _add(self, r: np.ndarray, c: np.ndarray) -> None:
        """Scores pairs of query row and point as they are ranked."""
        exact = _sums(self.qb.mat, r, self.pmat, c)
        keep = (exact >= self.qb.thr[r]) & (exact >= self.best.kth[r])
        self.best.add(r[keep], exact[keep], self.pids[c[keep]])

    def _values_met(self, codes: np.ndarray) -> None:
        """Queries with a filter against the points of their value."""
        order = np.argsort(codes, kind="stable")
        order = order[np.searchsorted(codes[order], 0) :]
        if not len(order):
            return
        first = np.flatnonzero(np.r_[True, np.diff(codes[order]) > 0])
        points, value = np.diff(np.r_[first, len(order)]), codes[order[first]]
        asked = np.diff(self.code_edges)[value]
        few = points * asked <= _FEW_PAIRS
        for i in np.flatnonzero(~few):
            self._meet(self.of_code[self.code_edges[value[i]] : self.code_edges[value[i] + 1]], order[first[i] : first[i] + points[i]])
        point = np.repeat(few, points)
        cols, times, lo = order[point], np.repeat(asked, points)[point], np.repeat(self.code_edges[value], points)[point]
        if self.scored is not None:
            self.scored.add(int(times.sum()))
        ends = np.cumsum(times)
        for a, b in _spans(ends, _PAIRS):
            t = times[a:b]
            within = np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t)
            r, c = self.of_code[np.repeat(lo[a:b], t) + within], np.repeat(cols[a:b], t)
            exact = _sums(self.qb.mat, r, self.pmat, c)
            keep = (exact >= self.qb.thr[r]) & np.isfinite(exact)
            self.best.add(r[keep], exact[keep], self.pids[c[keep]])

    def _keyed(self, row: np.ndarray, key: np.ndarray, point: np.ndarray, of_point: np.ndarray) -> None:
        """Queries ``row`` with ``key`` against the points ``point`` with the key ``of_point``."""
        qo, po = np.argsort(key, kind="stable"), np.argsort(of_point, kind="stable")
        key, of_point = key[qo], of_point[po]
        for x in np.intersect1d(key, of_point):
            a, b = np.searchsorted(key, [x, x + 1])
            c, d = np.searchsorted(of_point, [x, x + 1])
            self._meet(row[qo[a:b]], point[po[c:d]])

    def _cells_met(self, cell: np.ndarray, codes: np.ndarray | None) -> None:
        rows = np.repeat(np.arange(len(self.qb.cells)), [len(c) for c in self.qb.cells])
        probed = np.concatenate(self.qb.cells).astype(np.int64)
        free = np.ones(len(rows), bool) if self.qb.fcode is None else self.qb.fcode[rows] == _NO_FILTER
        every = np.arange(len(cell))
        self._keyed(rows[free], probed[free], every, cell)
        if codes is not None:
            n, known, own = len(self.qb.codes), codes >= 0, ~free
            self._keyed(rows[own], probed[own] * n + self.qb.fcode[rows[own]], every[known], cell[known] * n + codes[known])

    def _buckets_met(self, own: np.ndarray) -> None:
        """``own``: each point's bucket in every table; the queries probe as many of each."""
        probes = self.qb.keys.shape[1] // own.shape[1]
        rows, every = np.repeat(np.arange(len(self.qb.ids)), probes), np.arange(len(own))
        for t in range(own.shape[1]):
            self._keyed(rows, self.qb.keys[:, t * probes : (t + 1) * probes].ravel().astype(np.int64), every, own[:, t].astype(np.int64))

    def _by_cell(self) -> None:
        qb, rows, total = self.qb, self.free, len(self.pids)
        n = int(math.sqrt(total))
        centres = self.pmat[np.linspace(0, total - 1, n).astype(int)].astype(np.float64)
        size = (centres**2).sum(1)[None, :]
        cell, apart = np.zeros(total, np.int64), np.zeros(total)
        for lo in range(0, total, max(1, _TILE // n)):
            some = slice(lo, lo + max(1, _TILE // n))
            x = self.pmat[some].astype(np.float64)
            cell[some] = (size - 2 * (x @ centres.T)).argmin(1)
            apart[some] = np.sqrt(((x - centres[cell[some]]) ** 2).sum(1))
        order = np.argsort(cell, kind="stable")
        edges = np.searchsorted(cell[order], np.arange(n + 1))
        radius = np.array([apart[order[a:b]].max() if a < b else -np.inf for a, b in zip(edges, edges[1:])])
        count = np.diff(edges)
        step = max(1, _TILE // n)
        for lo in range(0, len(rows), step):
            some = rows[lo : lo + step]
            near = qb.mat[some].astype(np.float64) @ centres.T
            bound = near + qb.norm[some][:, None] * radius * (1 + 1e-9)
            # a query's own cell tells how good the others must be
            home = near.argmax(1)[:, None] == np.arange(n)
            self._cells(some, home, order, edges)
            least = np.maximum(qb.thr[some], self.best.kth[some]) - 4 * self.error[some]
            open_ = ~(bound < least[:, None]) & ~home
            if (open_ @ count).sum() > BOUND_GAIN * len(some) * total:
                self.bounds = False
                self._cells(some, ~home, order, edges)
                self._meet(rows[lo + step :], np.arange(total))
                return
            self._cells(some, open_, order, edges)

    def _cells(self, some, which, order, edges) -> None:
        """The queries ``some`` against the cells that ``which`` marks for each."""
        for c in np.flatnonzero(which.any(0) & (np.diff(edges) > 0)).tolist():
            self._meet(some[which[:, c]], order[edges[c] : edges[c + 1]])


def _spans(ends: np.ndarray, most: int):
    """Ranges of rows with about ``most`` items each, by their running total."""
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield a, b
        a = b


def _score_partition(qb: _QueryBlock, batches, scored=None) -> _Best:
    """Running top-k for every query over an iterator of point batches."""
    scorer = _Scorer(qb, scored)
    if len(qb.ids):
        for b in batches:
            if len(b):
                scorer.batch(b)
    return scorer.best


def _emit(qb: _QueryBlock, best: _Best) -> pd.DataFrame:
    row, at = np.nonzero(np.arange(best.k) < best.n[:, None])
    ids = best.id[row, at] if best.id is not None else np.zeros(0, object)  # of either kind
    return pd.DataFrame({"query_id": qb.ids[row], "point_id": ids, "score": best.score[row, at], "k": qb.k[row].astype(np.int32)})


def _cand_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", T.LongType()),
            T.StructField("point_id", id_type),
            T.StructField("score", T.DoubleType()),
            T.StructField("k", T.IntegerType()),
        ]
    )


def point_key(points: DataFrame, point_id: str) -> Column:
    """The point id as searched: strings (random ids) as they are, numbers as bigint."""
    return F.col(point_id) if points.schema[point_id].dataType == T.StringType() else F.col(point_id).cast("bigint")


# ---------------------------------------------------------------- Spark plans

def _as_col(v, default) -> Column:
    if v is None:
        return F.lit(default)
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        return F.col(v)
    return F.lit(v)


def _prepare_queries(queries, query_id, query_vec, k, threshold, query_filter):
    cols = [
        F.col(query_id).cast("bigint").alias("__qid"),
        F.col(query_vec).alias("__qvec"),
        _as_col(k, 5).cast("int").alias("__k"),
        _as_col(threshold, None).cast("double").alias("__thr"),
    ]
    if query_filter is not None:
        cols.append(_as_col(query_filter, None).cast("string").alias("__qfilter"))
    return queries.select(*cols)


def topk(
    points: DataFrame,
    queries: DataFrame,
    k: int | str | Column = 5,
    *,
    threshold: float | str | Column | None = None,
    point_id: str = "point_id",
    point_vec: str = "vector",
    query_id: str = "query_id",
    query_vec: str = "vector",
    query_filter: str | Column | None = None,
    point_filter: str | None = None,
    payload: list[str] | None = None,
    broadcast_limit_bytes: int = DEFAULT_BROADCAST_LIMIT,
    points_per_bucket: int = POINTS_PER_BUCKET,
    scored=None,
) -> DataFrame:
    """Q1 (+Q2, Q3): the ``k`` best points per query by dot product.

    ``k``, ``threshold`` and ``query_filter`` may be per-query columns.  A
    query filter value keeps only points whose ``point_filter`` column equals
    it (null = no filter) and is applied *before* the ranking; the threshold
    keeps ``score >= threshold``.  Output: ``query_id, rank, score, point_id``
    plus the ``payload`` columns of the point.  ``scored`` (an accumulator of the
    Spark context) counts the pairs of query and point that are scored.
    """
    if (query_filter is None) != (point_filter is None):
        raise ValueError("query_filter and point_filter go together")
    q = _prepare_queries(queries, query_id, query_vec, k, threshold, query_filter).where("__qvec is not null")
    # the query side is read by the size check and by the scan: encode it once
    shared_dir(points.sparkSession)
    q = q.checkpoint()
    stats = q.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.size("__qvec")).alias("dim"),
        F.max("__k").alias("kmax"),
        (F.max(F.octet_length("__qfilter")) if query_filter is not None else F.lit(0)).alias("filter"),
    ).first()
    n_q, dim, kmax = int(stats["n"]), int(stats["dim"] or 0), int(stats["kmax"] or 0)
    spark = points.sparkSession
    key = point_key(points, point_id)
    if n_q == 0 or kmax <= 0:
        none = points.select(F.lit(0).cast("bigint").alias("query_id"), F.lit(0).alias("rank"), F.lit(0.0).alias("score"), key.alias("point_id"),
                             *[c for c in payload or [] if c != point_id])
        return none.limit(0)

    pcols = [key.alias("__pid"), F.col(point_vec).alias("__pvec")]
    if point_filter is not None:
        pcols.append(F.col(point_filter).cast("string").alias("__pfilter"))
    p = points.select(*pcols).where("__pid is not null and __pvec is not null")

    # what every task holds: the queries, their filters and the running best k
    block_bytes = n_q * (max(dim, 1) * 8 + 48 + int(stats["filter"] or 0) + _HIT_BYTES * kmax)
    if block_bytes <= broadcast_limit_bytes:
        cands = _broadcast_scan(spark, q, p, kmax, scored)
    elif query_filter is None:
        cands = _block_scan(q, p, kmax, block_bytes, broadcast_limit_bytes, points_per_bucket, scored=scored)
    else:
        per_query = block_bytes / n_q
        cands = _routed_scan(q.where("__qfilter is not null"), p, kmax, per_query, broadcast_limit_bytes, points_per_bucket, scored)
        free = q.where("__qfilter is null").drop("__qfilter")
        n_free = free.count()
        if n_free and n_free * per_query <= broadcast_limit_bytes:
            cands = cands.unionByName(_broadcast_scan(spark, free, p.drop("__pfilter"), kmax, scored))
        elif n_free:
            cands = cands.unionByName(_block_scan(free, p.drop("__pfilter"), kmax, n_free * per_query, broadcast_limit_bytes, points_per_bucket, scored=scored))

    hits = final_topk(cands, kmax)
    if payload:
        hits = attach_payload(hits, points, point_id, payload, proven_small=n_q * kmax * _HIT_BYTES <= broadcast_limit_bytes)
    return hits


def attach_payload(hits: DataFrame, points: DataFrame, point_id: str, payload: list[str], proven_small: bool) -> DataFrame:
    """Join payload columns of the hit points.  Where ``queries x k`` small rows
    are under the limit, they are broadcast and the points stream without a
    shuffle.  Otherwise the planner
    chooses (AQE broadcasts at run time only under its measured threshold)."""
    cols = [c for c in payload if c != point_id]
    pay = points.select(point_key(points, point_id).alias("point_id"), *cols)
    side = F.broadcast(hits) if proven_small else hits
    return pay.join(side, "point_id").select("query_id", "rank", "score", "point_id", *cols)


def _broadcast_scan(spark, q: DataFrame, p: DataFrame, kmax: int, scored=None) -> DataFrame:
    # bounded by broadcast_limit_bytes (checked by the caller); sent as arrays, not as rows of Python objects
    block = spark.sparkContext.broadcast(_QueryBlock(q.toArrow().to_pandas(), kmax))

    def scan(batches):
        qb = block.value
        yield _emit(qb, _score_partition(qb, batches, scored))

    return p.mapInPandas(scan, _cand_schema(p.schema["__pid"].dataType))


def smaller(per_bucket: int, points: int, blocks: int, spark) -> int:
    """Points of a bucket: ``per_bucket``, or fewer where that leaves cores idle."""
    wanted = max(1, math.ceil(4 * spark.sparkContext.defaultParallelism / blocks))
    return min(per_bucket, max(LEAST_PER_BUCKET, math.ceil(points / wanted)))


def _block_scan(q, p, kmax, matrix_bytes, limit, per_bucket, scored=None) -> DataFrame:
    """Cogroup scoring: points are dealt by id to buckets and queries to blocks under
    ``limit`` bytes, so every group holds at most one query block and one bounded
    point bucket."""
    n_qb, n_p = max(1, math.ceil(matrix_bytes / limit)), p.count()
    n_pb = max(1, math.ceil(n_p / smaller(per_bucket, n_p, n_qb, q.sparkSession)))
    # grouping keys must have one type on both sides (int hashes differ from bigint)
    qx = q.withColumn("__qb", F.pmod(F.xxhash64("__qid"), F.lit(n_qb)).cast("int")).withColumn("__pb", F.explode(F.sequence(F.lit(0), F.lit(n_pb - 1))))
    px = p.withColumn("__pb", F.pmod(F.xxhash64("__pid"), F.lit(n_pb)).cast("int")).withColumn("__qb", F.explode(F.sequence(F.lit(0), F.lit(n_qb - 1))))
    return _score_pairs(qx, px, ["__qb", "__pb"], kmax, scored)


def _score_pairs(qx, px, keys: list[str], kmax: int, scored=None) -> DataFrame:
    """Queries and points that agree in ``keys``, scored group by group."""

    def pair(qdf: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
        qb = _QueryBlock(qdf, kmax)
        return _emit(qb, _score_partition(qb, [pdf], scored))

    return qx.groupBy(*keys).cogroup(px.groupBy(*keys)).applyInPandas(pair, _cand_schema(px.schema["__pid"].dataType))


def _routed_scan(q, p, kmax, per_query, limit, per_bucket, scored=None) -> DataFrame:
    """Queries with a filter meet only the points of their value.

    Values are dealt to slots by hash, each with the points and the queries of
    its values; the kernel scores value by value.  A value with more points than
    ``per_bucket``, or with more queries than fit the limit, gets a slot of its
    own, cut into buckets of points and blocks of queries.  Points of a value
    that no query asks for are left out before they move."""
    asked = q.groupBy(F.col("__qfilter").alias("__pfilter")).agg(F.count(F.lit(1)).alias("__nq"))
    p = p.join(asked.select("__pfilter"), "__pfilter", "left_semi")
    sizes = p.groupBy("__pfilter").agg(F.count(F.lit(1)).alias("__n")).join(asked, "__pfilter")
    # two numbers; then one row for each value over a limit: at most points / per_bucket + queries x bytes / limit
    per_block = max(1, int(limit // per_query))
    total, asking, many = sizes.agg(F.sum("__n"), F.sum("__nq"), F.count_if((F.col("__n") > per_bucket) | (F.col("__nq") > per_block))).first()
    # a slot's points and queries are about a quarter of what a group may hold
    slots = max(int(q.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(4 * (total or 0) / per_bucket), math.ceil(4 * (asking or 0) / per_block))
    if many:
        hot = sizes.where((F.col("__n") > per_bucket) | (F.col("__nq") > per_block)).select(
            "__pfilter", F.ceil(F.col("__n") / per_bucket).cast("int").alias("__nb"), F.ceil(F.col("__nq") / per_block).cast("int").alias("__nqb"))
        hot = F.broadcast(hot) if many * _HIT_BYTES <= limit else hot
        p = p.join(hot, "__pfilter", "left")
        q = q.join(hot.withColumnRenamed("__pfilter", "__qfilter"), "__qfilter", "left")
    else:
        p, q = [d.withColumns({"__nb": F.lit(None).cast("int"), "__nqb": F.lit(None).cast("int")}) for d in (p, q)]

    def placed(d: DataFrame, value: str) -> DataFrame:
        slot = F.pmod(F.xxhash64(value), F.lit(slots))
        own = F.pmod(F.xxhash64(value, F.lit("own")), F.lit(1 << 40)) + slots
        return d.withColumns({"__slot": F.when(F.col("__nb").isNull(), slot).otherwise(own), "__nb": F.coalesce("__nb", F.lit(1)), "__nqb": F.coalesce("__nqb", F.lit(1))})

    qx = placed(q, "__qfilter").withColumn("__qb", F.pmod(F.xxhash64("__qid"), F.col("__nqb")).cast("int"))
    qx = qx.withColumn("__pb", F.explode(F.sequence(F.lit(0), F.col("__nb") - 1))).drop("__nb", "__nqb")
    px = placed(p, "__pfilter").withColumn("__pb", F.pmod(F.xxhash64("__pid"), F.col("__nb")).cast("int"))
    px = px.withColumn("__qb", F.explode(F.sequence(F.lit(0), F.col("__nqb") - 1))).drop("__nb", "__nqb")
    return _score_pairs(qx, px, ["__slot", "__qb", "__pb"], kmax, scored)


def final_topk(cands: DataFrame, kmax: int) -> DataFrame:
    """Exact per-query top-k over candidate rows ``(query_id, point_id, score, k)``."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("point_id"))
    return (
        cands.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= F.lit(kmax))
        .where(F.col("rank") <= F.col("k"))
        .select("query_id", "rank", "score", "point_id")
    )


# ---------------------------------------------------------------- small operators

def score_threshold(hits: DataFrame, threshold: float = 0.35, score: str = "score") -> DataFrame:
    """Q2: keep hits scoring at least ``threshold`` (applied after ranking)."""
    return hits.where(F.col(score) >= F.lit(threshold))


def payload_filter(points: DataFrame, column: str, value) -> DataFrame:
    """Q3: exact payload match before the search (pushed down to the scan)."""
    return points.where(F.col(column) == F.lit(value))


def parse_filter_arg(arg: Column | str) -> Column:
    """Q4: the text after the first ``=``; the key is ignored; no ``=`` -> null."""
    c = F.col(arg) if isinstance(arg, str) else arg
    pos = F.instr(c, "=")
    return F.when(pos > 0, F.substring(c, pos + 1, F.lit(1 << 30)))


def clean_queries(queries: DataFrame, text: str = "query") -> DataFrame:
    """Q5 input rule: white space stripped; ``exit`` / ``quit`` (any case) are
    not queries."""
    return queries.withColumn(text, strip_ws(text)).where(~F.lower(F.col(text)).isin("exit", "quit"))


def empty_queries(queries: DataFrame, hits: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Q8: queries that returned no hit."""
    return queries.join(hits.select(query_id).distinct(), query_id, "left_anti")


def result_view_g1(hits: DataFrame) -> DataFrame:
    """Q6: rank, score to 4 decimals, source, chunk and a 600-character preview."""
    return hits.select(
        "query_id",
        "rank",
        F.round("score", 4).alias("score"),
        F.col("source"),
        F.col("chunk"),
        preview("text", 600).alias("preview"),
    )


def result_view_g2(hits: DataFrame) -> DataFrame:
    """Q7: the G2 hit card as columns: filename or N/A, page/total or ?,
    section cut at 40, chunk_id/total_chunks or ?, char_count or 0, preview 300."""
    q = F.lit("?")
    return hits.select(
        "query_id",
        "rank",
        F.round("score", 4).alias("score"),
        F.coalesce(F.col("filename"), F.lit("N/A")).alias("filename"),
        F.when(
            F.col("page").isNotNull(),
            F.concat_ws("/", F.col("page").cast("string"), F.coalesce(F.col("total_pages").cast("string"), q)),
        ).alias("page_info"),
        F.substring(F.col("section"), 1, 40).alias("section"),
        F.concat_ws(
            "/", F.coalesce(F.col("chunk_id").cast("string"), q), F.coalesce(F.col("total_chunks").cast("string"), q)
        ).alias("chunk_info"),
        F.coalesce(F.col("char_count"), F.lit(0)).cast("int").alias("char_count"),
        preview(F.coalesce(F.col("text"), F.lit("")), 300, flatten=True).alias("preview"),
    )
