"""Q9: approximate top-k with several random-hyperplane hash tables.

A table has ``bits`` random hyperplanes; the sides that a vector lies on are its
bucket.  A point stands in one bucket of each table.  A query probes buckets in
the order of margin: turning a bit costs the square of the query's distance from
that hyperplane, and the ``probes`` buckets of least cost are looked into.  A
pair found in several tables counts once.

``fit_lsh`` picks tables, bits and probes on a bounded sample: the setting that
scores the fewest pairs among those that find a goal's share of the exact
neighbours of held-out queries.  Every point is indexed.

Queries and points meet by (table, bucket) through the routed scan of
``search``, which splits a bucket that many points or queries share, so copies
of one vector don't land in one task.  Queries that would be sent to more buckets
than there are blocks of points are sent to the blocks instead, once to each, with
the buckets they probe; the points lie there with theirs.  A query with a filter is not approximated:
it meets the points of its value, all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, ShortType, StringType

from vellum.functions.arrays import arrow_udf
from vellum.operators import search
from vellum.operators.ann import held_out, sample_of, SAMPLE, HELD_OUT
from vellum.session import shared_dir

TABLES, BITS = (4, 8, 16), (4, 6, 8, 10)  # tried by the fit
ROUTED_BYTES = 256 << 20  # of queries, repeated for every probed bucket, that are sent to the buckets


@dataclass(frozen=True)
class LshPlan:
    """What a search needs beside the points: parameters of a few numbers; the
    hyperplanes follow from them."""

    dim: int
    tables: int
    bits: int
    probes: int
    seed: int = 42

    def planes(self) -> np.ndarray:
        """tables x bits x dim normals, the same for all plans of a seed."""
        return np.stack([np.random.default_rng([self.seed, t]).standard_normal((self.bits, self.dim)) for t in range(self.tables)])


def margins(x: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """tables x rows x bits distances from the hyperplanes, added up component by
    component: the same bits for a row in every batch."""
    out = np.zeros((planes.shape[0], len(x), planes.shape[1]))
    for j in range(planes.shape[2]):
        out += x[None, :, j, None] * planes[:, None, :, j]
    return out


def buckets(m: np.ndarray) -> np.ndarray:
    """tables x rows bucket numbers of margins."""
    return ((m > 0) << np.arange(m.shape[2])).sum(2)


def probe_order(m: np.ndarray) -> np.ndarray:
    """rows x all buckets of one table's margins (rows x bits), cheapest first."""
    every = (np.arange(1 << m.shape[1])[:, None] >> np.arange(m.shape[1])) & 1
    cost = np.zeros((len(m), len(every)))
    for i in range(m.shape[1]):
        cost += np.where((m[:, i, None] > 0) == every[None, :, i], 0.0, m[:, i, None] ** 2)
    return np.argsort(cost, axis=1, kind="stable")


def fit_lsh(points: DataFrame, *, goal: float = 0.9, k: int = 5, vector: str = "vector", point_id: str = "point_id",
            tables: tuple[int, ...] = TABLES, bits: tuple[int, ...] = BITS, seed: int = 42) -> LshPlan:
    """The plan that scores the fewest pairs (a pair for every table it is met in)
    while it finds ``goal`` of the exact ``k`` best of the held-out queries."""
    shared_dir(points.sparkSession)
    x, q, best = held_out(sample_of(points, SAMPLE + HELD_OUT, vector, point_id, seed).checkpoint(), k, vector)
    if not best.size:
        return LshPlan(x.shape[1], 1, 1, 2, seed)  # every bucket
    plans = []
    for b in bits:
        whole = LshPlan(x.shape[1], max(tables), b, 1, seed)
        of_x, of_q = buckets(margins(x, whole.planes())), margins(q, whole.planes())
        rank = np.stack([np.take_along_axis(np.argsort(probe_order(of_q[t]), axis=1), of_x[t][best], axis=1) for t in range(max(tables))])
        for t in tables:
            need = np.sort(rank[:t].min(0), axis=None)
            probes = int(need[int(np.ceil(goal * len(need))) - 1]) + 1
            plans.append((t * probes / (1 << b), t, LshPlan(x.shape[1], t, b, probes, seed)))
    return min(plans, key=lambda p: p[:2])[2]


def _keys_udf(plan: LshPlan, probes: int):
    """Keys ``table:bucket`` of a vector: its own, or its cheapest ``probes`` in every table."""

    def run(s: pd.Series) -> pd.Series:
        if not len(s):
            return pd.Series([], dtype=object)
        x = np.stack(s.to_numpy()).astype(np.float64)
        if plan.dim and x.shape[1] != plan.dim:
            raise ValueError(f"vectors of one search must have one size; found {sorted({x.shape[1], plan.dim})}")
        own = np.concatenate([_probed(x[i : i + _ROWS], plan, probes) for i in range(0, len(x), _ROWS)])
        return pd.Series([[f"{t}:{b}" for t in range(plan.tables) for b in row[t]] for row in own.tolist()])

    return arrow_udf(run, ArrayType(StringType()))


_ROWS = 512  # vectors whose buckets are put in order at once


def _probed(x: np.ndarray, plan: LshPlan, probes: int) -> np.ndarray:
    """rows x tables x buckets: a vector's own bucket in each table, or its cheapest ``probes``."""
    m = margins(x, plan.planes())
    return buckets(m).T[:, :, None] if not probes else np.stack([probe_order(of)[:, :probes] for of in m], axis=1)


def _numbers_udf(plan: LshPlan, probes: int):
    """``_probed`` as one list of a vector, table after table."""
    kind = IntegerType() if plan.bits > 15 else ShortType()

    def run(s: pd.Series) -> pd.Series:
        x, out = s.tolist(), []
        for i in range(0, len(x), _ROWS):
            rows = np.stack(x[i : i + _ROWS]).astype(np.float64)
            if plan.dim and rows.shape[1] != plan.dim:
                raise ValueError(f"vectors of one search must have one size; found {sorted({rows.shape[1], plan.dim})}")
            out += list(_probed(rows, plan, probes).reshape(len(rows), -1).astype(np.int32 if plan.bits > 15 else np.int16))
        return pd.Series(out, dtype=object)

    return arrow_udf(run, ArrayType(kind))


def keyed(points: DataFrame, plan: LshPlan, vector: str = "vector") -> DataFrame:
    """``points`` with ``keys``, a bucket of each table: what can be stored beside
    the plan and searched again."""
    return points.where(F.col(vector).isNotNull()).withColumn("keys", _keys_udf(plan, 0)(F.col(vector)))


def lsh_topk(points: DataFrame, plan: LshPlan, queries: DataFrame, k: int | str = 5, *, threshold=None,
             point_id: str = "point_id", point_vec: str = "vector", query_id: str = "query_id", query_vec: str = "vector",
             query_filter: str | None = None, point_filter: str | None = None, payload: list[str] | None = None,
             broadcast_limit_bytes: int = search.DEFAULT_BROADCAST_LIMIT, points_per_bucket: int = search.POINTS_PER_BUCKET,
             routed_bytes: int = ROUTED_BYTES, scored=None) -> DataFrame:
    """Approximate ``k`` best of ``points`` (with ``keys``, see ``keyed``) per query;
    arguments and output as ``search.topk``."""
    if (query_filter is None) != (point_filter is None):
        raise ValueError("query_filter and point_filter go together")
    q = search._prepare_queries(queries, query_id, query_vec, k, threshold, query_filter).where("__qvec is not null")
    shared_dir(points.sparkSession)
    q = q.checkpoint()
    stats = q.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("__qvec")).alias("dim"), F.max("__k").alias("kmax")).first()
    n_q, dim, kmax = int(stats["n"]), int(stats["dim"] or 0), int(stats["kmax"] or 0)
    if n_q == 0 or kmax <= 0:
        return search.topk(points, queries.limit(0), k, point_id=point_id, point_vec=point_vec, query_id=query_id, query_vec=query_vec, payload=payload)
    key = search.point_key(points, point_id)
    per_query = max(dim, 1) * 8 + 48 + search._HIT_BYTES * kmax
    free = q.where("__qfilter is null").drop("__qfilter") if query_filter else q
    sent = plan.tables * plan.probes
    if n_q * sent * per_query <= routed_bytes or points.count() > sent * points_per_bucket:
        p = points.select(key.alias("__pid"), F.col(point_vec).alias("__pvec"), F.explode("keys").alias("__pfilter")).where("__pid is not null")
        asked = free.withColumn("keys", _keys_udf(plan, plan.probes)(F.col("__qvec")))
        asked = asked.select("__qid", "__qvec", "__k", "__thr", F.explode("keys").alias("__qfilter"))
        cands = search._routed_scan(asked, p, kmax, per_query, broadcast_limit_bytes, points_per_bucket, scored)
    else:
        # both sides carry their buckets as small numbers: 2 bytes each up to 15 bits
        own = F.transform("keys", lambda x: F.element_at(F.split(x, ":"), 2).cast("int"))
        p = points.select(key.alias("__pid"), F.col(point_vec).alias("__pvec"), own.alias("__keys")).where("__pid is not null and __pvec is not null")
        asked = free.withColumn("__keys", _numbers_udf(plan, plan.probes)(F.col("__qvec")))
        cands = search._block_scan(asked, p, kmax, n_q * (per_query + 4 * sent), broadcast_limit_bytes, points_per_bucket, scored)
    if query_filter:
        own = points.select(key.alias("__pid"), F.col(point_vec).alias("__pvec"), F.col(point_filter).cast("string").alias("__pfilter"))
        own = own.where("__pid is not null and __pvec is not null")
        cands = cands.unionByName(search._routed_scan(q.where("__qfilter is not null"), own, kmax, per_query, broadcast_limit_bytes, points_per_bucket, scored))
    # a pair met in several tables has one score (the same sum in the same order)
    hits = search.final_topk(cands.dropDuplicates(["query_id", "point_id"]), kmax)
    if payload:
        hits = search.attach_payload(hits, points, point_id, payload, proven_small=n_q * kmax * search._HIT_BYTES <= broadcast_limit_bytes)
    return hits
