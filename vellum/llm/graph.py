"""Connected components by alternating large-star and small-star rounds.

Every round is two aggregations and two joins over the edge list, in which no
node of high degree is a key that edges are dealt by; the results of a round
are written to the shared folder.  Only two numbers a round (edge count and a
checksum) come to the driver.  Rounds grow with the logarithm of
the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import written

DEGREE = 256  # edges of a node that are dealt to one task
HUBS = 1 << 20  # nodes of higher degree at most, broadcast


def _stamp(e: DataFrame):
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _joined(e: DataFrame, by: str, values: DataFrame, edges: int) -> DataFrame:
    """``e`` with the columns of ``values`` (``x``, a row a node; ``n``: its degree)
    of the node ``by``.

    A node of high degree would be one key of a shuffle, so such nodes are
    broadcast: at most 2 x edges / limit nodes have a degree over the limit, which
    is never more than HUBS rows.  Only edges of other nodes are dealt by node."""
    limit = max(DEGREE, 2 * edges // HUBS)
    hubs = F.broadcast(values.where(F.col("n") > limit).drop("n"))
    rest = values.where(F.col("n") <= limit).drop("n")
    near = e.join(hubs, F.col(by) == F.col("x")).drop("x")
    return near.union(e.join(hubs.select("x"), F.col(by) == F.col("x"), "left_anti").join(rest, F.col(by) == F.col("x")).drop("x"))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Columns ``node`` and ``component`` (smallest node reachable) for every
    node that has an edge in ``edges``; loops and repeated edges are allowed."""
    e = written(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "edges",
    )
    stamp = _stamp(e)
    while stamp[0]:
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(e.select("v", "u"))
        low = both.groupBy("x").agg(F.min("y").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("x", "m"))
        large = written(_joined(e, "v", written(low, "low"), stamp[0]).select("u", F.col("m").alias("v")).distinct(), "large")
        least = large.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = _joined(large, "u", written(least, "least"), stamp[0]).select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        e = written(small.select("e.*").where("u <> v").distinct(), "edges")
        before, stamp = stamp, _stamp(e)
        if before == stamp:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
