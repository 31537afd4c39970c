"""Skew-safe running aggregates per key.

A plain ``sum(x) over (partition by key order by pos)`` sends every row of a
key to one task; one file or document holding a third of all rows would then
run in one task.  ``running_agg`` splits each key into ranges of ``block``
positions: totals per ``(key, range)`` are pre-aggregated (map-side combine),
prefix-combined over ranges, and joined back on ``(key, range)`` - a key that
is at most ``block`` rows wide - before the within-range window.  Every
window group and every join key is therefore bounded by ``block`` rows, or by
``rows / block`` ranges for the small range table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK = 1 << 16


def running_agg(
    df: DataFrame,
    keys: list[str],
    pos: str,
    value: Column | str,
    out: str,
    how: str = "sum",
    *,
    order: list[str] | None = None,
    total: str | None = None,
    block: int = DEFAULT_BLOCK,
) -> DataFrame:
    """Add ``out`` = running ``how`` ('sum' or 'max') of ``value`` over rows of
    the same ``keys`` up to and including the current row, ordered by ``order``
    (default ``[pos]``).  ``pos`` must be an integer column that orders rows the
    same way at range granularity (rows of a smaller ``pos // block`` come
    first).  ``total`` optionally adds the whole-key aggregate too."""
    agg = {"sum": F.sum, "max": F.max}[how]
    order = order or [pos]
    val = F.col(value) if isinstance(value, str) else value
    rb = "__rb"
    x = df.withColumn("__v", val).withColumn(rb, F.floor(F.col(pos) / F.lit(block)))
    # 1. running value inside each (key, range): one exchange on (key, range)
    within = Window.partitionBy(*keys, rb).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("__within", agg("__v").over(within))
    # 2. range totals from the same partitioning (no new exchange; the exchange
    #    below is shared with step 4, so the input is computed once)
    ranges = x.groupBy(*keys, rb).agg(agg("__v").alias("__rv"))
    # 3. totals of the earlier ranges of the key: one small row per range
    before = Window.partitionBy(*keys).orderBy(rb).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("__before", agg("__rv").over(before))
    if total:
        ranges = ranges.withColumn(total, agg("__rv").over(Window.partitionBy(*keys)))
    keep = [*keys, rb, "__before"] + ([total] if total else [])
    # 4. back onto the rows by (key, range): the row side is already partitioned so
    x = x.join(ranges.select(*keep), [*keys, rb])
    if how == "sum":
        res = F.coalesce(F.col("__before"), F.lit(0)) + F.col("__within")
    else:
        res = F.greatest(F.col("__before"), F.col("__within"))
    return x.withColumn(out, res).drop("__v", rb, "__before", "__within")
