"""Exploding computed arrays without computing them twice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def posexplode_rows(arr: Column, pos: str = "pos", val: str = "col") -> Column:
    """``posexplode`` for an array computed in the same projection.

    The optimizer adds ``size(arr) > 0`` in front of a plain ``posexplode``
    (to drop rows early), which evaluates an expensive array expression - a
    tokenisation, a chunking - a second time.  The ``_outer`` form gets no
    such filter; follow it with ``.where(col(pos).isNotNull())`` (see
    ``keep_rows``) to drop the placeholder row of an empty array."""
    return F.posexplode_outer(arr).alias(pos, val)


def keep_rows(pos: str = "pos") -> Column:
    return F.col(pos).isNotNull()


def arrow_udf(fn, return_type):
    """An Arrow batch (pandas) UDF that Spark evaluates exactly where it is
    written.  Marked non-deterministic for the optimizer only (the functions
    are deterministic, so a retried task gives the same rows): a filter is
    then never pushed below it and projections around it are not merged, so
    one UDF's input never contains another UDF inline and nothing is
    evaluated twice."""
    return F.pandas_udf(fn, return_type).asNondeterministic()
