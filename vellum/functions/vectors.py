"""Vector expressions on ``array<float>`` columns (higher-order functions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a: Column | str, b: Column | str) -> Column:
    """Dot product accumulated in double; on unit vectors it is the cosine."""
    prods = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(_col(v), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine_score(a: Column | str, b: Column | str) -> Column:
    """E4 for vectors of any length: dot / (|a| |b|); 0 when either is zero."""
    den = norm(a) * norm(b)
    return F.when(den > 0, dot(a, b) / den).otherwise(F.lit(0.0))


def bind(expr: Column, fn) -> Column:
    """Evaluate ``expr`` once per row and hand it to ``fn`` as a lambda
    variable.  Catalyst would otherwise inline a column referenced inside a
    lambda body and recompute it for every array element."""
    return F.element_at(F.transform(F.array(expr), fn), 1)


def unit(v: Column | str) -> Column:
    """E3 as a column: ``v / |v|`` as ``array<float>``; a zero vector stays zero.
    The norm is computed once per row."""
    return bind(
        _col(v),
        lambda a: bind(
            norm(a),
            lambda n: F.transform(a, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)).cast("float")),
        ),
    )


def l2_normalize(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Divide by the Euclidean norm; a zero vector stays zero (array<float>)."""
    return df.withColumn(out or col, unit(col))
