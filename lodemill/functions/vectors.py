"""Vector expressions in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays; the cosine, if both are of length 1."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalized(a: Column) -> Column:
    """The vector at length 1; a zero vector stays."""
    length = norm(a)
    return F.transform(a, lambda x: F.when(length > 0, x.cast("double") / length).otherwise(x.cast("double")))
