"""Vector and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_distance(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """1 - cosine, the cosine held to [-1, 1]. Unequal sizes and zero vectors are errors; a null side gives null."""
    na, nb = norm(a) if norm_a is None else norm_a, norm(b) if norm_b is None else norm_b
    value = F.lit(1.0) - F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b) / (na * nb)))
    return F.when(F.size(a) != F.size(b), F.raise_error(F.lit("vectors of unequal size")).cast("double")).when((na == 0) | (nb == 0), F.raise_error(F.lit("zero vector")).cast("double")).otherwise(value)


def safe_divide(n: Column, d: Column) -> Column:
    """0/0 is 0, anything else over 0 is infinite with its sign."""
    return F.when(d == 0, F.when(n == 0, F.lit(0.0)).otherwise(F.signum(n) * F.lit(float("inf")))).otherwise(n / d)


def finite(a: Column) -> Column:
    return F.forall(a, lambda x: ~F.isnan(x) & (F.abs(x) != float("inf")))
