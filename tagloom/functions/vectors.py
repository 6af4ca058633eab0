"""Arithmetic on array<double> columns with built-in higher-order functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def squared_distance(a, b) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x
    )


def rbf_kernel(a, b, gamma) -> Column:
    return F.exp(squared_distance(a, b) * F.lit(-float(gamma)))


def min_max_scaled(vec, low, high) -> Column:
    """(x - low) / (high - low) per dimension; a constant dimension maps to x - low."""
    width = F.zip_with(low, high, lambda lo, hi: F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo))
    return F.zip_with(
        F.zip_with(vec, low, lambda x, lo: x - lo), width, lambda d, w: F.try_divide(d, w)
    )


def as_doubles(vec) -> Column:
    return F.col(vec).cast("array<double>") if isinstance(vec, str) else vec.cast("array<double>")


def literal_vector(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])
