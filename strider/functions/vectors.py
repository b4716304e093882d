"""Vector magnitude and array folds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def magnitude(x: Column | str, y: Column | str, z: Column | str) -> Column:
    """sqrt(x² + y² + z²)."""
    x, y, z = _col(x), _col(y), _col(z)
    return F.sqrt(x * x + y * y + z * z)


def majority_vote(arr: Column | str) -> Column:
    """Most frequent element of an array; ties go to the lowest value."""
    arr = _col(arr)
    tallies = F.transform(
        F.array_distinct(arr),
        lambda x: F.struct(F.size(F.filter(arr, lambda y: y == x)).alias("n"), (-x).alias("v")))
    return -F.array_max(tallies)["v"]


def array_sum(arr: Column | str) -> Column:
    """Left fold ``acc + x`` over a double array with a double zero."""
    return F.aggregate(_col(arr), F.lit(0.0), lambda acc, x: acc + x)
