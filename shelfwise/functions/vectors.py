"""Dense vectors held as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NORM_FLOOR = 1e-12


def l2_norm(vector: Column) -> Column:
    wide = vector.cast("array<double>")
    return F.sqrt(F.aggregate(wide, F.lit(0.0), lambda total, x: total + x * x))


def l2_unit(vector: Column) -> Column:
    norm = F.greatest(l2_norm(vector), F.lit(NORM_FLOOR))
    return F.transform(vector.cast("array<double>"), lambda x: x / norm)


def zero_vector(width: int, element: str = "float") -> Column:
    return F.array_repeat(F.lit(0.0).cast(element), width)


def spread(vector: Column, width: int, prefix: str = "f") -> list[Column]:
    """One double column per position: f1..fK."""
    return [F.get(vector, F.lit(j)).cast("double").alias(f"{prefix}{j + 1}") for j in range(width)]
