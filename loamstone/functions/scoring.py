"""Generic scores: clamps, bands, weighted sums and set similarities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(value: Column, low: float = 0.0, high: float = 100.0, default: float = 0.0) -> Column:
    return F.coalesce(F.greatest(F.lit(low), F.least(F.lit(high), value.cast("double"))), F.lit(default))


def weighted(parts: dict[str, float], columns: dict[str, Column], normalise: bool = False) -> Column:
    """Sum of weight * value; negative weights subtract. With normalise, over the sum of absolute weights."""
    total = F.lit(0.0)
    for name, weight in parts.items():
        total = total + F.coalesce(columns[name].cast("double"), F.lit(0.0)) * weight
    return total / sum(abs(w) for w in parts.values()) if normalise else total


def band(value: Column, levels: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The label of the first level that the value reaches; levels run from high to low."""
    out = None
    for least, label in levels:
        out = F.when(value >= least, label) if out is None else out.when(value >= least, label)
    return out.otherwise(otherwise)


def min_max(value: Column, low: Column, high: Column) -> Column:
    """The place of the value between low and high in percent; 0 where they are equal."""
    return clamp(F.when(high > low, (value - low) / (high - low) * 100.0).otherwise(0.0))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all different elements of two arrays; 0 where both are empty or null."""
    a, b = (F.coalesce(x, F.array().cast("array<string>")) for x in (a, b))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b))), F.lit(0.0))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of the same length, in doubles."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
