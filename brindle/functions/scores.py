"""Score arithmetic for trending and recommendation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blend weights, decay constant and the spread treated as constant.
ALS_WEIGHT = 0.7
TRENDING_WEIGHT = 0.3
DECAY_MINUTES = 5.0
FLAT_SPREAD = 1e-9


def min_max(value: Column, low: Column, high: Column, *, single_score: float = 0.0) -> Column:
    """Scale to [0, 1]; a constant (or lone) score becomes ``single_score``."""
    spread = high - low
    return (F.when(value.isNull(), None)
            .when(spread < F.lit(FLAT_SPREAD), F.lit(float(single_score)))
            .otherwise((value - low) / spread))


def decayed(count: Column, mean: Column, age_minutes: Column,
            decay_minutes: float = DECAY_MINUTES) -> Column:
    """count x mean, discounted exponentially by the age of the newest record."""
    return count * mean * F.exp(-age_minutes / F.lit(float(decay_minutes)))


def dot(left: Column, right: Column) -> Column:
    """Inner product of two equally long numeric arrays."""
    return F.aggregate(F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


def share(condition: Column) -> Column:
    """Aggregate: fraction of rows for which ``condition`` is true (null is false)."""
    return F.sum(F.when(condition, 1).otherwise(0)) / F.count(F.lit(1))
