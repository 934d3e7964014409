"""Error terms of a forecast."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Smallest step of a double at 1; keeps the relative error finite for a true value of 0.
EPSILON = 2.220446049250313e-16


def absolute_error(actual: Column, predicted: Column) -> Column:
    return F.abs(actual.cast("double") - predicted.cast("double"))


def absolute_percentage_error(actual: Column, predicted: Column) -> Column:
    return absolute_error(actual, predicted) / F.greatest(F.abs(actual.cast("double")), F.lit(EPSILON))


def reciprocal_weight(actual: Column) -> Column:
    """1/actual for positive values, null otherwise."""
    return F.when(actual > 0, F.lit(1.0) / actual.cast("double"))
