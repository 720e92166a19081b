"""Array arithmetic for class probabilities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    powers = F.transform(scores, lambda x: F.exp(x - top))
    return F.transform(powers, lambda x: x / array_sum(powers))


def argmax(values: Column) -> Column:
    """Position of the first maximum, from 0."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def normalise(values: Column) -> Column:
    """Scale to sum 1; all zero becomes uniform."""
    total = array_sum(values)
    size = F.size(values)
    return F.transform(values, lambda x: F.when(total > 0, x / total).otherwise(F.lit(1.0) / size))


def squared_distance(a: Column, b: Column) -> Column:
    return array_sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))
