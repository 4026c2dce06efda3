"""Aggregations a report picks by name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The names a report can choose.
AGGREGATIONS = {
    "avg": F.avg,
    "count": F.count,
    "count_distinct": F.count_distinct,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
}


def agg_by_name(name: str, value: Column) -> Column:
    if name not in AGGREGATIONS:
        raise ValueError(f"aggregation {name!r} is not one of {sorted(AGGREGATIONS)}")
    return AGGREGATIONS[name](value)


def numeric_agg(name: str, value: Column) -> Column:
    """The same, as double, so that every aggregation gives a series of one type."""
    return agg_by_name(name, value).cast("double")
