"""Aggregate functions by name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the aggregates.
_METRICS = {
    "sum": F.sum,
    "avg": F.avg,
    "mean": F.avg,
    "max": F.max,
    "min": F.min,
    "count": F.count,
    "stddev": F.stddev,
}


def metric(name: str, column: str) -> Column:
    """Aggregate ``name`` over ``column``, called ``{name}_{column}`` in the caller's spelling."""
    function = _METRICS.get(name.lower())
    if function is None:
        raise ValueError(f"Unknown aggregate '{name}'. Choose from: {sorted(_METRICS)}")
    return function(column).alias(f"{name}_{column}")
