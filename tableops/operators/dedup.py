"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_POSITION = "__position"


def dedup_rows(df: DataFrame) -> DataFrame:
    """One copy of every distinct row. Copies already collapse in the map-side aggregate, before the shuffle."""
    return df.dropDuplicates()


def dedup_keys(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key: the first in ``order_by``, or an arbitrary one without an order.

    The ordered form keeps at most one row per key and task before the shuffle (Spark's window group limit), so a
    key that holds a large share of the rows does not load the task that finishes it.
    """
    if not order_by:
        return df.dropDuplicates(list(keys))
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(_POSITION, F.row_number().over(first)).filter(F.col(_POSITION) == 1).drop(_POSITION)
