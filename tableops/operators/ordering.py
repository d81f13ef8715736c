"""Sorting, previews and top-k per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SOURCE, _BEST = "__source", "__best"


def sort_rows(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Global sort. Rows with equal keys may span partitions, so one frequent value does not fill a single task."""
    source = df.withColumn(_SOURCE, F.spark_partition_id())
    return source.orderBy(*keys, _SOURCE).drop(_SOURCE)


def preview(df: DataFrame, order_by: Sequence[str | Column], rows: int = 10) -> DataFrame:
    """The first rows in an order; each task keeps only ``rows`` of them."""
    return df.orderBy(*order_by).limit(rows)


def top_k_per_group(
    df: DataFrame,
    by: Sequence[str],
    metric: str,
    k: int = 5,
    rank_column: str = "rank",
) -> DataFrame:
    """Rows whose metric is among the ``k`` highest distinct values of their group, with the dense rank.

    Ties may give more than ``k`` rows. The ranks come from the distinct values, which shrink to ``k`` per group and
    task before the shuffle, so no task gathers a whole group, however many rows share a value.
    Lazy: the few ranks join the rows by broadcast or shuffle, as Spark's sizes suggest.
    """
    keys = [*by, metric]
    best_first = Window.partitionBy(*by).orderBy(F.desc(metric))
    values = df.select(*keys).distinct()
    ranks = values.withColumn(rank_column, F.row_number().over(best_first)).filter(F.col(rank_column) <= k)
    # A struct joins null groups and metrics like any other value.
    ranks = ranks.select(F.struct(*keys).alias(_BEST), rank_column)
    return df.withColumn(_BEST, F.struct(*keys)).join(ranks, _BEST).drop(_BEST)
