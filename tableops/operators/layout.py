"""Physical layout: partition counts, caching, skew profiles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CONTENT, _SOURCE = "__content", "__source"

# Names of the storage levels.
_LEVELS = {
    "memory_only": StorageLevel.MEMORY_ONLY,
    "memory_and_disk": StorageLevel.MEMORY_AND_DISK,
    "disk_only": StorageLevel.DISK_ONLY,
    "off_heap": StorageLevel.OFF_HEAP,
}


def set_partitions(df: DataFrame, target: int, by: str | None = None, fewer: bool = False) -> DataFrame:
    """Exactly ``target`` partitions.

    With ``by`` rows are range-partitioned by that column and then by their content and input partition, so a frequent
    value spans partitions and copies of a row part. ``fewer`` coalesces without a shuffle, for a target below the
    table's own count (which it then keeps if it is lower); else rows spread evenly.
    """
    if by is None:
        return df.coalesce(target) if fewer else df.repartition(target)
    ties = {_CONTENT: F.xxhash64(*df.columns), _SOURCE: F.spark_partition_id()}
    return df.withColumns(ties).repartitionByRange(target, by, _CONTENT, _SOURCE).drop(*ties)


def gather(df: DataFrame, by: str, keep_together: bool = False) -> DataFrame:
    """Rows gathered by a column in partitions that adaptive execution sizes; it splits what a frequent value would overload.

    ``keep_together`` forbids the split: all rows of a value are then in one partition.
    """
    return df.repartition(by) if keep_together else df.hint("rebalance", by)


def cache(df: DataFrame, level: str = "memory_and_disk") -> DataFrame:
    """Persist at the named level; an unknown name means memory and disk."""
    return df.persist(_LEVELS.get(level, StorageLevel.MEMORY_AND_DISK))


def uncache(df: DataFrame) -> DataFrame:
    """Release a persisted table."""
    return df.unpersist()


@contextmanager
def cached(df: DataFrame, level: str = "memory_and_disk") -> Iterator[DataFrame]:
    """Persisted inside the context and released after it, also by an error."""
    kept = cache(df, level)
    try:
        yield kept
    finally:
        uncache(kept)


def partition_profile(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row: partitions, rows, smallest and largest partition and ``skew = (max - min) / average``.

    Pass the partition count to count partitions without rows as empty ones; else only those with rows are profiled. Runs
    nothing when called.
    """
    counts = df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))
    n = F.count(F.lit(1)) if partitions is None else F.lit(partitions).cast("long")
    profile = counts.agg(
        n.alias("n_partitions"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.when(F.count(F.lit(1)) < n, 0).otherwise(F.coalesce(F.min("n"), F.lit(0))).alias("min_rows"),
        F.coalesce(F.max("n"), F.lit(0)).alias("max_rows"),
    )
    average = F.try_divide(F.col("n_rows"), F.col("n_partitions"))
    return profile.withColumn("skew", F.coalesce(F.try_divide(F.col("max_rows") - F.col("min_rows"), average), F.lit(0.0)))


def key_profile(df: DataFrame, keys: Sequence[str], top: int = 20) -> DataFrame:
    """Rows and share of the table of the most frequent keys: what to look at before a salted join."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.agg(F.sum("n_rows")).scalar()
    return counts.withColumn("share", F.col("n_rows") / total).orderBy(F.desc("n_rows"), *keys).limit(top)
