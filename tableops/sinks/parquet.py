"""Parquet output and checks on what was written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableops.operators.quality import require_columns

_SAVE_MODES = ("overwrite", "append", "ignore", "error", "errorifexists")


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
    compression: str = "snappy",
    dynamic: bool = True,
    gather: bool = True,
) -> int | None:
    """Write Parquet and return the rows written, counted by the write itself (None for ``ignore``).

    ``partition_by`` gives one directory per value, e.g. year, month and region. ``dynamic`` makes an overwrite replace
    only the directories the new data has. ``gather`` shuffles by the directory columns first, so that a directory
    gets few files; adaptive execution splits a directory that would overload its task.
    """
    if mode not in _SAVE_MODES:
        raise ValueError(f"Unknown save mode '{mode}'. Choose from: {', '.join(_SAVE_MODES)}")
    observed = None
    if mode != "ignore":  # an existing target skips the write, and the count would never arrive
        observed = Observation()
        df = df.observe(observed, F.count(F.lit(1)).alias("rows"))
    if partition_by and gather:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    writer.parquet(path)
    return observed.get["rows"] if observed else None


def read_back(
    spark: SparkSession,
    path: str,
    expected_rows: int | None = None,
    expected_columns: Sequence[str] | None = None,
    where: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read Parquet, optionally a part of it, after checking its columns and its exact row count.

    A predicate on directory columns prunes directories. Rows are counted only if a count is expected.
    """
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    if expected_columns:
        require_columns(df, expected_columns)
    if where:
        df = df.filter(where)
    if expected_rows is not None:
        actual = df.count()
        if actual != expected_rows:
            raise ValueError(f"Expected {expected_rows} rows in {path}, found {actual}")
    return df


def list_partitions(spark: SparkSession, path: str, partition_by: Sequence[str]) -> DataFrame:
    """Directory values under ``path`` with their rows and files."""
    files = spark.read.parquet(path).groupBy(*partition_by, F.col("_metadata.file_path").alias("file"))
    return (
        files.agg(F.count(F.lit(1)).alias("rows"))
        .groupBy(*partition_by)
        .agg(F.sum("rows").alias("n_rows"), F.count(F.lit(1)).alias("n_files"))
    )
