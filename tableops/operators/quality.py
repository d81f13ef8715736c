"""Checks on a table before it is used."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The table, if it has all the columns. Runs no job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: nulls, rows and their ratio (0 for an empty table), from one aggregate over the table."""
    require_columns(df, columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__nulls_{i}") for i, c in enumerate(columns)],
    )
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"__nulls_{i}").alias("n_nulls")) for i, c in enumerate(columns)]
    return counts.select("n_rows", F.inline(F.array(*entries))).select(
        "column",
        "n_nulls",
        "n_rows",
        F.coalesce(F.try_divide("n_nulls", "n_rows"), F.lit(0.0)).alias("null_ratio"),
    )


def validate(
    df: DataFrame, columns: Sequence[str], null_threshold: float = 0.5, min_rows: int = 1
) -> DataFrame:
    """The unchanged table, after checking columns, row count and null ratios. Runs one aggregate.

    A ratio equal to the threshold passes.
    """
    require_columns(df, columns)
    if columns:
        profile = null_profile(df, columns).collect()  # one row per column
        total = profile[0]["n_rows"]
    else:
        profile, total = [], df.count()
    if total < min_rows:
        raise ValueError(f"Too few rows: {total}, minimum required is {min_rows}")
    for row in profile:
        if row["null_ratio"] > null_threshold:
            share, limit = f"{row['null_ratio']:.1%}", f"{null_threshold:.1%}"
            raise ValueError(f"Too many nulls in '{row['column']}': {share} nulls, at most {limit} allowed")
    return df
