"""Relational source over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str | None = None,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: object = None,
    upper_bound: object = None,
    num_partitions: int = 10,
    query: str | None = None,
) -> dict[str, str]:
    """Reader options for a table or a pushed-down query, optionally split on a numeric column.

    The split needs the column and both bounds. The bounds only place the borders: rows outside them are read by the
    first and last task. Spark takes no ``query`` together with a split, so a split query is read as a derived table.
    """
    if not (table or query):
        raise ValueError("Give a table or a query")
    split = bool(partition_column) and lower_bound is not None and upper_bound is not None
    options = {"url": url, **(properties or {})}
    if query and split:
        options["dbtable"] = f"({query}) q"
    elif query:
        options["query"] = query
    else:
        options["dbtable"] = table
    if split:
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return options


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: object = None,
    upper_bound: object = None,
    num_partitions: int = 10,
    query: str | None = None,
) -> DataFrame:
    """Table or query of a relational database. Without a split one task reads everything, so split large tables."""
    options = jdbc_options(
        url, table, properties, partition_column, lower_bound, upper_bound, num_partitions, query
    )
    return spark.read.format("jdbc").options(**options).load()
