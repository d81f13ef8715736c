"""SQL over DataFrames: named views with a lifetime, and SQL strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Views:
    """Views that vanish when the ``with`` block ends.

    Plans built from a view stay usable after it is dropped.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._names: list[tuple[str, bool]] = []

    def __enter__(self) -> Views:
        return self

    def __exit__(self, *_exc) -> None:
        self.drop_all()

    def register(self, df: DataFrame, name: str, global_view: bool = False) -> None:
        """Create or replace a session view, or a global one read as ``global_temp.{name}``."""
        if global_view:
            df.createOrReplaceGlobalTempView(name)
        else:
            df.createOrReplaceTempView(name)
        if (name, global_view) not in self._names:
            self._names.append((name, global_view))

    def drop(self, name: str, global_view: bool = False) -> bool:
        """Drop a view; False if there was none."""
        if (name, global_view) in self._names:
            self._names.remove((name, global_view))
        catalog = self._spark.catalog
        return catalog.dropGlobalTempView(name) if global_view else catalog.dropTempView(name)

    def drop_all(self) -> None:
        """Drop every view registered here, global ones included."""
        for name, global_view in list(self._names):
            self.drop(name, global_view)

    def sql(self, query: str, **frames: DataFrame) -> DataFrame:
        return run_sql(self._spark, query, **frames)


def run_sql(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """Any SQL statement. ``{name}`` in the text stands for the DataFrame passed under that name."""
    return spark.sql(query, **frames) if frames else spark.sql(query)
