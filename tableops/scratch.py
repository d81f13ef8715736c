"""Shared scratch folder for checkpoints and intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_BUCKETS = 4  # per shuffle partition, so that few values share one


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: the session's checkpoint folder, or a temporary one on a local master only."""
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"Set {_SETTING} to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="tableops-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_folder(spark).rstrip('/')}/tableops-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read from there.

    Later uses neither compute it again nor depend on the executors that did, and read only the columns they need,
    which a checkpoint of whole rows would not allow.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Tables:
    """Intermediate tables of one operator, in a database of their own inside the shared folder.

    A context manager: on exit all tables go but those that were put with ``keep=True``, which a lazy result reads.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.database = f"tableops_{uuid.uuid4().hex}"
        self._made: dict[str, bool] = {}
        self._count = 0
        folder = shared_folder(spark).rstrip("/").replace("'", "\\'")
        spark.sql(f"CREATE DATABASE {self.database} LOCATION '{folder}/{self.database}'")

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *error: object) -> None:
        self.drop(*[name for name, keep in self._made.items() if not keep])
        if not self._made:
            self.spark.sql(f"DROP DATABASE {self.database}")

    def put(
        self,
        df: DataFrame,
        name: str,
        keep: bool = False,
        sort: list[str] | None = None,
        by: str | None = None,
        buckets: list[str] | None = None,
    ) -> DataFrame:
        """The rows written as a table and read from it: later uses do not compute them again.

        ``sort`` makes hash buckets of these columns, sorted by them, as many as there are shuffle partitions, so joins on
        them need no shuffle of this side. ``buckets`` makes hash buckets of rows that are dealt already, a few values of
        these columns to a task. ``by`` makes one directory per value.
        """
        self._count += 1
        name = f"{name}_{self._count}"
        number = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if sort:
            writer = df.repartition(number, *sort).write.bucketBy(number, *sort).sortBy(*sort)
        elif buckets:
            writer = df.write.bucketBy(_BUCKETS * number, *buckets)
        else:
            writer = df.write
        writer = writer.partitionBy(by) if by else writer
        writer.format("parquet").saveAsTable(f"{self.database}.{name}")
        self._made[name] = keep
        return self.spark.table(f"{self.database}.{name}")

    def drop_last(self, name: str) -> None:
        """Drop the table that was put last under this name, which no later use reads."""
        self.drop(next(made for made in reversed(self._made) if made.rpartition("_")[0] == name))

    def drop(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.database}.{name}")
            self._made.pop(name, None)
