"""Upserts by key into a partitioned Parquet table that stays readable throughout.

Every upsert writes the directories it changes anew under a version of its own, and then one small file that names the version
of each directory. Readers follow the newest such file, so they see an upsert as a whole or not at all, and a failed one leaves
the table as it was. Which directories hold changed keys comes from the table's key columns alone, behind a Bloom filter of
the changes; all other directories are neither read further nor written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableops.operators.bloom import bloom_join
from tableops.operators.dedup import dedup_keys
from tableops.operators.quality import require_columns
from tableops.scratch import stored
from tableops.sinks import write_parquet

MAX_NAMED = 10_000  # directories that a filter names to prune a read; beyond that a join chooses them
_VERSION, _SNAPSHOT, _PLACE = "__version", "__snapshot", "__place"


@dataclass(frozen=True)
class KeyedTable:
    """A table at ``path`` with one row per key, in one directory per value of ``directories``."""

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    directories: tuple[str, ...]


@dataclass(frozen=True)
class Upserted:
    """The version an upsert made, the rows it replaced and added, and the directories it wrote and left."""

    version: int
    replaced: int
    added: int
    written: int
    left: int


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _place(table: KeyedTable, *more: str) -> Column:
    """One text per directory; lengths keep apart values that contain the separator."""
    values = [F.col(f"`{c}`").cast("string") for c in (*more, *table.directories)]
    return F.concat_ws("/", *[F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values])


def _named(table: KeyedTable) -> T.StructType:
    fields = [table.schema[c] for c in table.directories]
    return T.StructType([*fields, T.StructField(_VERSION, T.LongType()), T.StructField(_SNAPSHOT, T.LongType())])


def _newest(spark: SparkSession, table: KeyedTable) -> tuple[int, DataFrame]:
    """The newest snapshot's number, 0 if there is none, and its (directories, version) rows."""
    snapshots = _read(spark, f"{table.path}/current", _named(table))
    number = snapshots.agg(F.max(_SNAPSHOT).alias("n")).first()["n"] or 0
    return number, snapshots.where(F.col(_SNAPSHOT) == number).drop(_SNAPSHOT)


def _rows_of(spark: SparkSession, table: KeyedTable, named: DataFrame) -> DataFrame:
    """The rows of the directories in ``named`` (directories, version); few ones prune the scan by a filter, many by a join."""
    schema = T.StructType([*table.schema.fields, T.StructField(_VERSION, T.LongType())])
    rows = _read(spark, f"{table.path}/rows", schema)
    places = named.select(_place(table, _VERSION).alias(_PLACE))
    if places.count() <= MAX_NAMED:
        return rows.where(_place(table, _VERSION).isin([r[0] for r in places.collect()]))
    return rows.join(places, _place(table, _VERSION) == F.col(_PLACE), "left_semi")


def read_current(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """The table as the last finished upsert left it; empty before the first one."""
    return _rows_of(spark, table, _newest(spark, table)[1]).select(*[F.col(f"`{c}`") for c in table.schema.names])


def _checked(table: KeyedTable, changes: DataFrame, order_by: Sequence[str | Column] | None) -> DataFrame:
    require_columns(changes, table.schema.names)
    rows = dedup_keys(changes, table.keys, order_by) if order_by else changes
    rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in table.schema])
    texts = [c for c in table.directories if isinstance(table.schema[c].dataType, T.StringType)]
    rows = stored(rows.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit("")) for c in texts}), "changes")
    unknown = [F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in table.keys]
    if any(rows.agg(*unknown).first()):
        raise ValueError("Keys must not be null")
    if not order_by and not rows.groupBy(*table.keys).count().where("count > 1").isEmpty():
        raise ValueError("Several changes have the same key: give order_by to choose the first of them")
    return rows


def _publish(named: DataFrame, table: KeyedTable, number: int) -> None:
    """The snapshot as one file, which appears whole: a row per directory."""
    named.withColumn(_SNAPSHOT, F.lit(number)).coalesce(1).write.mode("append").partitionBy(_SNAPSHOT).parquet(f"{table.path}/current")


def upsert(spark: SparkSession, table: KeyedTable, changes: DataFrame, order_by: Sequence[str | Column] | None = None) -> Upserted:
    """Replace the rows whose keys are in ``changes`` and add the others; runs jobs. Run one upsert at a time.

    ``changes`` has all columns of the table; more are ignored. Of changes with the same key the first by ``order_by`` counts;
    without it they are refused, as null keys are. Empty text in a directory column becomes null, as directories cannot tell them
    apart. A row may move to another directory, and a directory that loses its
    last row is gone. No changes make no version.
    """
    changes = _checked(table, changes, order_by)
    total = changes.count()
    number, live = _newest(spark, table)
    live = stored(live, "live")
    if not total:
        return Upserted(number, 0, 0, 0, live.count())
    keys, places = list(table.keys), [F.col(f"`{c}`") for c in table.directories]
    held = _rows_of(spark, table, live).select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keys, *table.directories])])
    held = bloom_join(held, changes.select(*keys), keys, "semi", expected_keys=total)
    held = stored(held.groupBy(*places).agg(F.count(F.lit(1)).alias("n")), "held")
    replaced = held.agg(F.sum("n").alias("n")).first()["n"] or 0
    touched = stored(held.select(*places).union(changes.select(*places)).distinct().select(_place(table).alias(_PLACE)), "touched")

    by_place = _place(table) == F.col(_PLACE)
    old = _rows_of(spark, table, live.join(touched, by_place, "left_semi")).drop(_VERSION)
    kept = bloom_join(old, changes.select(*keys), keys, "anti", expected_keys=total)
    version = number + 1
    target = f"{table.path}/rows/{_VERSION}={version}"
    write_parquet(kept.unionByName(changes), target, list(table.directories), dynamic=False)  # replaces what a failed one left
    written = stored(_read(spark, target, table.schema).select(*places).distinct(), "written")
    left = live.join(touched, by_place, "left_anti")
    _publish(left.unionByName(written.withColumn(_VERSION, F.lit(version).cast("long"))), table, version)
    return Upserted(version, replaced, total - replaced, written.count(), left.count())


def unused_files(spark: SparkSession, table: KeyedTable) -> DataFrame:
    """(path, length) of row files in directories that the newest snapshot does not name: they may go once no reader needs them."""
    live = _newest(spark, table)[1].select(_place(table, _VERSION).alias(_PLACE))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
    files = files.load(f"{table.path}/rows").select("path", "length")
    for c in (_VERSION, *table.directories):
        value = F.url_decode(F.regexp_extract("path", f"/{c}=([^/]*)/", 1))
        files = files.withColumn(c, F.when(value != "__HIVE_DEFAULT_PARTITION__", value))
    return files.join(live, _place(table, _VERSION) == F.col(_PLACE), "left_anti").select("path", "length")
