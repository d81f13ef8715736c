"""Summaries of a partitioned table that are kept up directory by directory.

States that can be merged (sums, counts, extremes, quantile and distinct sketches) are stored for each directory of the table,
with a mark of the files they were made from. A refresh lists the files, without reading them, and makes the states anew only
for directories whose files have changed. Summaries of any coarser grouping come from the states alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableops.scratch import stored
from tableops.sinks import write_parquet

QUANTILE_SIZE, DISTINCT_BITS = 1024, 14  # of the sketches: a rank error of about 0.3 %, a count error of about 0.8 %
MAX_CHANGED = 10_000  # directories whose names are collected to prune the read; if more have changed, all are read
_PLACE, _MARK = "__place", "__mark"


@dataclass(frozen=True)
class Kept:
    """What a summary keeps: the grouping within a directory, and the columns of each kind of state.

    ``totals`` have a sum, count, least and largest value; ``quantiles`` a sketch of ranks; ``distinct`` one of distinct values.
    """

    directories: tuple[str, ...]
    by: tuple[str, ...] = ()
    totals: tuple[str, ...] = ()
    quantiles: tuple[str, ...] = ()
    distinct: tuple[str, ...] = ()

    def states(self) -> list[Column]:
        made = [F.count(F.lit(1)).alias("rows")]
        for c in self.totals:
            made += [F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"count_{c}"), F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
        made += [F.kll_sketch_agg_double(F.col(c).cast("double"), QUANTILE_SIZE).alias(f"ranks_{c}") for c in self.quantiles]
        return made + [F.hll_sketch_agg(F.col(c).cast("string"), DISTINCT_BITS).alias(f"values_{c}") for c in self.distinct]

    def merged(self) -> list[Column]:
        made = [F.sum("rows").alias("rows")]
        for c in self.totals:
            made += [F.sum(f"sum_{c}").alias(f"sum_{c}"), F.sum(f"count_{c}").alias(f"count_{c}"), F.min(f"min_{c}").alias(f"min_{c}"), F.max(f"max_{c}").alias(f"max_{c}")]
        made += [F.kll_merge_agg_double(f"ranks_{c}", QUANTILE_SIZE).alias(f"ranks_{c}") for c in self.quantiles]
        return made + [F.hll_union_agg(f"values_{c}").alias(f"values_{c}") for c in self.distinct]


@dataclass(frozen=True)
class Refreshed:
    """Directories whose states a refresh made anew, those that it left, and those that are gone from the table."""

    changed: int
    same: int
    gone: int


def directory_marks(spark: SparkSession, path: str, directories: Sequence[str]) -> DataFrame:
    """(directories as text, mark) of each directory with files; the mark changes with the files' names, sizes and times."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    files = files.select("path", F.xxhash64("path", "length", "modificationTime").alias("file"))
    parts = [F.url_decode(F.regexp_extract("path", f"/{d}=([^/]*)/", 1)).alias(d) for d in directories]
    return files.groupBy(*parts).agg(F.bit_xor("file").alias(_MARK), F.count(F.lit(1)).alias("files"))



def _known(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _places(directories: Sequence[str]) -> list[Column]:
    """The values of directory columns as their directories spell them."""
    return [F.coalesce(F.col(d).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")) for d in directories]


def refresh_states(spark: SparkSession, path: str, states: str, kept: Kept, schema: T.StructType | None = None) -> Refreshed:
    """Bring the states at ``states`` up to date with the Parquet table at ``path``, reading its changed directories only.

    The marks are replaced last, so a refresh that fails midway does its directories again. Run one refresh at a time.
    """
    marks = stored(directory_marks(spark, path, kept.directories), "marks")
    old = _known(spark, f"{states}/marks", marks.schema)
    keys = list(kept.directories)
    new, gone = marks.join(old, [*keys, _MARK, "files"], "left_anti"), old.join(marks, keys, "left_anti").count()
    changed, total = new.count(), marks.count()
    if changed:
        table = spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
        place = F.concat_ws("/", *_places(keys))
        if changed <= MAX_CHANGED:  # a filter on directory columns prunes the scan
            rows = table.where(place.isin([r[0] for r in new.select(F.concat_ws("/", *keys)).collect()]))
        else:
            rows = table.join(new.select(F.concat_ws("/", *keys).alias(_PLACE)), place == F.col(_PLACE), "left_semi")
        write_parquet(rows.groupBy(*keys, *kept.by).agg(*kept.states()), f"{states}/states", keys)
    if changed or gone:
        write_parquet(marks, f"{states}/marks", dynamic=False)
    return Refreshed(changed, total - changed, gone)


def summarise(
    spark: SparkSession, states: str, kept: Kept, by: Sequence[str] = (), quantiles: Mapping[str, Sequence[float]] | None = None
) -> DataFrame:
    """The states merged by any of the directory and grouping columns: totals, percentiles ``p{n}_{column}`` and ``distinct_{column}``.

    Directories that the table no longer has are left out.
    """
    keys = list(kept.directories)
    rows = spark.read.parquet(f"{states}/states")
    places = spark.read.parquet(f"{states}/marks").select(F.concat_ws("/", *keys).alias(_PLACE))
    there = rows.join(places, F.concat_ws("/", *_places(keys)) == F.col(_PLACE), "left_semi")
    merged = there.groupBy(*by).agg(*kept.merged())
    totals = [f"{m}_{c}" for c in kept.totals for m in ("sum", "count", "min", "max")]
    ranks = [
        F.kll_sketch_get_quantile_double(F.col(f"ranks_{c}"), F.lit(float(p))).alias(f"p{f'{round(p * 100, 6):g}'.replace('.', '_')}_{c}")
        for c, shares in (quantiles or {}).items()
        for p in shares
    ]
    return merged.select(*by, "rows", *totals, *ranks, *[F.hll_sketch_estimate(f"values_{c}").alias(f"distinct_{c}") for c in kept.distinct])
