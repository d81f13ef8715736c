"""Incremental ingest that reads each source file once, also over failed runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableops.sources.files import CORRUPT_RECORD
from tableops.streaming.runs import Run, run_available

_FORMATS = ("csv", "json", "parquet", "orc", "text")


def file_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    file_format: str = "parquet",
    options: Mapping[str, object] | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The files of a directory or glob as a stream, oldest first; each file is taken in once."""
    if file_format not in _FORMATS:
        raise ValueError(f"No stream of format '{file_format}', only of {', '.join(_FORMATS)}")
    reader = spark.readStream.schema(schema).format(file_format).options(columnNameOfCorruptRecord=CORRUPT_RECORD, **(options or {}))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(source)


def ingest_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    file_format: str = "parquet",
    options: Mapping[str, object] | None = None,
    partition_by: Sequence[str] = (),
    files_per_batch: int | None = None,
    stamp: bool = False,
) -> Run:
    """Append the rows of files that no earlier run with this checkpoint has read to the Parquet directory ``target``.

    Nothing has to be remembered between runs: the checkpoint knows the files. A run that fails has added nothing that a
    reader sees of the batch it was in, and the next one reads its files again, so each row is there once. Files are expected
    to be complete when they appear and never to change. ``files_per_batch`` bounds a batch; ``stamp`` adds ``source_file``.
    Read the target with ``ingested``.
    """
    rows = file_stream(spark, source, schema, file_format, options, files_per_batch)
    if stamp:
        rows = rows.withColumn("source_file", F.col("_metadata.file_name"))
    return run_available(rows, target, checkpoint, tuple(partition_by))


def ingested(spark: SparkSession, target: str) -> DataFrame:
    """What finished batches have written; files of a batch that failed are not part of it."""
    return spark.read.parquet(target)
