"""File sources. All readers are lazy; only schema inference reads data when called."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_RECORD = "_corrupt_record"
_MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")
_FORMATS = ("csv", "json", "parquet", "orc")

# Date and time patterns of the text formats.
_CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"
_JSON_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss"
_DATE = "yyyy-MM-dd"


def _checked_mode(mode: str) -> str:
    if mode.upper() not in _MODES:
        raise ValueError(f"Unknown mode '{mode}'. Choose from: {', '.join(_MODES)}")
    return mode.upper()


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    header: bool = True,
    infer_schema: bool = True,
    mode: str = "PERMISSIVE",
    delimiter: str = ",",
    keep_corrupt: bool = False,
    quote: str = '"',
    escape: str = "\\",
    multiline: bool = False,
) -> DataFrame:
    """CSV file, directory or glob; an empty field is null.

    Fields with the delimiter in them are quoted; ``escape`` comes before a quote within one, ``escape='"'`` reads doubled
    quotes. Quoted line breaks need ``multiline``, which reads each file in one task.

    Give a schema for large inputs: inference reads them once more, and one bad field turns its column into text.
    ``keep_corrupt`` adds ``_corrupt_record``, the text of rows that do not fit (``PERMISSIVE`` only).
    """
    mode = _checked_mode(mode)
    options = {
        "header": header,
        "mode": mode,
        "sep": delimiter,
        "quote": quote,
        "escape": escape,
        "multiLine": multiline,
        "nullValue": "",
        "emptyValue": "",
        "timestampFormat": _CSV_TIMESTAMP,
        "timestampNTZFormat": _CSV_TIMESTAMP,
        "dateFormat": _DATE,
        "columnNameOfCorruptRecord": CORRUPT_RECORD,
        # A pruned scan parses only the columns a query needs and so misses bad ones: a count would keep rows that
        # a full read drops.
        "columnPruning": mode != "DROPMALFORMED",
    }
    if schema is None:
        found = spark.read.options(inferSchema=infer_schema, **options).csv(path)
        if not keep_corrupt or mode != "PERMISSIVE":
            return found
        schema = found.schema
    if keep_corrupt and mode == "PERMISSIVE" and CORRUPT_RECORD not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT_RECORD, T.StringType())])
    return spark.read.schema(schema).options(**options).csv(path)


def scan_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multiline: bool = False,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """One JSON record per line, or whole documents with ``multiline``.

    Lines split over tasks; a multi-line file is read by one task, so keep such files small. Without a schema Spark
    infers one, with ``_corrupt_record`` if a line is no JSON.
    """
    reader = spark.read.options(
        multiLine=multiline,
        mode=_checked_mode(mode),
        columnNameOfCorruptRecord=CORRUPT_RECORD,
        timestampFormat=_JSON_TIMESTAMP,
        timestampNTZFormat=_JSON_TIMESTAMP,
    )
    return (reader.schema(schema) if schema is not None else reader).json(path)


def scan_files(
    spark: SparkSession,
    path: str,
    file_format: str = "parquet",
    schema: T.StructType | None = None,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """Any file format Spark knows, from a local path or an object store (``s3a://``, ``wasbs://``, ``gs://``)."""
    reader = spark.read.format(file_format).options(**(options or {}))
    return (reader.schema(schema) if schema is not None else reader).load(path)


def scan(
    spark: SparkSession, path: str, file_format: str = "csv", schema: T.StructType | None = None, **options
) -> DataFrame:
    """Read ``csv``, ``json``, ``parquet`` or ``orc`` by name, in any case, with that reader's keyword arguments."""
    name = file_format.lower()
    if name not in _FORMATS:
        raise ValueError(f"No reader for format '{file_format}', only for {', '.join(_FORMATS)}")
    if name == "csv":
        return scan_csv(spark, path, schema, **options)
    if name == "json":
        return scan_json(spark, path, schema, **options)
    return scan_files(spark, path, name, schema, **options)


def scan_incremental(
    spark: SparkSession,
    path: str,
    watermark_column: str,
    last_value: object,
    file_format: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Rows whose watermark is strictly above ``last_value``; a null watermark is not.

    The value takes the column's type, so the filter reaches the file scan and skips files and row groups by their
    statistics. Partition the files by the watermark, or sort by it, to skip most of them.
    """
    df = scan_files(spark, path, file_format, schema)
    column = F.col(watermark_column)
    return df.filter(column > F.lit(last_value).cast(df.select(column).schema[0].dataType))
