"""Order columns as plain numbers, for grids and blocks."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DAY = 86_400_000_000  # microseconds


def position(column: Column, kind: T.DataType) -> Column:
    """A number that grows with the value: days of a date, microseconds of a timestamp, the number itself.

    Whole numbers come as long. No time zone takes part in a timestamp without one, so no hour is skipped or met twice.
    """
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        day = F.unix_date(column.cast("date")).cast("long") * F.lit(_DAY).cast("long")
        second = (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("long")
        return day + F.hour(column) * F.lit(3_600_000_000).cast("long") + F.minute(column) * F.lit(60_000_000).cast("long") + second
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return column.cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return column.cast("double")
    if isinstance(kind, T.DecimalType):
        return column
    raise ValueError(f"No grid over values of type {kind.simpleString()}")


def position_of(df: DataFrame, name: str) -> Column:
    return position(F.col(f"`{name}`"), df.schema[name].dataType)


def distance(value: object, kind: T.DataType) -> object:
    """A distance between positions of this type: a timedelta in days or microseconds, a number as it is."""
    if isinstance(value, timedelta):
        micros = value // timedelta(microseconds=1)
        if isinstance(kind, T.DateType):
            if micros % _DAY:
                raise ValueError("Dates are whole days apart")
            return micros // _DAY
        return micros
    return value
