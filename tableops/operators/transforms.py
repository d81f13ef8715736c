"""Row-wise operators: filter, project, cast, null handling, derived columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableops import functions as fn

_DEFAULT_FILL_TYPES = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
_INTEGRAL_NAMES = {"byte", "tinyint", "short", "smallint", "int", "integer", "long", "bigint"}
_INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def filter_rows(df: DataFrame, condition: str) -> DataFrame:
    """Rows where the SQL condition is true; null counts as false."""
    return df.filter(condition)


def select_rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the columns of ``names`` under their new names, in mapping order."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def cast_columns(df: DataFrame, casts: Mapping[str, str | T.DataType]) -> DataFrame:
    """Cast columns in place; a value that does not fit becomes null instead of failing the job."""
    return df.withColumns({name: _safe_cast(df.schema[name], target) for name, target in casts.items()})


def _safe_cast(field: T.StructField, target: str | T.DataType) -> Column:
    column = F.col(f"`{field.name}`")
    cast = column.try_cast(target)
    integral = target.lower() in _INTEGRAL_NAMES if isinstance(target, str) else isinstance(target, _INTEGRAL_TYPES)
    if integral and isinstance(field.dataType, T.StringType):
        # Text such as '2.7' is no integer to try_cast; cut the fraction off, as a cast from a number does. Text with an
        # exponent stays null.
        fraction = F.when(column.rlike(r"^\s*[+-]?\d+\.\d*\s*$"), column.try_cast("decimal(38,18)").try_cast(target))
        cast = F.coalesce(cast, fraction)
    return cast


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any of the columns; all columns by default."""
    return df.dropna(subset=list(subset) if subset else None)


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls (and NaN) per column."""
    if not values:
        raise ValueError("fill_nulls needs at least one column and value")
    return df.fillna(dict(values))


def fill_nulls_default(
    df: DataFrame, number: float = 0, text: str = "UNKNOWN", all_numeric: bool = False
) -> DataFrame:
    """Replace nulls by type. ``all_numeric`` also covers byte, short and decimal columns."""
    numeric_types = T.NumericType if all_numeric else _DEFAULT_FILL_TYPES
    numeric = [f.name for f in df.schema if isinstance(f.dataType, numeric_types)]
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.fillna(number, subset=numeric).fillna(text, subset=strings)


def handle_nulls(
    df: DataFrame,
    strategy: str = "fill",
    values: Mapping[str, object] | None = None,
    subset: Sequence[str] | None = None,
) -> DataFrame:
    """Null handling by strategy name: ``drop``, ``fill`` or ``fill_default``."""
    if strategy == "drop":
        return drop_nulls(df, subset)
    if strategy == "fill":
        return fill_nulls(df, values or {})
    if strategy == "fill_default":
        return fill_nulls_default(df)
    raise ValueError(f"Unknown null strategy '{strategy}'. Choose from: drop, fill, fill_default")


def add_revenue(
    df: DataFrame, quantity: str = "quantity", unit_price: str = "unit_price", discount: str = "discount"
) -> DataFrame:
    """Add ``revenue``; without a discount column there is no discount."""
    rebate = F.col(discount) if discount in df.columns else None
    return df.withColumn("revenue", fn.revenue(F.col(quantity), F.col(unit_price), rebate))


def add_profit_margin(df: DataFrame, quantity: str = "quantity", unit_price: str = "unit_price") -> DataFrame:
    """Add ``profit_margin`` from ``revenue``."""
    return df.withColumn("profit_margin", fn.profit_margin(F.col("revenue"), F.col(quantity), F.col(unit_price)))


def add_date_parts(df: DataFrame, date: str = "order_date", prefix: str = "order") -> DataFrame:
    """Add ``{prefix}_year``, ``{prefix}_month`` and ``{prefix}_quarter``; null where the text is no date."""
    day = fn.to_date_or_null(F.col(date))
    return df.withColumns(
        {f"{prefix}_year": F.year(day), f"{prefix}_month": F.month(day), f"{prefix}_quarter": F.quarter(day)}
    )


def add_age_band(df: DataFrame, age: str = "customer_age") -> DataFrame:
    """Add ``age_bucket``."""
    return df.withColumn("age_bucket", fn.age_band(F.col(age)))


def add_ingestion_ts(df: DataFrame, at: datetime | None = None) -> DataFrame:
    """Add ``ingestion_ts``: the given moment, or the start of the query that runs the plan."""
    return df.withColumn("ingestion_ts", F.current_timestamp() if at is None else F.lit(at))


def derive_columns(df: DataFrame, ingested_at: datetime | None = None) -> DataFrame:
    """All derived columns whose inputs the table has."""
    if {"quantity", "unit_price"} <= set(df.columns):
        df = add_profit_margin(add_revenue(df))
    if "order_date" in df.columns:
        df = add_date_parts(df)
    if "customer_age" in df.columns:
        df = add_age_band(df)
    return add_ingestion_ts(df, ingested_at)


def classify(df: DataFrame) -> DataFrame:
    """Tier, payment flag and discount level, for those of the inputs the table has."""
    labels = {
        "revenue": ("sales_tier", fn.revenue_tier),
        "payment_method": ("payment_flag", fn.payment_flag),
        "discount": ("discount_level", fn.discount_level),
    }
    found = {name: rule(F.col(source)) for source, (name, rule) in labels.items() if source in df.columns}
    return df.withColumns(found) if found else df


def standardise_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trim and upper-case the given columns; names the table lacks are skipped."""
    present = {c: F.upper(F.trim(F.col(c))) for c in columns if c in df.columns}
    return df.withColumns(present) if present else df
