"""The sales job: check, transform, write, then summarise what was written."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableops.operators.aggregates import group_aggregate, stats_summary
from tableops.operators.dedup import dedup_keys
from tableops.operators.quality import validate
from tableops.operators.transforms import (
    add_date_parts,
    cast_columns,
    classify,
    derive_columns,
    fill_nulls,
    filter_rows,
    standardise_strings,
)
from tableops.operators.windows import window_columns
from tableops.plans.reports import high_value_customers, rolling_revenue, top_products
from tableops.scratch import Tables
from tableops.sinks import read_back, write_parquet

# Required columns, target types, fill values, text columns, output directories and percentiles.
REQUIRED = ("order_id", "order_date", "region", "customer_id", "product", "quantity", "unit_price")
CASTS = {"quantity": "int", "unit_price": "double", "discount": "double"}
FILLS = {"discount": 0.0, "region": "UNKNOWN"}
TEXTS = ("region", "product", "payment_method")
DIRECTORIES = ("order_year", "order_month", "region")
MONTHS = DIRECTORIES[:2]
OUTPUTS = ("regional_summary", "windowed", "top_products", "high_value_customers", "rolling_revenue", "stats")
PERCENTILES = (0.25, 0.5, 0.75, 0.95)
FILTER = "quantity > 0 AND unit_price > 0"
MAX_DIRECTORIES = 100_000  # whose names are broadcast
MONTHLY = {"revenue": ["sum", "avg", "max"], "quantity": ["sum"], "order_id": ["count"]}


def transform_sales(
    source: DataFrame,
    ingested_at: datetime | None = None,
    casts: Mapping[str, str] = CASTS,
    dedup_order: Sequence[str | Column] | None = None,
    gather: bool = False,
) -> DataFrame:
    """Clean rows with derived and classified columns, one per order.

    The casts come before the filter: text that is no number is then null and drops out, instead of failing the
    comparison. Of several rows of an order the first in ``dedup_order`` stays, by default in the order of all columns.
    ``gather`` brings the rows of an output directory together, as ``write_parquet`` does, but before the derived columns
    widen them.
    """
    present = {name: target for name, target in casts.items() if name in source.columns}
    order = list(dedup_order or [c for c in source.columns if c != "order_id"])
    clean = (
        cast_columns(source, present)
        .transform(filter_rows, FILTER)
        .transform(fill_nulls, {c: v for c, v in FILLS.items() if c in source.columns})
    )
    # Derived columns depend on their own row only: unless the order names one, the narrower rows are shuffled.
    early = all(c in source.columns for c in order if isinstance(c, str)) and all(isinstance(c, str) for c in order)
    if early:
        clean = clean.transform(dedup_keys, ["order_id"], order)
        if gather:
            clean = _gathered(clean)
    derived = clean.transform(derive_columns, ingested_at).transform(classify)
    if not early:
        derived = derived.transform(dedup_keys, ["order_id"], order)
        if gather:
            derived = _gathered(derived)
    return derived.transform(standardise_strings, TEXTS)


def _gathered(df: DataFrame) -> DataFrame:
    """The rows of a directory together, in as many tasks as they need; the region as it will be written."""
    parts = [f"__order_{part}" for part in ("year", "month", "quarter")]
    keyed = df.transform(standardise_strings, ["region"]).transform(add_date_parts, prefix="__order")
    return keyed.hint("rebalance", *parts[:2], "region").drop(*parts)


def run_sales_pipeline(
    spark: SparkSession,
    source: DataFrame,
    out_dir: str,
    casts: Mapping[str, str] = CASTS,
    dedup_order: Sequence[str | Column] | None = None,
    min_rows: int = 100,
    null_threshold: float = 0.5,
    split_windows: bool = True,
    outputs: Sequence[str] = OUTPUTS,
) -> dict[str, int]:
    """Run the job and return the rows written per output.

    Outputs under ``out_dir``: transformed, and of regional_summary, windowed, top_products, high_value_customers,
    rolling_revenue and stats those in ``outputs``, by default all. The transformed table is written first and read again
    for the rest, so that a lost executor costs no recomputation and every output reads only its columns. Directories of
    earlier runs stay, and the run's own ``ingestion_ts`` tells its rows from theirs.
    """
    unknown = sorted({*outputs} - {*OUTPUTS})
    if unknown:
        raise ValueError(f"Unknown outputs {unknown}. Choose from: {', '.join(OUTPUTS)}")
    validate(source, REQUIRED, null_threshold, min_rows)

    started = datetime.now(timezone.utc)
    transformed = transform_sales(source, started, casts, dedup_order, gather=True)
    target = f"{out_dir.rstrip('/')}/transformed"
    written = {"transformed": write_parquet(transformed, target, DIRECTORIES, gather=False)}

    columns = [*REQUIRED, "revenue", "sales_tier"]
    stored = read_back(spark, target, expected_columns=columns, schema=transformed.schema)
    with Tables(spark) as tables:
        # Looked up once for all outputs. The filter keeps all rows; it lets the joins prune the scans.
        places = stored.filter(F.col("ingestion_ts") == F.lit(started)).groupBy(*DIRECTORIES).count()
        places = tables.put(places, "places").filter("count > 0")
        if (places.agg(F.sum("count")).first()[0] or 0) != written["transformed"]:
            raise ValueError("The files of the transformed table do not hold the rows that were written")
        sales = of_run(stored, started, places)
        if "regional_summary" in outputs:
            # A directory per month holds all its regions. The months of the run are summed up anew from all that is stored of them.
            months = in_directories(stored, places, MONTHS)
            regional = group_aggregate(months, ["region", *MONTHS], MONTHLY)
            written["regional_summary"] = write_parquet(regional, f"{out_dir}/regional_summary", MONTHS)
        makers = {
            "windowed": lambda: window_columns(
                sales, "region", "order_date", "revenue", tie_break=["order_id"], split=split_windows, tables=tables
            ),
            "top_products": lambda: top_products(sales),
            "high_value_customers": lambda: high_value_customers(sales),
            "rolling_revenue": lambda: rolling_revenue(sales),
            "stats": lambda: stats_summary(sales, ["revenue", "quantity", "unit_price"], PERCENTILES),
        }
        for name, make in makers.items():
            if name in outputs:
                written[name] = write_parquet(make(), f"{out_dir}/{name}")
    return written


def of_run(stored: DataFrame, started: datetime, places: DataFrame | None = None) -> DataFrame:
    """Rows of the transformed table that a run wrote.

    The run replaced whole directories, so its rows are all rows of the directories that hold one of them: a scan of
    ``ingestion_ts`` alone finds these, and the semi join prunes the wider scans to them. ``places`` has them already.
    """
    own = stored.filter(F.col("ingestion_ts") == F.lit(started))
    return in_directories(own, own if places is None else places, DIRECTORIES)


def in_directories(rows: DataFrame, own: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Those of ``rows`` whose directory by ``columns`` holds one of ``own``; counts the directories.

    The join prunes the scan of ``rows``. A null is a directory of its own, which no equality finds.
    """
    where = own.select(*[F.col(c).alias(f"__{c}") for c in columns]).distinct()
    if where.count() <= MAX_DIRECTORIES:
        where = F.broadcast(where)
    pruned = rows.join(where, [F.col(c) == F.col(f"__{c}") for c in columns], "left_semi")
    undated = rows.filter(" OR ".join(f"{c} IS NULL" for c in columns))
    return pruned.unionByName(undated.join(where, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns], "left_semi"))
