"""Sliding aggregates over frames of values: of the rows of a group whose order value is within a distance of the row's own.

Spark's own RANGE window keeps a group in one task and adds up each frame anew. Here rows are first added up per group and
order value. Groups of few order values then take Spark's window, which costs one shuffle of these sums and at most FEW_PLACES
additions a row. Of larger groups, the order axis is cut into blocks as long as a frame, so a frame is the end of one block and the beginning of the
next: running aggregates from the start of a block, and from its end, answer it with two values, and nothing is subtracted.
Blocks are dealt into chunks of one order and the running values are carried across chunks, so no task holds a whole group or
block. The two values are looked up by as-of joins, which split the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableops.functions.positions import distance, position_of
from tableops.operators.asof import asof_join
from tableops.scratch import Tables, stored

AGGREGATES = ("sum", "avg", "count", "min", "max")
_STATES = ("n", "sum", "min", "max")
FEW_PLACES = 1_000  # order values of a group that Spark's own window adds up


def range_frame(
    df: DataFrame,
    partition_by: str | Sequence[str],
    order_by: str,
    value: str,
    before: object,
    after: object = 0,
    aggregates: Sequence[str] = ("sum", "avg", "max"),
    tables: Tables | None = None,
) -> DataFrame:
    """Add ``{aggregate}_{value}`` over the group's rows from ``before`` less to ``after`` more than the row's ``order_by``.

    As in SQL's RANGE frames, rows with an equal order value share a frame, null values of ``value`` do not count, and rows with
    a null order have all such rows of their group as their frame. Null groups are a group. ``order_by`` is a date, timestamp,
    whole number or decimal; ``before`` and ``after`` are days, microseconds or numbers, or a timedelta, not negative. A sum has the type of
    Spark's sum, an average is a double or, of decimals, a decimal.

    Runs jobs when called, which write to ``tables``, or else to tables of their own in ``spark.checkpoint.dir``.
    """
    group = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    unknown = sorted({*aggregates} - {*AGGREGATES})
    names = [f"{a}_{value}" for a in aggregates]
    if unknown or not aggregates:
        raise ValueError(f"Unknown aggregates {unknown}. Choose from: {', '.join(AGGREGATES)}")
    if taken := sorted({*names} & {*df.columns}):
        raise ValueError(f"Columns already present: {taken}")
    kind = df.schema[order_by].dataType
    low, high = (distance(x, kind) for x in (before, after))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        raise ValueError("Blocks need exact order values: cast floating ones to a decimal")
    if low < 0 or high < 0:
        raise ValueError("before and after must not be negative")

    states = (tables.put if tables else stored)(_states(df, group, order_by, value), "frame_states")
    dated = states.where("at IS NOT NULL")
    totals = _framed(dated, low, high, tables) if low + high else dated.select("group", "at", *_STATES)
    undated = states.where("at IS NULL").select("group", "at", *_STATES)
    totals = totals.unionByName(undated).select(
        F.col("group").alias("__group"), F.col("at").alias("__at"), F.struct(*_STATES).alias("__frame")
    )
    # Null-safe: an undated row joins by a flag. The totals have each key once, and Spark splits the rows of a hot one.
    rows = df.withColumns({"__group": F.struct(*[F.col(f"`{c}`") for c in group]), "__at": position_of(df, order_by)})
    joined = _flagged(rows).join(_flagged(totals), ["__group", "__at", "__undated"])
    frame = F.col("__frame")
    total = frame["sum"].cast(df.select(F.sum(f"`{value}`")).schema[0].dataType)
    results = {
        "sum": total,
        "avg": F.when(frame["n"] > 0, total / frame["n"]),
        "count": frame["n"],
        "min": frame["min"],
        "max": frame["max"],
    }
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[results[a].alias(n) for a, n in zip(aggregates, names)])


def _flagged(rows: DataFrame) -> DataFrame:
    nothing = F.lit(0).cast(rows.schema["__at"].dataType)
    return rows.withColumn("__undated", F.col("__at").isNull()).withColumn("__at", F.coalesce("__at", nothing))


def _states(df: DataFrame, group: list[str], order_by: str, value: str) -> DataFrame:
    """(group, at, n, sum, min, max) of each group and order value; partial sums come before the shuffle."""
    v = F.col(f"`{value}`")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in group]).alias("group"), position_of(df, order_by).alias("at"), v.alias("v"))
    return rows.groupBy("group", "at").agg(F.count("v").alias("n"), F.sum("v").alias("sum"), F.min("v").alias("min"), F.max("v").alias("max"))


def _merge(a: Column, b: Column) -> Column:
    """Two states of which either may be null."""

    def both(name: str, merged: Column) -> Column:
        return F.coalesce(merged, a[name], b[name]).alias(name)

    return F.struct(
        both("n", a["n"] + b["n"]),
        both("sum", a["sum"] + b["sum"]),
        F.least(a["min"], b["min"]).alias("min"),
        F.greatest(a["max"], b["max"]).alias("max"),
    )


def _running(order: list[Column], by: list[str], until: int) -> Column:
    """Aggregates from the first row in order up to this one (until = 0) or the one before it (-1)."""
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, until)
    return F.struct(F.sum("n").over(window).alias("n"), F.sum("sum").over(window).alias("sum"), F.min("min").over(window).alias("min"), F.max("max").over(window).alias("max"))


def _framed(states: DataFrame, low: object, high: object, tables: Tables | None) -> DataFrame:
    """(group, at, n, sum, min, max) of the frames [at - low, at + high]; groups of many places are split. Runs a job."""
    many = states.groupBy("group").count().where(F.col("count") > FEW_PLACES).select("group")
    many = (tables.put if tables else stored)(many, "frame_large")
    if many.isEmpty():
        return _windowed(states, low, high)
    same = states["group"].eqNullSafe(many["group"])
    few, rest = (states.join(many, same, how) for how in ("left_anti", "left_semi"))
    return _windowed(few, low, high).unionByName(_sliding(rest, low, high, tables))


def _windowed(states: DataFrame, low: object, high: object) -> DataFrame:
    """The frames by Spark's own window."""
    kind = states.schema["at"].dataType.simpleString()
    frame = f"(PARTITION BY group ORDER BY at RANGE BETWEEN CAST({low} AS {kind}) PRECEDING AND CAST({high} AS {kind}) FOLLOWING)"
    merged = {"n": "sum(n)", "sum": "sum(sum)", "min": "min(min)", "max": "max(max)"}
    return states.select("group", "at", *[F.expr(f"{how} OVER {frame}").alias(c) for c, how in merged.items()])


def _sliding(states: DataFrame, low: object, high: object, tables: Tables | None) -> DataFrame:
    """(group, at, n, sum, min, max) of the frames [at - low, at + high]."""
    width, save = low + high, tables.put if tables else stored
    kind = states.schema["at"].dataType

    def block(at: Column) -> Column:
        """Where the block of a place begins; exact for whole numbers and decimals."""
        return (at - F.pmod(at, F.lit(width))).cast(kind)

    # Equal places cannot part: each group and place is one row here.
    dealt = states.withColumn("block", block(F.col("at"))).repartitionByRange("group", "at").withColumn("chunk", F.spark_partition_id())
    dealt = save(dealt, "frame_chunks")
    keys = ["group", "block"]
    parts = dealt.groupBy(*keys, "chunk").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"), F.min("min").alias("min"), F.max("max").alias("max"))
    parts = parts.select(  # a row per block and chunk: few chunks share a block
        *keys,
        "chunk",
        _running([F.asc("chunk")], keys, -1).alias("earlier"),
        _running([F.desc("chunk")], keys, -1).alias("later"),
    ).where("earlier.n IS NOT NULL OR later.n IS NOT NULL")
    inside = dealt.select(
        *keys,
        "chunk",
        "at",
        _running([F.asc("at")], [*keys, "chunk"], 0).alias("from_start"),
        _running([F.desc("at")], [*keys, "chunk"], 0).alias("from_end"),
    ).join(parts, [*keys, "chunk"], "left")
    placed = inside.select(
        *keys,
        "at",
        _merge(F.col("earlier"), F.col("from_start")).alias("from_start"),
        _merge(F.col("later"), F.col("from_end")).alias("from_end"),
    )
    placed = save(placed, "frame_running")

    ends = placed.select("group", F.col("at").alias("row_at"), (F.col("at") - F.lit(low)).alias("low"), (F.col("at") + F.lit(high)).alias("high"))
    first = block(F.col("low"))
    asked = ends.select("group", "row_at", "low", "high", first.alias("block"))
    tail = asof_join(asked, placed.select(*keys, "at", "from_end"), keys, "low", "at", direction="forward", tables=tables).drop("at")
    tail = tail.withColumn("block", block(F.col("high")))
    both = asof_join(tail, placed.select(*keys, "at", "from_start"), keys, "high", "at", tables=tables)
    # A frame is as long as a block, so it begins in one and ends in the next.
    state = _merge(F.col("from_end"), F.col("from_start"))
    return both.select("group", F.col("row_at").alias("at"), state.alias("s")).select("group", "at", *[F.col("s")[c].alias(c) for c in _STATES])
