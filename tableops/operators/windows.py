"""Ranking, offset and running-total columns per group.

Two exact plans give the same columns:

* **plain**: Spark's window functions over the whole group. One shuffle, but each group is one task.
* **split**: rows are range-partitioned by group and order, so that a large group is spread over many chunks. The
  window functions run inside a chunk, and one small row per chunk carries what earlier and later chunks add: rows,
  distinct order values, totals and the edge values for lag and lead. Chunks are stored as hash buckets, so their rows
  are shuffled once; only groups of several chunks, two per border at most, have carried rows, which are broadcast.

The ranking order is ``order_by`` descending, then ``tie_break`` and ``value`` ascending; the running total follows
the exact reverse. ``rank`` and ``dense_rank`` look at ``order_by`` only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableops.scratch import Tables

PLAIN_ROWS = 2_000_000  # of a group: what the plain plan gives to one task
_SOURCE, _CHUNK, _GROUP, _KEY = "__source", "__chunk", "__group", "__order"
_WINDOW_COLUMNS = ("row_num", "rank", "dense_rank", "running_total")


@dataclass(frozen=True)
class _Spec:
    """Column names and offsets of one request."""

    group: list[str]
    order: str
    ties: list[str]
    value: str
    lag: int
    lead: int

    def ranked(self) -> list[Column]:
        return [F.col(self.order).desc(), *[F.col(c).asc() for c in self._tail()]]

    def rising(self) -> list[Column]:
        return [F.col(self.order).asc(), *[F.col(c).desc() for c in self._tail()]]

    def _tail(self) -> list[str]:
        return list(dict.fromkeys(c for c in [*self.ties, self.value] if c != self.order))


def window_columns(
    df: DataFrame,
    partition_by: str | Sequence[str],
    order_by: str,
    value: str = "revenue",
    lag: int = 1,
    lead: int = 1,
    tie_break: Sequence[str] = (),
    split: bool | None = True,
    tables: Tables | None = None,
) -> DataFrame:
    """Add ``row_num``, ``rank``, ``dense_rank``, ``lag_{value}``, ``lead_{value}`` and ``running_total``.

    Lag and lead look along the descending order, so lag gives the row with the next higher ``order_by``. Positions
    are longs: a group may have more rows than an int can count when it is split.

    The split plan holds for groups of any size; it runs one job when called, which writes the range-partitioned rows to
    ``tables`` (dropped when the caller leaves that context) or else to a table of its own in ``spark.checkpoint.dir``.
    ``split=False`` is for groups that each fit one task. ``split=None`` runs a job that counts the rows of the largest group,
    and splits beyond ``PLAIN_ROWS``.
    """
    group = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    if lag < 1 or lead < 1:
        raise ValueError("lag and lead must be at least 1")
    taken = sorted(set(df.columns) & {*_WINDOW_COLUMNS, f"lag_{value}", f"lead_{value}"})
    if taken:
        raise ValueError(f"Columns already present: {taken}")
    spec = _Spec(group, order_by, list(tie_break), value, lag, lead)

    if split is None:
        split = _largest(df, group) > PLAIN_ROWS
    return _split(df, spec, tables) if split else _plain(df, spec)


def _largest(df: DataFrame, group: list[str]) -> int:
    return df.groupBy(*group).count().agg(F.max("count")).first()[0] or 0


def _plain(df: DataFrame, spec: _Spec) -> DataFrame:
    ranked = Window.partitionBy(*spec.group).orderBy(*spec.ranked())
    by_value = Window.partitionBy(*spec.group).orderBy(F.col(spec.order).desc())
    rising = Window.partitionBy(*spec.group).orderBy(*spec.rising())
    until_here = rising.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        # The running total first: the ranking columns then share the last of the two sorts.
        df.withColumn("running_total", F.sum(spec.value).over(until_here))
        .withColumns(
            {
                "row_num": F.row_number().over(ranked).cast("long"),
                f"lag_{spec.value}": F.lag(spec.value, spec.lag).over(ranked),
                f"lead_{spec.value}": F.lead(spec.value, spec.lead).over(ranked),
            }
        )
        .withColumns(
            {"rank": F.rank().over(by_value).cast("long"), "dense_rank": F.dense_rank().over(by_value).cast("long")}
        )
        .select(*_output(df, spec))
    )


def _output(df: DataFrame, spec: _Spec) -> list[str]:
    added = ["row_num", "rank", "dense_rank", f"lag_{spec.value}", f"lead_{spec.value}", "running_total"]
    return [f"`{c}`" for c in [*df.columns, *added]]


def _split(df: DataFrame, spec: _Spec, tables: Tables | None) -> DataFrame:
    # Rows equal in every sort column still part by the input partition they come from. That number is the same when
    # a lost task runs again, unlike a random one, so each row keeps its place. Writing the rows then fixes the chunks:
    # two range shuffles of one plan may sample different borders. Without a number adaptive execution sizes the chunks.
    chunked = (
        df.withColumn(_SOURCE, F.spark_partition_id())
        .repartitionByRange(*spec.group, *spec.ranked(), _SOURCE)
        .withColumn(_CHUNK, F.spark_partition_id())
        .drop(_SOURCE)
    )
    # Buckets by chunk: neither the windows nor the sums of a chunk shuffle its rows again.
    rows = (tables or Tables(df.sparkSession)).put(chunked, "window_chunks", keep=tables is None, buckets=[_CHUNK])
    # A struct groups and joins null keys like any other value.
    rows = rows.withColumn(_GROUP, F.struct(*spec.group))
    keys = [_GROUP, _CHUNK]

    ranked = Window.partitionBy(*keys).orderBy(*spec.ranked())
    by_value = Window.partitionBy(*keys).orderBy(F.col(spec.order).desc())
    inside = _running(rows, spec, keys).withColumns(
        {
            "__n": F.row_number().over(ranked),
            "__lag": F.lag(spec.value, spec.lag).over(ranked),
            "__lead": F.lead(spec.value, spec.lead).over(ranked),
        }
    )
    inside = inside.withColumns({"__rank": F.rank().over(by_value), "__dense": F.dense_rank().over(by_value)})
    placed = inside.join(F.broadcast(_chunk_carry(rows, spec)), keys, "left")

    continues = F.coalesce(F.col("__carry.continues"), F.lit(False)) & (F.col("__rank") == 1)
    rows_before, dense_before = (F.coalesce(f"__carry.{c}", F.lit(0)) for c in ("rows_before", "dense_before"))
    tail_before, head_after, total_after = (F.col(f"__carry.{c}") for c in ("tail_before", "head_after", "total_after"))
    to_end = F.col("__carry.rows") - F.col("__n")
    running = F.when(F.col("__run").isNull(), total_after).otherwise(
        F.col("__run") + F.coalesce(total_after, F.lit(0))
    )
    return placed.select(
        *[f"`{c}`" for c in df.columns],
        (rows_before + F.col("__n")).alias("row_num"),
        F.when(continues, F.col("__carry.open_rank")).otherwise(rows_before + F.col("__rank")).alias("rank"),
        (dense_before + F.col("__dense")).alias("dense_rank"),
        F.when(F.col("__n") > spec.lag, F.col("__lag"))
        .otherwise(F.get(tail_before, (F.size(tail_before) - spec.lag + F.col("__n") - 1).cast("int"))["value"])
        .alias(f"lag_{spec.value}"),
        F.when(to_end.isNull() | (to_end >= spec.lead), F.col("__lead"))
        .otherwise(F.get(head_after, (F.lit(spec.lead - 1) - to_end).cast("int"))["value"])
        .alias(f"lead_{spec.value}"),
        running.cast(_sum_type(df, spec.value)).alias("running_total"),
    )


def _running(rows: DataFrame, spec: _Spec, keys: list[str]) -> DataFrame:
    """The rows with ``__run``, the total of their chunk from its last row in the ranking up to them.

    Where no sum is rounded or overflows, it is the chunk's total without the rows before: that needs no sort but the ranking's.
    """
    value, kind, total_kind = F.col(f"`{spec.value}`"), rows.schema[spec.value].dataType, _sum_type(rows, spec.value)
    small = isinstance(total_kind, T.DecimalType) and total_kind.precision <= 34
    if not small and not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        rising = Window.partitionBy(*keys).orderBy(*spec.rising())
        return rows.withColumn("__run", F.sum(value).over(rising.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    earlier = Window.partitionBy(*keys).orderBy(*spec.ranked()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    total, before = (F.coalesce(F.sum(value).over(w), F.lit(0).cast(total_kind)) for w in (whole, earlier))
    known = F.count(value).over(whole) - F.count(value).over(earlier)
    return rows.withColumn("__run", F.when(known > 0, (total - before).cast(total_kind)))


def _sum_type(df: DataFrame, value: str):
    return df.select(F.sum(value)).schema[0].dataType


def _chunk_carry(rows: DataFrame, spec: _Spec) -> DataFrame:
    """One row per chunk of each group that has several, with what its other chunks add. Chunks follow the ranking order."""
    keys = [_GROUP, _CHUNK]
    key = F.col(spec.order)
    # Ascending order of this struct is nulls first, which reversed is the ranking order.
    runs = (
        rows.groupBy(*keys, key.alias(_KEY))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(spec.value).alias("total"))
        .withColumn("run", F.struct(F.col(_KEY).isNotNull().alias("known"), F.col(_KEY).alias("key"), "n"))
    )
    chunks = runs.groupBy(*keys).agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("distinct"),
        F.sum("total").alias("total"),
        F.max("run").alias("first_run"),
        F.min("run").alias("last_run"),
    )
    chunks = chunks.withColumn("chunks", F.count(F.lit(1)).over(Window.partitionBy(_GROUP))).where("chunks > 1").join(_edges(rows, spec), keys)

    # A group has one row per chunk here, so these windows stay small.
    in_order = Window.partitionBy(_GROUP).orderBy(_CHUNK)
    backwards = Window.partitionBy(_GROUP).orderBy(F.col(_CHUNK).desc())
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    later = backwards.rowsBetween(Window.unboundedPreceding, -1)
    previous = F.lag(F.struct(F.col("last_run.key").alias("key"))).over(in_order)

    carried = (
        chunks.withColumn("previous", previous)
        .withColumn(
            "continues",
            F.col("previous").isNotNull() & F.col("previous.key").eqNullSafe(F.col("first_run.key")),
        )
        .withColumn("fresh", F.col("distinct") - F.col("continues").cast("int"))
        .withColumn("rows_before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
        .withColumn(
            "last_rank",
            F.when(
                ~(F.col("continues") & (F.col("distinct") == 1)),
                F.col("rows_before") + F.col("rows") - F.col("last_run.n") + 1,
            ),
        )
        .withColumns(
            {
                "dense_before": F.coalesce(F.sum("fresh").over(earlier), F.lit(0)) - F.col("continues").cast("int"),
                "open_rank": F.last("last_rank", ignorenulls=True).over(earlier),
                "tail_before": _last(F.flatten(F.collect_list("tail").over(in_order.rowsBetween(-spec.lag, -1))), spec.lag),
                "head_after": F.slice(F.flatten(F.collect_list("head").over(in_order.rowsBetween(1, spec.lead))), 1, spec.lead),
            }
        )
        .withColumn("total_after", F.sum("total").over(later))
    )
    carry = ["rows", "continues", "rows_before", "dense_before", "open_rank", "tail_before", "head_after", "total_after"]
    return carried.select(*keys, F.struct(*carry).alias("__carry"))


def _last(values: Column, size: int) -> Column:
    """The last ``size`` entries of an array."""
    return F.reverse(F.slice(F.reverse(values), 1, size))


def _edges(rows: DataFrame, spec: _Spec) -> DataFrame:
    """The first ``lead`` and the last ``lag`` values of each chunk in the ranking, as arrays of structs that keep nulls."""
    keys = [_GROUP, _CHUNK]
    ranked = Window.partitionBy(*keys).orderBy(*spec.ranked())
    placed = rows.select(
        *keys,
        F.struct(F.row_number().over(ranked).alias("position"), F.col(spec.value).alias("value")).alias("edge"),
        F.lead(F.lit(True), spec.lag).over(ranked).isNull().alias("late"),
    )
    early = F.col("edge.position") <= spec.lead
    return placed.where(early | F.col("late")).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(early, F.col("edge")))).alias("head"),
        F.sort_array(F.collect_list(F.when(F.col("late"), F.col("edge")))).alias("tail"),
    )
