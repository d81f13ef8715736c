"""Equi-joins on shared columns.

All joins return each key column once, then the other left and right columns. Spark's adaptive skew join splits a
frequent key on either side of an inner join, but not on the optional side of an outer join and on neither side of a
full join. Outer joins are therefore built from an inner join plus the unmatched rows, which an anti join against the
*distinct* keys of the other side finds.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KINDS = {
    "inner": "inner",
    "left": "left",
    "left_outer": "left",
    "right": "right",
    "right_outer": "right",
    "full": "full",
    "full_outer": "full",
    "outer": "full",
}
MAX_BROADCAST_BYTES = 10 * 1024 * 1024  # Spark's own default: of compressed files, several times as much in memory
MIN_HOT_SHARE = 1e-4


def _kind(how: str) -> str:
    kind = _KINDS.get(how.lower())
    if kind is None:
        raise ValueError(f"Unknown join type '{how}'. Choose from: inner, left, right, full")
    return kind


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def join_tables(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    where: str | None = None,
    skew_safe: bool = True,
    select: Sequence[str] | None = None,
) -> DataFrame:
    """Equi-join with an optional filter on the result and an optional list of columns or expressions to return.

    ``skew_safe=False`` uses Spark's own outer join, which reads each side once. It suits a right side that has
    each key once. With the default the inputs are read twice and must be deterministic.
    """
    keys, kind = _keys(on), _kind(how)
    if kind == "inner":
        joined = left.join(right, keys, "inner")
    elif not skew_safe:
        joined = left.join(right, keys, kind)
    else:
        renamed, names = _distinct_names(left, right, keys)
        joined = _with_unmatched(left.join(renamed, keys, "inner"), left, renamed, keys, kind).toDF(*names)
    joined = joined.filter(where) if where else joined
    return joined.selectExpr(*select) if select else joined


def _distinct_names(left: DataFrame, right: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """The right side under names the left side lacks, and the names of the joined columns."""
    rest = [c for c in right.columns if c not in keys]
    renamed = right.select(*keys, *[F.col(f"`{c}`").alias(f"__right_{i}") for i, c in enumerate(rest)])
    return renamed, [*keys, *[c for c in left.columns if c not in keys], *rest]


def _with_unmatched(
    matched: DataFrame, left: DataFrame, right: DataFrame, keys: list[str], kind: str
) -> DataFrame:
    """Add the rows that an outer join keeps without a partner."""
    parts = [matched]
    if kind in ("left", "full"):
        parts.append(left.join(right.select(*keys).distinct(), keys, "left_anti"))
    if kind in ("right", "full"):
        parts.append(right.join(left.select(*keys).distinct(), keys, "left_anti"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan, the number Spark's own broadcast choice uses. Runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_join(
    large: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join with a broadcast of ``small`` if its estimated size is at most ``max_bytes``, else by shuffle.

    Right and full joins keep every row of the small side, which no executor can decide alone; there the matched rows
    come from the broadcast join and the unmatched ones from an anti join.
    """
    keys, kind = _keys(on), _kind(how)
    if planned_bytes(small) > max_bytes:
        return join_tables(large, small, keys, kind)
    if kind in ("inner", "left"):
        return large.join(F.broadcast(small), keys, kind)
    renamed, names = _distinct_names(large, small, keys)
    matched = large.join(F.broadcast(renamed), keys, "inner")
    return _with_unmatched(matched, large, renamed, keys, kind).toDF(*names)


def salted_join(
    large: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    salt_buckets: int = 10,
    hot_share: float = 0.01,
    salt_by: Sequence[str] | None = None,
    hot_keys: DataFrame | None = None,
) -> DataFrame:
    """Join that cuts each frequent key of ``large`` into ``salt_buckets`` parts.

    Keys with more than ``hot_share`` of the rows are salted, at most ``1 / hot_share`` of them and so 10,000 at most, a
    list that is small enough to broadcast. One aggregate over the keys of ``large`` finds them; ``hot_keys``, a table of
    the key columns, saves that pass where they are known, and is broadcast only if it is estimated at MAX_BROADCAST_BYTES. Only those rows of ``small`` are copied per bucket. The bucket comes
    from the row's content and its input partition: a task that runs again gives every row the same bucket, and equal
    rows from different partitions still spread out.
    """
    keys, kind = _keys(on), _kind(how)
    if salt_buckets < 1 or not MIN_HOT_SHARE <= hot_share <= 1:
        raise ValueError(f"salt_buckets must be at least 1 and hot_share in [{MIN_HOT_SHARE}, 1]")
    renamed, names = _distinct_names(large, small, keys)
    known = hot_keys.select(*keys, F.lit(True).alias("__hot")).distinct() if hot_keys is not None else None
    if known is None:
        hot = F.broadcast(_hot_keys(large, keys, hot_share))
    else:
        hot = F.broadcast(known) if planned_bytes(known) <= MAX_BROADCAST_BYTES else known

    content = salt_by or large.columns
    bucket = F.pmod(F.xxhash64(*content, F.spark_partition_id()), F.lit(salt_buckets)).cast("int")
    salted = large.join(hot, keys, "left").withColumn("__salt", F.when(F.col("__hot"), bucket).otherwise(0)).drop("__hot")
    buckets = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salt_buckets - 1))).otherwise(F.array(F.lit(0)))
    copied = renamed.join(hot, keys, "left").withColumn("__salt", F.explode(buckets)).drop("__hot")

    matched = salted.join(copied, [*keys, "__salt"], "inner").drop("__salt")
    return _with_unmatched(matched, large, renamed, keys, kind).toDF(*names)


def _hot_keys(df: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Keys with more than ``share`` of the rows. The total sums the same counts, whose shuffle Spark takes again."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    total = counts.agg(F.sum("__rows")).scalar()
    return counts.filter(F.col("__rows") > total * share).select(*keys, F.lit(True).alias("__hot"))
