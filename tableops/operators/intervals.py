"""Joins of intervals that overlap, on a grid of cells with a level for each power of two of their length.

An interval lies on the level whose cells are as long as it or up to twice as long, so it touches two cells of it at most. A pair
meets on the level of its longer interval: the shorter one is copied there, again to two cells at most, and only to levels that the
other side has. The cell that holds the start of the overlap emits the pair, so it comes once. The join is an equi-join on keys,
level and cell, which Spark shuffles, and splits where a cell is hot; no side is broadcast and no cross product is formed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableops.functions.positions import position_of
from tableops.operators.joins import salted_join

_MAX_LEVEL = 62


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_bounds: tuple[str, str],
    right_bounds: tuple[str, str],
    on: str | Sequence[str] = (),
    closed: bool = True,
    suffix: str = "_right",
    salt_buckets: int | None = None,
) -> DataFrame:
    """Pairs of rows whose intervals overlap: the left columns, then the right ones but the keys, named with ``suffix`` on a clash.

    Bounds are two columns each: dates, timestamps or whole numbers, of one type on both sides. ``closed`` intervals include
    both ends, so intervals that touch overlap, and a point is one with equal bounds; otherwise the end is not part of them:
    each must start before the other ends. Rows with a null bound or key, or whose end is before their start, match nothing.
    ``salt_buckets`` salts frequent cells (see ``salted_join``), beyond what adaptive execution splits by itself.

    Runs one small job per side when called, for the levels that it has (63 at most).
    """
    keys = [on] if isinstance(on, str) else list(on)
    for df, bounds in ((left, left_bounds), (right, right_bounds)):
        for name in bounds:
            if not isinstance(df.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
                raise ValueError(f"Intervals need dates, timestamps or whole numbers: {name}")
    kinds = {_family(df.schema[c].dataType) for df, bounds in ((left, left_bounds), (right, right_bounds)) for c in bounds}
    if len(kinds) > 1:
        raise ValueError(f"All bounds must have one type, not {', '.join(sorted(kinds))}")
    rest = [c for c in right.columns if c not in keys]
    names = [c + suffix if c in left.columns else c for c in rest]
    if len({*left.columns, *names}) < len(left.columns) + len(names):
        raise ValueError(f"Result columns clash; choose another suffix than '{suffix}'")

    a, b = _placed(left, left_bounds, keys, "left"), _placed(right, right_bounds, keys, "right")
    levels_a, levels_b = _levels(a, "left"), _levels(b, "right")
    a = _copied(a, "left", levels_b, own=["own", "up"], up=["own"])
    b = _copied(b, "right", levels_a, own=["own"], up=["up"])
    cells = [*[f"__key_{i}" for i in range(len(keys))], "__level", "__cell", "__role"]
    pairs = salted_join(a, b, cells, salt_buckets=salt_buckets) if salt_buckets else a.join(b, cells)

    start = F.greatest("__left_start", "__right_start")
    if closed:
        overlap = start <= F.least("__left_end", "__right_end")
    else:
        overlap = (F.col("__left_start") < F.col("__right_end")) & (F.col("__right_start") < F.col("__left_end"))
    pairs = pairs.where(overlap & (_cell(start, F.col("__level")) == F.col("__cell")))
    return pairs.select(
        *[F.col("__left").getField(c).alias(c) for c in left.columns],
        *[F.col("__right").getField(c).alias(name) for c, name in zip(rest, names)],
    )


def _family(kind: T.DataType) -> str:
    return "whole number" if isinstance(kind, T.IntegralType) else kind.simpleString()


def _cell(at: Column, level: Column) -> Column:
    """Number of the cell of 2**level that holds a position; the shift keeps the sign, so it rounds down."""
    return F.call_function("shiftright", at, level)


def _placed(df: DataFrame, bounds: tuple[str, str], keys: list[str], side: str) -> DataFrame:
    """Rows with a real interval as (__key_0, ..., __{side}, __{side}_start, __{side}_end, __{side}_level)."""
    start, end = F.col(f"__{side}_start"), F.col(f"__{side}_end")
    rows = df.select(
        *[F.col(f"`{c}`").alias(f"__key_{i}") for i, c in enumerate(keys)],
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(f"__{side}"),
        *[position_of(df, c).alias(f"__{side}_{part}") for c, part in zip(bounds, ("start", "end"))],
    )
    rows = rows.dropna(subset=[f"__key_{i}" for i in range(len(keys))] + [f"__{side}_start", f"__{side}_end"]).where(start <= end)
    # Bits of length - 1: the least level whose cells are as long as the interval.
    length = F.try_subtract(end, start)
    level = F.when(end == start, 0).otherwise(F.length(F.regexp_replace(F.bin(length - 1), "^0$", "")))
    return rows.withColumn(f"__{side}_level", F.least(F.coalesce(level, F.lit(_MAX_LEVEL)), F.lit(_MAX_LEVEL)).cast("int"))


def _levels(rows: DataFrame, side: str) -> list[int]:
    return sorted(r[0] for r in rows.select(f"__{side}_level").distinct().collect())  # 63 at most


def _copied(rows: DataFrame, side: str, others: list[int], own: list[str], up: list[str]) -> DataFrame:
    """A copy per level, role and cell: on its own level where the other side has that level or a lower one, and on higher ones that the other has.

    Copies on the own level meet all of the other side; those on a higher level only the other's own ones.
    """
    level = F.col(f"__{side}_level")
    if not others:
        return rows.where(F.lit(False)).select("*", F.lit(0).alias("__level"), F.lit("").alias("__role"), F.lit(0).cast("long").alias("__cell"))

    def at(chosen: Column, roles: list[str]) -> Column:
        return F.array(*[F.struct(chosen.cast("int").alias("level"), F.lit(role).alias("role")) for role in roles])

    higher = F.filter(F.array(*[F.lit(x) for x in others]), lambda x: x > level)
    copies = F.flatten(F.transform(higher, lambda x: at(x, up)))
    copies = F.when(level >= F.lit(others[0]), F.concat(at(level, own), copies)).otherwise(copies)
    rows = rows.withColumn("__copy", F.explode(copies))
    rows = rows.withColumns({"__level": F.col("__copy.level"), "__role": F.col("__copy.role")}).drop("__copy")
    first, last = (_cell(F.col(f"__{side}_{part}"), F.col("__level")) for part in ("start", "end"))
    return rows.withColumn("__cell", F.explode(F.sequence(first, last)))
