"""As-of joins: each left row with the last right row of its key at or before its time, or the next, or the nearest.

Both sides are dealt into chunks of one order by key and time, so that a frequent key, and even a frequent time of it, is
spread over many chunks. Within a chunk a window carries the last right row along; one small row per key and chunk carries it
across the borders. No task holds a whole key, and no pair of rows is formed that is not returned.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableops.scratch import Tables, stored

_DIRECTIONS = ("backward", "forward", "nearest")
_KEY, _TIME, _SECOND, _SOURCE, _CHUNK = "__key", "__time", "__second", "__source", "__chunk"


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    by: str,
    right_by: str | None = None,
    direction: str = "backward",
    exact: bool = True,
    tolerance: object = None,
    tie_break: Sequence[str] = (),
    how: str = "left",
    suffix: str = "_right",
    tables: Tables | None = None,
) -> DataFrame:
    """The left columns, then those of the matched right row but its keys; a name that the left has gets ``suffix``.

    ``on`` are the key columns of both sides, ``by`` the left order column and ``right_by`` the right one, where it has another
    name. ``backward`` matches the last right row at or before the left one, ``forward`` the first at or after it, ``nearest``
    the closer of both, the earlier if they are as close. ``exact=False`` leaves out equal times (not for ``nearest``).
    ``tolerance`` (a number, a timedelta or an interval column) is the largest distance that still matches. Of right rows with
    the same key and time the one with the largest ``tie_break`` counts, nulls being smallest, and beyond that one that
    depends on the rows alone. Null keys and times match nothing. ``how="inner"`` drops left rows without a match.

    Runs one job when called, which writes both sides to ``tables`` or to ``spark.checkpoint.dir``.
    """
    keys = [on] if isinstance(on, str) else list(on)
    right_by = right_by or by
    if direction not in _DIRECTIONS or how not in ("left", "inner"):
        raise ValueError(f"Unknown direction '{direction}' or join '{how}'. Choose from: {', '.join(_DIRECTIONS)}; left, inner")
    if not keys:
        raise ValueError("asof_join needs at least one key column")
    if direction == "nearest" and not exact:
        raise ValueError("nearest rows include those of the same time")
    payload = [c for c in right.columns if c not in keys]
    names = [c + suffix if c in left.columns else c for c in payload]
    if len({*left.columns, *names}) < len(left.columns) + len(names):
        raise ValueError(f"Result columns clash; choose another suffix than '{suffix}'")

    known = [F.col(f"`{c}`").isNotNull() for c in [*keys, by]]
    matchable = known[0]
    for condition in known[1:]:
        matchable = matchable & condition
    rows = _chunked(left.where(matchable), right, keys, by, right_by, payload, tie_break, right_first=exact == (direction != "forward"))
    rows = tables.put(rows, "asof_chunks") if tables else stored(rows, "asof_chunks")

    matched = _with_matches(rows, direction)
    time = F.col(_TIME)
    picks = {d: F.col(f"__{d}") for d in ("backward", "forward") if direction in (d, "nearest")}
    if tolerance is not None:
        limit = tolerance if isinstance(tolerance, Column) else F.lit(tolerance)
        near = {"backward": lambda p: p["time"] + limit >= time, "forward": lambda p: time + limit >= p["time"]}
        picks = {d: F.when(near[d](p), p) for d, p in picks.items()}
    if direction == "nearest":
        back, ahead = picks["backward"], picks["forward"]
        match = F.when(back.isNull() | (time - back["time"] > ahead["time"] - time), F.coalesce(ahead, back)).otherwise(back)
    else:
        match = picks[direction]
    matched = matched.select("__left", match.alias("__match"))
    if how == "inner":
        matched = matched.where(F.col("__match").isNotNull())
    result = matched.select(
        *[F.col("__left").getField(c).alias(c) for c in left.columns],
        *[F.col("__match").getField("row").getField(c).alias(name) for c, name in zip(payload, names)],
    )
    if how == "inner":
        return result
    nothing = [F.lit(None).cast(right.schema[c].dataType).alias(name) for c, name in zip(payload, names)]
    unmatched = left.where(~matchable).select("*", *nothing)
    return result.unionByName(unmatched)


def _chunked(
    left: DataFrame, right: DataFrame, keys: list[str], by: str, right_by: str, payload: list[str], ties: Sequence[str], right_first: bool
) -> DataFrame:
    """Rows of both sides in one order of key, time and side, with their chunk; one right row per key and time."""
    columns = {"left": left.columns, "right": payload}
    time = {"left": F.col(f"`{by}`"), "right": F.col(f"`{right_by}`")}
    right = right.dropna(subset=[*keys, right_by])
    rows = {side: F.struct(*[F.col(f"`{c}`") for c in names]) for side, names in columns.items()}
    types = {"left": left.select(rows["left"]).schema[0].dataType, "right": right.select(rows["right"]).schema[0].dataType}
    sides = {
        side: df.select(
            F.struct(*[F.col(f"`{c}`") for c in keys]).alias(_KEY),
            time[side].alias(_TIME),
            F.lit(side == "left" if right_first else side == "right").alias(_SECOND),
            *[(rows[s] if s == side else F.lit(None).cast(types[s])).alias(f"__{s}") for s in columns],
            *([F.struct(*[F.col(f"`{c}`") for c in ties], F.xxhash64(rows[side])).alias("__ties")] if side == "right" else []),
        )
        for side, df in (("left", left), ("right", right))
    }
    one = sides["right"].groupBy(_KEY, _TIME, _SECOND).agg(F.max_by("__right", "__ties").alias("__right"))
    one = one.withColumn("__left", F.lit(None).cast(types["left"])).withColumn("__right", F.struct(F.col(_TIME).alias("time"), F.col("__right").alias("row")))
    both = sides["left"].withColumn("__right", F.lit(None).cast(one.schema["__right"].dataType)).unionByName(one)
    # Rows that are equal in all of this part by the input partition they come from, as in window_columns.
    both = both.withColumn(_SOURCE, F.spark_partition_id()).repartitionByRange(_KEY, _TIME, _SECOND, _SOURCE)
    return both.withColumn(_CHUNK, F.spark_partition_id()).drop(_SOURCE)


def _with_matches(rows: DataFrame, direction: str) -> DataFrame:
    """Left rows with the last right row before them (__backward) or the next one (__forward), as the direction asks."""
    wanted = [d for d in ("backward", "forward") if direction in (d, "nearest")]
    order = {"backward": [F.asc(_TIME), F.asc(_SECOND)], "forward": [F.desc(_TIME), F.desc(_SECOND)]}
    chunk_order = {"backward": F.asc(_CHUNK), "forward": F.desc(_CHUNK)}
    edge = {"backward": F.max_by, "forward": F.min_by}
    held = F.when(F.col("__right").isNotNull(), F.col(_TIME))

    # The last right row of earlier chunks: at most one key of a chunk goes on from there, so this is a row per chunk.
    edges = rows.groupBy(_KEY, _CHUNK).agg(*[edge[d]("__right", held).alias(d) for d in wanted])
    earlier = {d: Window.partitionBy(_KEY).orderBy(chunk_order[d]).rowsBetween(Window.unboundedPreceding, -1) for d in wanted}
    edges = edges.select(_KEY, _CHUNK, *[F.last(d, ignorenulls=True).over(earlier[d]).alias(d) for d in wanted])
    edges = edges.dropna(how="all", subset=wanted)

    upto = {d: Window.partitionBy(_KEY, _CHUNK).orderBy(*order[d]).rowsBetween(Window.unboundedPreceding, Window.currentRow) for d in wanted}
    inside = rows.withColumns({f"__{d}": F.last("__right", ignorenulls=True).over(upto[d]) for d in wanted})
    inside = inside.where(F.col("__left").isNotNull()).join(edges, [_KEY, _CHUNK], "left")
    return inside.select("__left", _TIME, *[F.coalesce(f"__{d}", d).alias(f"__{d}") for d in wanted])
