"""Semi, anti and inner joins of two large tables, with a Bloom filter of one side's keys before the shuffle.

The filter is a table: each key falls into one block of 256 bits and sets 8 of them, and an aggregate ORs the blocks' bits,
in every task before its only, small shuffle. A row of the other side looks its block up in the broadcast filter; if a bit
is missing, its key is certainly not there. Only the rows that remain are shuffled, for the exact join that follows, so a false
positive costs a shuffled row and never changes a result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableops.operators.joins import join_tables

MAX_FILTER_BYTES = 64 * 1024 * 1024  # of filter bits that are broadcast: 32 million keys
BITS_PER_KEY, WORDS, BITS = 16, 4, 256
_ROW_BYTES = BITS // 8 + 8
_HOWS = ("semi", "anti", "inner")
_BLOCK, _WORD, _MAYBE = "__block", "__word_", "__maybe"


def _key_types(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[T.DataType]:
    """The types in which the join compares the keys: equal keys must hash alike."""
    both = left.select(*[F.col(f"`{c}`") for c in keys]).unionAll(right.select(*[F.col(f"`{c}`") for c in keys]))
    types = [f.dataType for f in both.schema]
    odd = [c for c, t in zip(keys, types) if not isinstance(t, T.AtomicType) or (isinstance(t, T.StringType) and t.collation != "UTF8_BINARY")]
    if odd:
        raise ValueError(f"A Bloom filter needs plain keys compared by their bytes, unlike: {', '.join(odd)}")
    return types


def _hash(keys: Sequence[str], types: Sequence[T.DataType], seed: int) -> Column:
    parts = [F.col(f"`{c}`").cast(t) for c, t in zip(keys, types)]
    parts = [p + F.lit(0).cast(t) if isinstance(t, T.FractionalType) and not isinstance(t, T.DecimalType) else p for p, t in zip(parts, types)]
    return F.xxhash64(F.lit(seed), *parts)  # adding zero makes -0.0 equal 0.0


def _all_known(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in keys])


def _block(keys: Sequence[str], types: Sequence[T.DataType], blocks: int) -> Column:
    return F.pmod(_hash(keys, types, 0), F.lit(blocks))


def _masks(keys: Sequence[str], types: Sequence[T.DataType]) -> list[Column]:
    """The bits of a key: two in each word of its block, from 6 bits of a second hash each."""
    hashed = _hash(keys, types, 1)
    places = [F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(2 * WORDS)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places]
    return [bits[2 * w].bitwiseOR(bits[2 * w + 1]) for w in range(WORDS)]


def filter_blocks(n_keys: int) -> int:
    """Blocks of a filter for so many keys."""
    return max(1, -(-n_keys * BITS_PER_KEY // BITS))


def bloom_table(df: DataFrame, keys: Sequence[str], types: Sequence[T.DataType], blocks: int) -> DataFrame:
    """The filter as (block, four words): at most ``blocks`` rows, whatever the number of rows of ``df``."""
    bits = df.where(_all_known(keys)).select(
        _block(keys, types, blocks).alias(_BLOCK), *[m.alias(f"{_WORD}{w}") for w, m in enumerate(_masks(keys, types))]
    )
    return bits.groupBy(_BLOCK).agg(*[F.bit_or(f"{_WORD}{w}").alias(f"{_WORD}{w}") for w in range(WORDS)])


def mark_maybe(df: DataFrame, bloom: DataFrame, keys: Sequence[str], types: Sequence[T.DataType], blocks: int) -> DataFrame:
    """``df`` with a column that is false where the key is certainly not in the filter. No shuffle: the filter is broadcast."""
    there = [F.col(f"{_WORD}{w}").bitwiseAND(m) == m for w, m in enumerate(_masks(keys, types))]
    place = F.when(_all_known(keys), _block(keys, types, blocks))
    marked = df.withColumn("__place", place).join(F.broadcast(bloom), F.col("__place") == F.col(_BLOCK), "left")
    maybe = F.coalesce(reduce(lambda a, b: a & b, there), F.lit(False))
    return marked.select(*[F.col(f"`{c}`") for c in df.columns], maybe.alias(_MAYBE))


def bloom_join(
    large: DataFrame,
    other: DataFrame,
    on: str | Sequence[str],
    how: str = "semi",
    expected_keys: int | None = None,
    max_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """Rows of ``large`` whose key is in ``other`` (semi), is not (anti), or joined with them (inner, each key column once).

    ``expected_keys``, the distinct keys of ``other``, saves the pass that estimates them; a wrong number costs time only. A
    filter beyond ``max_bytes`` is not made, and the join shuffles all rows. Null keys match nothing, so an anti join keeps
    them. Repeated rows of ``large`` stay. Keys of different types are compared in the wider one. An anti join reads
    ``large`` twice, once for the rows that certainly have no partner, which are not shuffled. Inputs must be
    deterministic. An empty ``other`` gives no rows, or all of them (anti).
    """
    if how not in _HOWS:
        raise ValueError(f"Unknown join type '{how}'. Choose from: {', '.join(_HOWS)}")
    keys = [on] if isinstance(on, str) else list(on)
    types = _key_types(large, other, keys)
    if expected_keys is None:
        hashed = other.where(_all_known(keys)).select(_hash(keys, types, 0).alias("key"))
        expected_keys = hashed.agg(F.approx_count_distinct("key").alias("keys")).first()["keys"]
    blocks = filter_blocks(expected_keys)
    if blocks * _ROW_BYTES > max_bytes:
        return _exact(large, other, keys, how)
    bloom = bloom_table(other, keys, types, blocks)
    marked = mark_maybe(large, bloom, keys, types, blocks)
    candidates = _exact(marked.where(_MAYBE).drop(_MAYBE), other, keys, how)
    return candidates.unionAll(marked.where(~F.col(_MAYBE)).drop(_MAYBE)) if how == "anti" else candidates


def _exact(large: DataFrame, other: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Adaptive execution splits a hot key of ``large``; for semi and anti joins ``other`` is reduced to its distinct keys."""
    if how == "inner":
        return join_tables(large, other, keys)
    return large.join(other.select(*[F.col(f"`{c}`") for c in keys]).distinct(), keys, f"left_{how}")
