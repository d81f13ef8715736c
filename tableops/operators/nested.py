"""Semi-structured text and nested columns: JSON by path, rows gathered into arrays, and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PARSED = "__parsed"


def json_schema(df: DataFrame, column: str) -> str:
    """The schema that holds every valid JSON text of a column, as DDL of a variant; one aggregate over all rows.

    Texts that disagree give VARIANT at that place. Without valid texts the schema is VOID. Its size is that of all field
    names together, so a column whose field names are data has no useful schema.
    """
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(f"`{column}`"))).alias("found")).first()["found"]


def extract_paths(df: DataFrame, column: str, paths: Mapping[str, tuple[str, str]], flag: str | None = None) -> DataFrame:
    """Add a column per name from (path, type), e.g. {"k": ("$.k", "int")}; each text is parsed once.

    A missing path, a value that does not cast, null and text that is no JSON give null. ``flag`` names a column that is true
    for text that is no JSON, false for null and for JSON.
    """
    clash = [c for c in [*paths, *([flag] if flag else [])] if c in df.columns]
    if clash:
        raise ValueError(f"Columns exist already: {', '.join(clash)}")
    parsed = df.withColumn(_PARSED, F.try_parse_json(F.col(f"`{column}`")))
    found = [F.try_variant_get(F.col(_PARSED), path, kind).alias(name) for name, (path, kind) in paths.items()]
    if flag:
        found.append((F.col(f"`{column}`").isNotNull() & F.col(_PARSED).isNull()).alias(flag))
    return parsed.select(*[F.col(f"`{c}`") for c in df.columns], *found)


def nest_rows(df: DataFrame, by: Sequence[str], position: str, columns: Sequence[str], into: str, per_row: int = 1_000) -> DataFrame:
    """(by, part, into): an array of structs (position, columns) in order of position, then of the columns.

    ``position`` is a whole number; a row holds the positions from ``part * per_row`` on, so a long group takes several rows
    and no row grows with its group, but for rows that share a position. Rows with a null position are in a part of their own,
    null.
    """
    part = F.floor(F.col(f"`{position}`") / F.lit(per_row)).alias("part")
    item = F.struct(*[F.col(f"`{c}`") for c in (position, *columns)])
    keys = [F.col(f"`{c}`") for c in by]
    return df.groupBy(*keys, part).agg(F.array_sort(F.collect_list(item)).alias(into))


def unnest_rows(df: DataFrame, column: str, outer: bool = False) -> DataFrame:
    """One row per struct of an array column, whose fields take the column's place; ``outer`` keeps rows without any."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    inline = F.inline_outer if outer else F.inline
    return df.select(*rest, inline(F.col(f"`{column}`")))
