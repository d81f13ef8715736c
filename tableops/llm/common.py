"""What the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NO_ID = (1 << 63) - 1  # stands for a null doc_id inside an operator: the largest id


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def inner_id(column: str | Column = "doc_id") -> Column:
    """The id of a document with null as the largest one."""
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("long"), F.lit(NO_ID))


def outer_id(column: str) -> Column:
    return F.nullif(F.col(column), F.lit(NO_ID))


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only the two columns that matter, so that no other column's name can clash; null text is empty."""
    return docs.select(inner_id().alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """df, a stored table of a few numbers a row, with a broadcast hint if it has BROADCAST_ROWS rows at most; counts them."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def site_host(address: Column) -> Column:
    """Host of an address, or the whole of a plain source name; empty for null."""
    bare = F.regexp_replace(F.lower(F.coalesce(address.cast("string"), F.lit(""))), "^[a-z][a-z0-9+.-]*://", "")
    return F.regexp_replace(F.regexp_replace(bare, "[/?#].*$", ""), "^.*@|:[0-9]*$", "")


def site_suffix(host: Column) -> Column:
    """Last label of a dotted host; empty for plain names."""
    return F.regexp_extract(host, "\\.([^.]+)$", 1)


def with_text(docs: DataFrame, text: Column) -> DataFrame:
    """docs with another text; n_chars, where there is one, follows it."""
    docs = docs.withColumn("text", text)
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs
