"""States per directory: refreshed only where files changed, and equal to summaries of the whole table."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tableops.plans.upkeep import Kept, Refreshed, directory_marks, refresh_states, summarise
from tableops.sinks import write_parquet

KEPT = Kept(("year", "place"), ("item",), ("price",), ("price",), ("buyer",))


def rows(spark, years, factor=1.0):
    made = spark.range(3_000).selectExpr("CAST(2000 + id % 4 AS INT) AS year", "IF(id % 3 = 0, NULL, concat('a/b ', id % 3)) AS place", "concat('i', id % 5) AS item", f"id * {factor} AS price", "id % 700 AS buyer")
    return made.where(F.col("year").isin(years))


def whole(df, by):
    return {tuple(r[c] for c in by): (r["n"], r["s"], r["low"], r["high"], r["d"]) for r in df.groupBy(*by).agg(F.count("*").alias("n"), F.sum("price").alias("s"), F.min("price").alias("low"), F.max("price").alias("high"), F.count_distinct("buyer").alias("d")).collect()}


def check(spark, table, states, by):
    got, want = summarise(spark, states, KEPT, by, {"price": [0.5]}).collect(), whole(spark.read.parquet(table), by)
    assert len(got) == len(want)
    for r in got:
        n, total, low, high, distinct = want[tuple(r[c] for c in by)]
        assert (r["rows"], r["count_price"], r["min_price"], r["max_price"]) == (n, n, low, high) and r["sum_price"] == pytest.approx(total)
        assert abs(r["distinct_buyer"] - distinct) <= 0.05 * distinct and low <= r["p50_price"] <= high


def test_only_changed_directories(spark, tmp_path):
    table, states = str(tmp_path / "table"), str(tmp_path / "states")
    write_parquet(rows(spark, [2000, 2001, 2002]), table, ["year", "place"])
    assert refresh_states(spark, table, states, KEPT) == Refreshed(9, 0, 0)
    assert refresh_states(spark, table, states, KEPT) == Refreshed(0, 9, 0)
    for by in ([], ["year"], ["place", "item"], ["year", "place", "item"]):
        check(spark, table, states, by)
    write_parquet(rows(spark, [2001], 3.0).where("place = 'a/b 1'"), table, ["year", "place"])  # one directory
    write_parquet(rows(spark, [2003]), table, ["year", "place"])  # three new ones
    assert refresh_states(spark, table, states, KEPT) == Refreshed(4, 8, 0)
    check(spark, table, states, ["year", "item"])
    shutil.rmtree(tmp_path / "table" / "year=2000")
    assert refresh_states(spark, table, states, KEPT) == Refreshed(0, 9, 3)
    check(spark, table, states, ["year"])
    write_parquet(rows(spark, [2000]), table, ["year", "place"])
    assert refresh_states(spark, table, states, KEPT) == Refreshed(3, 9, 0)
    check(spark, table, states, [])


def test_reads_the_changed_directories_only(spark, tmp_path):
    table, states = str(tmp_path / "table"), str(tmp_path / "states")
    write_parquet(rows(spark, [2000, 2001]), table, ["year", "place"])
    refresh_states(spark, table, states, KEPT)
    for victim in (tmp_path / "table" / "year=2001").rglob("*.parquet"):
        kept = victim.stat()
        victim.write_bytes(b"x" * kept.st_size)  # unreadable, but with the same mark
        os.utime(victim, ns=(kept.st_atime_ns, kept.st_mtime_ns))
    write_parquet(rows(spark, [2000], 2.0).where("place = 'a/b 2'"), table, ["year", "place"])
    assert refresh_states(spark, table, states, KEPT) == Refreshed(1, 5, 0)
    assert {r["year"] for r in directory_marks(spark, table, ["year"]).collect()} == {"2000", "2001"}
