"""Interval joins against all pairs."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tableops.operators.intervals import interval_join

SCHEMA = "k long, s long, e long, name string"


def rows(seed, n, prefix):
    r = random.Random(seed)
    made = []
    for i in range(n):
        start = r.choice([None, r.randrange(-300, 300), r.randrange(-5000, 5000)])
        length = r.choice([0, 0, 1, 2, 3, 4, 5, r.randrange(100), r.randrange(9000), -1])
        made.append((r.choice([None, 1, 1, 2]), start, None if start is None or r.random() < 0.05 else start + length, f"{prefix}{i}"))
    return made


def brute(left, right, keys, closed=True):
    found = []
    for k, s, e, a in left:
        for rk, rs, re, b in right:
            if None in (s, e, rs, re) or s > e or rs > re or (keys and (k is None or k != rk)):
                continue
            if (s <= re and rs <= e) if closed else (s < re and rs < e):
                found.append((a, b))
    return sorted(found)


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("salt", [None, 3])
def test_all_pairs(spark, closed, keys, salt):
    left, right = rows(1, 150, "a"), rows(2, 120, "b")
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    found = interval_join(a, b, ("s", "e"), ("s", "e"), keys, closed, salt_buckets=salt)
    assert sorted((r.name, r.name_right) for r in found.collect()) == brute(left, right, keys, closed)


def test_plan(spark):
    a = spark.range(3_000).selectExpr("id", "id * 10 AS s", "id * 10 + id % 500 AS e")
    found = interval_join(a, a.withColumnRenamed("id", "other"), ("s", "e"), ("s", "e"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    candidates = found.count()
    assert candidates < 3_000 * 120


def test_hot_cell_is_split(spark):
    a = spark.range(20_000).selectExpr("id AS a", "CAST(0 AS LONG) AS s", "id % 3 AS e")
    b = spark.range(20).selectExpr("id AS b", "id AS s", "id AS e")
    found = interval_join(a, b, ("s", "e"), ("s", "e"), salt_buckets=8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = interval_join(a, b, ("s", "e"), ("s", "e"), salt_buckets=8)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 + 13_333 + 6_666 and len(sizes) > 3 and max(sizes) < 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_types(spark):
    a = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 5))], "s date, e date")
    b = spark.createDataFrame([(date(2024, 1, 5), date(2024, 1, 9)), (date(2024, 1, 6), date(2024, 1, 6))], "s date, e date")
    assert [tuple(r)[2:] for r in interval_join(a, b, ("s", "e"), ("s", "e")).collect()] == [(date(2024, 1, 5), date(2024, 1, 9))]
    assert interval_join(a, b, ("s", "e"), ("s", "e"), closed=False).collect() == []
    t = spark.createDataFrame([(datetime(1969, 12, 31, 23, 59, 59, 5), datetime(1970, 1, 1, 0, 0, 0, 1))], "s timestamp_ntz, e timestamp_ntz")
    assert interval_join(t, t, ("s", "e"), ("e", "e")).count() == 1
    big = spark.createDataFrame([(-(1 << 63), (1 << 63) - 1)], "s long, e long")
    assert interval_join(big, big, ("s", "e"), ("s", "e")).count() == 1
    assert interval_join(a.limit(0), b, ("s", "e"), ("s", "e")).collect() == []
    with pytest.raises(ValueError):
        interval_join(a, t, ("s", "e"), ("s", "e"))
    with pytest.raises(ValueError):
        interval_join(a, a, ("s", "e"), ("s", "e"), suffix="")
