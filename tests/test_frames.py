"""RANGE frames against Spark's own windows, hot groups included."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tableops.operators import frames
from tableops.operators.frames import range_frame

ALL = ["sum", "avg", "count", "min", "max"]


def own_window(df, order, value, before, after):
    window = Window.partitionBy("g").orderBy(order).rangeBetween(-before, after)
    made = {"sum": F.sum, "avg": F.avg, "count": F.count, "min": F.min, "max": F.max}
    return df.select("*", *[made[a](value).over(window).alias(f"{a}_{value}") for a in ALL])


def same(a, b):
    a, b = ([tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect()] for df in (a, b))
    assert sorted(a, key=repr) == sorted(b, key=repr)


def data(spark, n=600, seed=1):
    r = random.Random(seed)
    made = []
    for i in range(n):
        t = r.choice([None, r.randrange(-40, 40), r.randrange(-40, 40), r.randrange(-3000, 3000)])
        made.append((r.choice([None, "a", "b", "hot", "hot", "hot"]), t, r.choice([None, r.uniform(-5, 5)]), i))
    return spark.createDataFrame(made, "g string, t int, v double, id int")


@pytest.mark.parametrize("before, after", [(30, 0), (0, 7), (5, 5), (0, 0), (100_000, 100_000), (1, 0)])
def test_numbers(spark, before, after):
    df = data(spark)
    same(range_frame(df, "g", "t", "v", before, after, ALL), own_window(df, "t", "v", before, after))


def test_dates_and_decimals(spark):
    df = data(spark).selectExpr("g", "date_add(DATE'2000-01-01', t) AS d", "CAST(v AS DECIMAL(9,3)) AS v", "id")
    window = Window.partitionBy("g").orderBy(F.unix_date("d")).rangeBetween(-30, 0)
    got = range_frame(df, "g", "d", "v", timedelta(days=30), aggregates=["sum", "max"])
    same(got, df.select("*", F.sum("v").over(window).alias("sum_v"), F.max("v").over(window).alias("max_v")))
    assert got.schema["sum_v"].dataType == df.select(F.sum("v")).schema[0].dataType
    stamps = df.selectExpr("g", "CAST(d AS TIMESTAMP_NTZ) + INTERVAL '1' SECOND * id AS d", "v", "id")
    got = range_frame(stamps, "g", "d", "v", timedelta(days=2), aggregates=["count"]).where("id = 5").first()
    at = stamps.where("id = 5").first()
    assert got.count_v == stamps.where(F.col("g").eqNullSafe(at.g) & F.col("d").between(at.d - timedelta(days=2), at.d)).agg(F.count("v")).first()[0]
    exact = spark.createDataFrame([("a", Decimal("0.1"), 1), ("a", Decimal("0.3"), 2), ("a", Decimal("0.4"), 4)], "g string, d decimal(5,1), v int")
    assert [r.sum_v for r in range_frame(exact, ["g"], "d", "v", Decimal("0.2")).orderBy("d").collect()] == [1, 3, 6]


def test_hot_group_is_split(spark):
    df = spark.range(30_000).selectExpr("'hot' AS g", "CAST(id AS INT) AS t", "CAST(id % 97 AS LONG) AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = range_frame(df, "g", "t", "v", 20_000, 50, ["sum", "min"])  # a block is two thirds of the group
        rows = found.where("t IN (0, 5, 12345, 29999)").orderBy("t").collect()
        for r in rows:
            frame = [t % 97 for t in range(max(0, r.t - 20_000), min(29_999, r.t + 50) + 1)]
            assert (r.sum_v, r.min_v) == (sum(frame), min(frame))
        assert found.count() == 30_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_bad_arguments(spark):
    df = data(spark, 5)
    for wrong in ({"before": -1}, {"before": 1, "aggregates": ["median"]}, {"before": 1, "aggregates": []}):
        with pytest.raises(ValueError):
            range_frame(df, "g", "t", "v", **wrong)
    with pytest.raises(ValueError):
        range_frame(df, "g", "v", "id", 1)
    with pytest.raises(ValueError):
        range_frame(df.withColumn("sum_v", F.lit(1)), "g", "t", "v", 1)
    with pytest.raises(ValueError):
        range_frame(df.withColumn("d", F.lit(date(2024, 1, 1))), "g", "d", "v", timedelta(hours=1))
    assert range_frame(df.limit(0), "g", "t", "v", 3).collect() == []


@pytest.mark.parametrize("few", [0, 60, 10_000])
def test_few_and_many_places(spark, monkeypatch, few):
    """Groups on either side of the limit, and all on one side, have the same frames; null groups too."""
    monkeypatch.setattr(frames, "FEW_PLACES", few)
    df = data(spark)
    found = range_frame(df, "g", "t", "v", 30, 7, ALL)
    same(found, own_window(df, "t", "v", 30, 7))
    assert ("__chunk" in str(found._jdf.queryExecution()) or "frame_running" in str(found._jdf.queryExecution())) == (few < 10_000)


def test_small_groups_need_no_blocks(spark):
    """Groups of few order values are added up by one window over their sums, without lookups."""
    df = spark.range(500).selectExpr("id % 50 AS g", "CAST(id AS INT) AS t", "id AS v")
    plan = range_frame(df, "g", "t", "v", 30)._jdf.queryExecution().executedPlan().toString()
    assert "frame_running" not in plan and plan.count("Join") == 1
