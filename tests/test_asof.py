"""As-of joins against a loop over all right rows, hot keys included."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tableops.operators.asof import asof_join

LEFT, RIGHT = "k long, t long, name string", "k long, t long, price double, note string"


def brute(left, right, direction="backward", exact=True, tolerance=None, how="left"):
    found = []
    for k, t, name in left:
        best = None
        for i, (rk, rt, price, note) in enumerate(right):
            if k is None or t is None or rk != k or rt is None or (rt == t and not exact):
                continue
            if (direction == "backward" and rt > t) or (direction == "forward" and rt < t):
                continue
            if tolerance is not None and abs(rt - t) > tolerance:
                continue
            score = (-abs(rt - t), rt < t, price is not None, price or 0)
            if best is None or score > best[0]:
                best = score, (rt, price, note)
        if best or how == "left":
            found.append((k, t, name, *(best[1] if best else (None, None, None))))
    return sorted(found, key=repr)


def rows(seed, n, hot=0.4):
    r = random.Random(seed)
    key = lambda: r.choice([None, 1, 2, 3, 4]) if r.random() > hot else 7
    time = lambda: r.choice([None, *range(40)]) if r.random() < 0.5 else r.randrange(2000)
    left = [(key(), time(), f"l{i}") for i in range(n)]
    right = [(key(), time(), r.choice([None, float(i)]), f"r{i}") for i in range(n)]
    return left, [(k, t, p, n if p is not None else "none") for k, t, p, n in right]


@pytest.mark.parametrize("direction, exact", [("backward", True), ("backward", False), ("forward", True), ("forward", False), ("nearest", True)])
@pytest.mark.parametrize("tolerance", [None, 25])
def test_directions(spark, direction, exact, tolerance):
    left, right = rows(3, 400)
    for how in ("left", "inner"):
        found = asof_join(
            spark.createDataFrame(left, LEFT),
            spark.createDataFrame(right, RIGHT),
            "k",
            "t",
            direction=direction,
            exact=exact,
            tolerance=tolerance,
            tie_break=["price"],
            how=how,
        )
        assert found.columns == ["k", "t", "name", "t_right", "price", "note"]
        assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(left, right, direction, exact, tolerance, how)


def test_hot_key_is_split(spark):
    left = spark.range(40_000).select(F.lit(1).alias("k"), (F.col("id") * 7 % 10_007).alias("t"), "id")
    right = spark.range(2_000).select(F.lit(1).alias("k"), (F.col("id") * 5).alias("t"), F.col("id").alias("r"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = asof_join(left, right, "k", "t")
        wrong = found.where(F.col("r") != F.floor(F.col("t") / 5)).where("t < 10000").count()
        assert wrong == 0 and found.count() == 40_000 and found.where("r IS NULL").count() == 0
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 3 and max(sizes) < 20_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_sparse_right_rows(spark):
    left = spark.range(5_000).selectExpr("1 AS k", "id AS t")
    found = asof_join(left, spark.createDataFrame([(1, 3, "x")], "k int, u long, v string"), "k", "t", "u")
    assert found.where("t >= 3").select("u", "v").distinct().collect() == [(3, "x")]
    assert found.where("t < 3").select("u", "v").distinct().collect() == [(None, None)]
    ahead = asof_join(left, spark.createDataFrame([(1, 4_900, "x")], "k int, u long, v string"), "k", "t", "u", direction="forward")
    assert ahead.where("v = 'x'").count() == 4_901


def test_times_and_names(spark):
    at = datetime(2024, 3, 31, 1, 30)
    left = spark.createDataFrame([("a", at, 1), ("a", at + timedelta(hours=3), 2)], "`the key` string, t timestamp_ntz, price int")
    right = spark.createDataFrame([("a", at - timedelta(minutes=5), 9)], "`the key` string, t timestamp_ntz, price int")
    found = asof_join(left, right, ["the key"], "t", tolerance=timedelta(hours=1), suffix="_then").orderBy("t").collect()
    assert [r.price_then for r in found] == [9, None]
    days = spark.createDataFrame([("a", date(2024, 1, 9))], "k string, d date")
    assert asof_join(days, days.selectExpr("k", "d - 4 AS d"), "k", "d", tolerance=3).first()["d_right"] is None
    assert asof_join(days, days.selectExpr("k", "d - 3 AS d"), "k", "d", tolerance=3).first()["d_right"] == date(2024, 1, 6)


def test_empty_and_bad_arguments(spark):
    left, right = spark.createDataFrame([(1, 1, "x")], LEFT), spark.createDataFrame([], RIGHT)
    assert [tuple(r) for r in asof_join(left, right, "k", "t").collect()] == [(1, 1, "x", None, None, None)]
    assert asof_join(left, right, "k", "t", how="inner").collect() == []
    assert asof_join(left.limit(0), right, "k", "t").collect() == []
    for wrong in ({"direction": "sideways"}, {"how": "full"}, {"direction": "nearest", "exact": False}, {"suffix": ""}):
        with pytest.raises(ValueError):
            asof_join(left, right, "k", "t", **wrong)
    with pytest.raises(ValueError):
        asof_join(left, right, [], "t")
