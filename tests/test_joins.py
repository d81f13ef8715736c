import random

import pytest
from pyspark.sql import functions as F

from tableops.operators import joins

KINDS = ["inner", "left", "right", "full"]


def expected(left, right, kind):
    """Joined rows (k, a, b) of (k, a) and (k, b) by nested loops; a null key matches nothing."""
    rows = [(k, a, b) for k, a in left for j, b in right if k is not None and k == j]
    if kind in ("left", "full"):
        keys = {j for j, _ in right if j is not None}
        rows += [(k, a, None) for k, a in left if k not in keys]
    if kind in ("right", "full"):
        keys = {k for k, _ in left if k is not None}
        rows += [(j, None, b) for j, b in right if j not in keys]
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(7)
    left = [(1 if rng.random() < 0.4 else rng.choice([None, *range(2, 30)]), i) for i in range(300)]
    right = [(1 if rng.random() < 0.3 else rng.choice([None, *range(15, 40)]), 1000 + i) for i in range(60)]
    return left, right


@pytest.fixture(scope="module")
def frames(spark, data, tmp_path_factory):
    base = tmp_path_factory.mktemp("joins")
    spark.createDataFrame(data[0], "k int, a int").repartition(4).write.parquet(f"{base}/l")
    spark.createDataFrame(data[1], "k int, b int").repartition(2).write.parquet(f"{base}/r")
    return spark.read.parquet(f"{base}/l"), spark.read.parquet(f"{base}/r")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("skew_safe", [True, False])
def test_join(frames, data, kind, skew_safe):
    df = joins.join_tables(*frames, "k", kind.upper(), skew_safe=skew_safe)
    assert df.columns == ["k", "a", "b"]
    assert rows(df) == expected(*data, kind)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("max_bytes", [joins.MAX_BROADCAST_BYTES, 0])
def test_broadcast_join(frames, data, kind, max_bytes):
    df = joins.broadcast_join(*frames, "k", kind, max_bytes=max_bytes)
    assert rows(df) == expected(*data, kind)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("hot_share, buckets", [(0.1, 4), (0.001, 3), (1.0, 5), (0.2, 1)])
def test_salted_join(frames, data, kind, hot_share, buckets):
    df = joins.salted_join(*frames, "k", kind, buckets, hot_share)
    assert df.columns == ["k", "a", "b"]
    assert rows(df) == expected(*data, kind)


def test_salt_by_column(frames, data):
    assert rows(joins.salted_join(*frames, "k", salt_by=["a"])) == expected(*data, "inner")


def test_salting_spreads_copies(spark):
    """Equal rows of one hot key part by the input partition they come from."""
    large = spark.range(0, 4000, numPartitions=16).select(F.lit(1).alias("k"), F.lit("same").alias("a"))
    small = spark.createDataFrame([(1, "x")], "k int, b string")
    content = F.pmod(F.xxhash64("k", "a", F.spark_partition_id()), F.lit(8))
    assert large.select(content.alias("s")).distinct().count() > 3
    assert joins.salted_join(large, small, "k", salt_buckets=8).count() == 4000


def test_only_hot_keys_are_copied(spark):
    large = spark.range(1000).select(F.when(F.col("id") < 500, -1).otherwise(F.col("id")).alias("k"))
    hot = joins._hot_keys(large, ["k"], 0.01).collect()
    assert [r["k"] for r in hot] == [-1]


def test_two_keys_and_equal_column_names(spark):
    left = spark.createDataFrame([(1, 1, "l1"), (1, 2, "l2")], "a int, b int, v string")
    right = spark.createDataFrame([(1, 1, "r1"), (3, 3, "r3")], "a int, b int, v string")
    for df in (joins.join_tables(left, right, ["a", "b"], "full"), joins.salted_join(left, right, ["a", "b"], "full")):
        assert df.columns == ["a", "b", "v", "v"]
        assert rows(df) == [(1, 1, "l1", "r1"), (1, 2, "l2", None), (3, 3, None, "r3")]


def test_where(frames, data):
    got = rows(joins.join_tables(*frames, "k", "left", where="b IS NULL OR a > 100"))
    assert got == [r for r in expected(*data, "left") if r[2] is None or r[1] > 100]


def test_select(frames, data):
    df = joins.join_tables(*frames, "k", "left", where="a IS NOT NULL", select=["b", "k + 1 AS next"])
    assert df.columns == ["b", "next"] and df.count() == len([r for r in expected(*data, "left") if r[1] is not None])


def test_known_hot_keys_cost_no_pass(spark, frames, data):
    hot = frames[0].select("k").distinct().limit(2)
    assert rows(joins.salted_join(*frames, "k", "inner", 3, hot_keys=hot)) == expected(*data, "inner")
    text = joins.salted_join(*frames, "k", hot_keys=spark.createDataFrame([(1,)], "k int"))._jdf.queryExecution().optimizedPlan().toString()
    assert "count(" not in text


def test_unknown_type(frames):
    for join in (joins.join_tables, joins.broadcast_join, joins.salted_join):
        with pytest.raises(ValueError, match="Unknown join type"):
            join(*frames, "k", "sideways")
    for options in ({"salt_buckets": 0}, {"hot_share": 1e-8}):
        with pytest.raises(ValueError):
            joins.salted_join(*frames, "k", **options)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_has_a_size_limit(spark, frames):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "BroadcastHashJoin" in plan(joins.broadcast_join(*frames, "k"))
        assert "BroadcastHashJoin" not in plan(joins.broadcast_join(*frames, "k", max_bytes=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_cross_join(frames):
    for kind in KINDS:
        text = plan(joins.salted_join(*frames, "k", kind))
        assert "CartesianProduct" not in text and "NestedLoop" not in text
