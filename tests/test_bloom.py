"""Joins behind a Bloom filter: the rows of the plain join, with few rows shuffled."""

import pytest
from pyspark.sql import functions as F

from tableops.operators.bloom import bloom_join, bloom_table, filter_blocks, mark_maybe


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def shuffled_bytes(spark, df):
    """Bytes written to shuffles by a run of the plan."""
    store = spark.sparkContext._jsc.sc().statusStore()
    jvm = spark.sparkContext._jvm

    def total():
        nothing = spark.sparkContext._gateway.new_array(jvm.double, 0)
        stages = store.stageList(None, False, False, nothing, jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = total()
    df.write.format("noop").mode("overwrite").save()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return total() - before


@pytest.mark.parametrize("how", ["semi", "anti", "inner"])
@pytest.mark.parametrize("expected", [None, 1, 10_000])
def test_equals_the_plain_join(spark, how, expected):
    large = spark.range(3_000).selectExpr("IF(id % 50 = 0, NULL, id % 700) AS k", "concat('a', id % 3) AS m", "id AS v", "1 AS `a.b`")
    other = spark.range(900).selectExpr("IF(id % 40 = 0, NULL, CAST(id % 200 * 3 AS INT)) AS k", "concat('a', id % 2) AS m", "id AS w")
    plain = large.join(other, ["k", "m"], "inner" if how == "inner" else f"left_{how}")
    assert rows(bloom_join(large, other, ["k", "m"], how, expected)) == rows(plain)
    assert rows(bloom_join(large, other, ["k", "m"], how, max_bytes=0)) == rows(plain)


def test_empty_sides_and_odd_keys(spark):
    large = spark.createDataFrame([(0.0, 1), (-0.0, 2), (float("nan"), 3), (None, 4), (1.5, 5)], "k double, v int")
    none = large.limit(0).select("k")
    assert rows(bloom_join(large, none, "k")) == [] and len(rows(bloom_join(large, none, "k", "anti"))) == 5
    assert rows(bloom_join(large.limit(0), large, "k")) == []
    zeros = spark.createDataFrame([(-0.0,), (float("nan"),), (None,)], "k float")
    assert sorted(r["v"] for r in bloom_join(large, zeros, "k").collect()) == [1, 2, 3]
    assert sorted(r["v"] for r in bloom_join(large, zeros, "k", "anti").collect()) == [4, 5]
    with pytest.raises(ValueError):
        bloom_join(large, none, "k", "left")
    lists = spark.createDataFrame([([1], 1)], "k array<int>, v int")
    with pytest.raises(ValueError):
        bloom_join(lists, lists, "k")


def test_few_false_positives(spark):
    there, types = spark.range(20_000).selectExpr("id * 7 AS k"), [spark.range(1).schema["id"].dataType]
    blocks = filter_blocks(20_000)
    bloom = bloom_table(there, ["k"], types, blocks)
    assert bloom.count() <= blocks
    marked = mark_maybe(spark.range(140_000).selectExpr("id AS k"), bloom, ["k"], types, blocks)
    found = {r["inside"]: (r["n"], r["maybe"]) for r in marked.groupBy((F.col("k") % 7 == 0).alias("inside")).agg(F.count("*").alias("n"), F.count_if("__maybe").alias("maybe")).collect()}
    assert found[True] == (20_000, 20_000) and found[False][1] < 0.01 * found[False][0]


def test_fewer_bytes_are_shuffled(spark):
    large = spark.range(400_000).selectExpr("id AS k", "sha2(CAST(id AS STRING), 256) AS body")
    other = spark.range(4_000).selectExpr("id * 100 AS k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for how in ("semi", "anti"):
            plain = shuffled_bytes(spark, large.join(other.distinct(), "k", f"left_{how}"))
            assert shuffled_bytes(spark, bloom_join(large, other, "k", how)) < 0.1 * plain
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key(spark):
    large = spark.range(60_000).selectExpr("IF(id % 3 = 0, 5, id) AS k", "id AS v")
    other = spark.range(1_000).selectExpr("id % 10 AS k")
    assert bloom_join(large, other, "k").count() == large.where("k < 10").count()
    assert bloom_join(large, other, "k", "anti").count() == large.where("k >= 10").count()
