from pyspark.sql import functions as F

from tableops.operators.ordering import preview, sort_rows, top_k_per_group


def test_sort(spark):
    df = spark.createDataFrame([(1, "b"), (3, "a"), (2, "b"), (None, "c")], "x int, y string")
    assert [r["x"] for r in sort_rows(df, F.desc("x")).collect()] == [3, 2, 1, None]
    assert [tuple(r) for r in sort_rows(df, "y", F.desc("x")).collect()] == [(3, "a"), (2, "b"), (1, "b"), (None, "c")]
    assert sort_rows(df, "y").columns == ["x", "y"]


def test_frequent_value_spans_partitions(spark):
    df = spark.range(0, 8000, numPartitions=8).select(F.lit(1).alias("x"), "id")
    sizes = sort_rows(df, "x").groupBy(F.spark_partition_id()).count().collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        sizes = sort_rows(df, "x").withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 2


def test_preview(spark):
    df = preview(spark.range(100), [F.desc("id")], 3)
    assert [r["id"] for r in df.collect()] == [99, 98, 97]
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_top_k(spark):
    rows = [("a", 5, 1), ("a", 5, 2), ("a", 4, 3), ("a", 3, 4), ("b", None, 5), ("b", 1, 6), (None, 7, 7), (None, 8, 8)]
    df = spark.createDataFrame(rows, "g string, m int, id int")
    got = top_k_per_group(df, ["g"], "m", 2)
    assert got.columns == ["g", "m", "id", "rank"]
    assert sorted((r["id"], r["rank"]) for r in got.collect()) == [(1, 1), (2, 1), (3, 2), (5, 2), (6, 1), (7, 2), (8, 1)]


def test_top_k_keeps_all_ties(spark):
    df = spark.range(500).select("id", F.lit("g").alias("g"), (F.col("id") % 5).alias("m"))
    got = top_k_per_group(df, ["g"], "m", 2)
    assert got.count() == 200


def test_top_k_prunes_before_the_shuffle(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("g"), (F.col("id") % 5).alias("m"))
    plan = top_k_per_group(df, ["g"], "m", 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
