import pytest
from pyspark.sql import functions as F

from tableops.operators.quality import null_profile, require_columns, validate


def test_returns_the_table(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    assert validate(df, ["id", "name"]) is df


def test_missing_column(spark):
    with pytest.raises(ValueError, match="Missing required columns"):
        require_columns(spark.range(1), ["id", "other"])


def test_too_few_rows(spark):
    with pytest.raises(ValueError, match="minimum required"):
        validate(spark.range(1), ["id"], min_rows=10)
    with pytest.raises(ValueError, match="minimum required"):
        validate(spark.range(1), [], min_rows=10)


def test_null_ratio(spark):
    df = spark.createDataFrame([(None,), (None,), (None,), (1,)], "id int")
    with pytest.raises(ValueError, match="75.0% nulls"):
        validate(df, ["id"], null_threshold=0.5)
    validate(df, ["id"], null_threshold=0.75)


def test_profile_counts_nulls_but_not_nan(spark):
    df = spark.createDataFrame([(None, 1), (float("nan"), 2), (1.0, None), (2.0, 3)], "a double, b int")
    rows = {r["column"]: (r["n_nulls"], r["n_rows"], r["null_ratio"]) for r in null_profile(df, ["a", "b"]).collect()}
    assert rows == {"a": (1, 4, 0.25), "b": (1, 4, 0.25)}


def test_profile_of_an_empty_table(spark):
    row = null_profile(spark.range(0), ["id"]).first()
    assert (row["n_nulls"], row["n_rows"], row["null_ratio"]) == (0, 0, 0.0)
    validate(spark.range(0), ["id"], min_rows=0)


def test_profile_takes_one_pass(spark):
    df = spark.range(10).withColumn("b", F.lit(1))
    plan = null_profile(df, ["id", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and plan.count("Exchange") == 1
