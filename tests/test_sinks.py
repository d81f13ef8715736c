import os

import pytest
from pyspark.sql import functions as F

from tableops.sinks import list_partitions, read_back, write_parquet


@pytest.fixture()
def df(spark):
    return spark.range(60).select(
        "id", (F.col("id") % 3 + 2022).cast("int").alias("year"), (F.col("id") % 2).cast("int").alias("half")
    )


def test_round_trip(spark, df, tmp_path):
    path = str(tmp_path / "out")
    assert write_parquet(df, path) == 60
    assert sorted(map(tuple, read_back(spark, path, expected_rows=60).collect())) == sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("codec", ["snappy", "gzip", "lz4", "zstd", "none"])
def test_codecs(spark, df, tmp_path, codec):
    path = str(tmp_path / "out")
    write_parquet(df, path, compression=codec)
    assert read_back(spark, path).count() == 60


def test_save_modes(spark, df, tmp_path):
    path = str(tmp_path / "out")
    write_parquet(df, path)
    assert write_parquet(df, path, mode="append") == 60
    assert read_back(spark, path).count() == 120
    assert write_parquet(df, path, mode="ignore") is None
    assert read_back(spark, path).count() == 120
    with pytest.raises(Exception, match="(?i)already exists"):
        write_parquet(df, path, mode="error")
    write_parquet(df, path)
    assert read_back(spark, path).count() == 60
    with pytest.raises(ValueError, match="Unknown save mode"):
        write_parquet(df, path, mode="replace")


def test_partitioned(spark, df, tmp_path):
    path = str(tmp_path / "out")
    assert write_parquet(df, path, ["year", "half"]) == 60
    assert sorted(d for d in os.listdir(path) if d.startswith("year")) == ["year=2022", "year=2023", "year=2024"]
    part = read_back(spark, path, where="year = 2023 AND half = 1")
    assert part.count() == 10
    assert "PartitionFilters: [isnotnull(year" in part._jdf.queryExecution().executedPlan().toString()


def test_gathered_directories_have_few_files(spark, df, tmp_path):
    path = str(tmp_path / "out")
    write_parquet(df.repartition(8), path, ["year"])
    assert {r["n_files"] for r in list_partitions(spark, path, ["year"]).collect()} == {1}


def test_dynamic_overwrite(spark, df, tmp_path):
    path = str(tmp_path / "out")
    write_parquet(df, path, ["year"])
    write_parquet(df.filter("year = 2023").withColumn("id", F.lit(-1).cast("long")).limit(1), path, ["year"])
    counts = {r["year"]: r["n_rows"] for r in list_partitions(spark, path, ["year"]).collect()}
    assert counts == {2022: 20, 2023: 1, 2024: 20}
    write_parquet(df.filter("year = 2024"), path, ["year"], dynamic=False)
    assert read_back(spark, path).count() == 20


def test_list_partitions(spark, df, tmp_path):
    path = str(tmp_path / "out")
    write_parquet(df, path, ["year", "half"])
    listed = list_partitions(spark, path, ["year", "half"])
    assert listed.columns == ["year", "half", "n_rows", "n_files"]
    assert listed.count() == 6 and listed.agg(F.sum("n_rows")).first()[0] == 60


def test_read_back_checks(spark, df, tmp_path):
    path = str(tmp_path / "out")
    write_parquet(df, path, ["year"])
    with pytest.raises(ValueError, match="Expected 61 rows .* found 60"):
        read_back(spark, path, expected_rows=61)
    with pytest.raises(ValueError, match="Missing required columns"):
        read_back(spark, path, expected_columns=["id", "price"])
    assert read_back(spark, path, expected_rows=20, where="year = 2022").count() == 20
    assert read_back(spark, path, schema=df.schema).schema["year"].dataType == df.schema["year"].dataType
