import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from tableops.operators import layout
from tableops.scratch import scratch_path, shared_folder


class TestPartitions:
    def test_fewer_without_a_shuffle(self, spark):
        df = layout.set_partitions(spark.range(0, 100, numPartitions=10), 4, fewer=True)
        assert df.rdd.getNumPartitions() == 4
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()

    def test_more_with_a_shuffle(self, spark):
        df = layout.set_partitions(spark.range(0, 100, numPartitions=2), 6)
        assert df.rdd.getNumPartitions() == 6
        assert df.count() == 100

    def test_by_column_keeps_the_count_and_splits_a_hot_value(self, spark):
        df = spark.range(0, 4000, numPartitions=4).select(F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("k"), "id")
        spread = layout.set_partitions(df, 16, "k")
        assert spread.columns == ["k", "id"]
        homes = spread.withColumn("p", F.spark_partition_id())
        assert homes.select("p").distinct().count() == 16
        assert homes.filter("k = 1").select("p").distinct().count() > 8

    def test_gather(self, spark):
        df = spark.range(1000).withColumn("k", F.col("id") % 5)
        kept = layout.gather(df, "k", keep_together=True)
        homes = kept.withColumn("p", F.spark_partition_id()).groupBy("k").agg(F.count_distinct("p").alias("n"))
        assert {r["n"] for r in homes.collect()} == {1}
        assert "REBALANCE_PARTITIONS_BY_COL" in layout.gather(df, "k")._jdf.queryExecution().executedPlan().toString()

    def test_gather_splits_a_hot_value(self, spark):
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
        try:
            df = spark.range(0, 400_000, numPartitions=8).select(F.lit(1).alias("k"), F.rand(1).alias("v"))
            split = layout.gather(df, "k").rdd.getNumPartitions()
        finally:
            spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        assert split > 4


class TestCache:
    @pytest.mark.parametrize(
        "name, level",
        [
            ("memory_only", StorageLevel.MEMORY_ONLY),
            ("disk_only", StorageLevel.DISK_ONLY),
            ("anything", StorageLevel.MEMORY_AND_DISK),
        ],
    )
    def test_levels(self, spark, name, level):
        df = layout.cache(spark.range(3).withColumn("x", F.lit(name)), name)
        assert df.storageLevel.useDisk == level.useDisk and df.storageLevel.useMemory == level.useMemory
        assert not layout.uncache(df).is_cached


    def test_released_after_use(self, spark):
        df = spark.range(3).withColumn("y", F.lit("released"))
        with pytest.raises(RuntimeError):
            with layout.cached(df) as kept:
                assert kept.is_cached and kept.count() == 3
                raise RuntimeError
        assert not df.is_cached


class TestProfiles:
    def test_partitions(self, spark):
        df = spark.createDataFrame([(i,) for i in range(10)], "id int").coalesce(1)
        assert tuple(layout.partition_profile(df).first()) == (1, 10, 10, 10, 0.0)

    def test_empty_partitions_count(self, spark):
        df = spark.range(0, 8, numPartitions=4).filter("id < 2")
        assert tuple(layout.partition_profile(df, 4).first()) == (4, 2, 0, 2, 4.0)
        assert tuple(layout.partition_profile(df).first()) == (1, 2, 2, 2, 0.0)

    def test_empty_table(self, spark):
        assert tuple(layout.partition_profile(spark.range(0, 0, numPartitions=2), 2).first()) == (2, 0, 0, 0, 0.0)

    def test_keys(self, spark):
        df = spark.range(100).select(F.when(F.col("id") < 60, 0).otherwise(F.col("id")).alias("k"))
        rows = [tuple(r) for r in layout.key_profile(df, ["k"], 2).collect()]
        assert rows == [(0, 60, 0.6), (60, 1, 0.01)]


class TestScratch:
    def test_paths_differ(self, spark):
        assert scratch_path(spark, "x") != scratch_path(spark, "x")
        assert scratch_path(spark, "x").startswith(shared_folder(spark).rstrip("/"))

    def test_checkpoints_go_there(self, spark):
        shared_folder(spark)
        assert spark.sparkContext.getCheckpointDir()
        assert spark.range(3).checkpoint().count() == 3

    def test_own_folder_only_on_a_local_master(self):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(_FakeSession("spark://cluster:1"))
        local = _FakeSession("local[2]")
        folder = shared_folder(local)
        assert shared_folder(local) == folder == local.sparkContext.getCheckpointDir()


class _FakeSession:
    """A session without a checkpoint folder, as seen by shared_folder."""

    def __init__(self, master):
        self.conf, self.sparkContext, self.master, self._folder = {}, self, master, None

    def getCheckpointDir(self):
        return self._folder

    def setCheckpointDir(self, folder):
        self._folder = folder
