"""Runs of a streaming query that take what is there and end."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Run:
    """What one run took in: input rows, micro-batches, and rows that came after their window had closed."""

    rows: int
    batches: int
    late: int


def state_session(spark: SparkSession, partitions: int) -> SparkSession:
    """A session with its own settings on the same context: state is kept in this many partitions for good.

    A stateful query can't change their number later, so it should not depend on what the caller's session is set to.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    session.conf.set("spark.sql.streaming.numRecentProgressUpdates", "10000")
    for name in ("spark.sql.session.timeZone",):
        session.conf.set(name, spark.conf.get(name))
    return session


def run_available(rows: DataFrame, target: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> Run:
    """Append all rows that are available now to the Parquet directory ``target`` and return when they are written.

    The checkpoint holds the sources' offsets and the state, and the target's own log names the files of each finished
    micro-batch: Spark reads only those, so a batch that failed midway and ran again counts once. A failure is raised, and the
    next run goes on from the last finished batch.
    """
    writer = rows.writeStream.format("parquet").outputMode("append").trigger(availableNow=True).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start(target)
    try:
        query.awaitTermination()
    finally:
        query.stop()
    progress = query.recentProgress
    late = sum(state.numRowsDroppedByWatermark for p in progress for state in p.stateOperators)
    return Run(sum(p.numInputRows for p in progress), sum(p.numInputRows > 0 for p in progress), late)
