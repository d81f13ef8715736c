"""Queries that run streams of files to their end, with their SQL over the whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableops.catalog.tables import table
from tableops.scratch import scratch_path
from tableops.streaming.ingest import file_stream, ingest_files, ingested
from tableops.streaming.runs import state_session
from tableops.streaming.windows import event_windows, run_windows, sessions

_STATE_PARTITIONS = 8
_ARRIVALS = 3  # the events come in so many parts, each up to five hours out of order


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive in three parts, taken in after each; a last run finds nothing new."""
    events = table(spark, sf_dir, "events")
    source, target, checkpoint = (scratch_path(spark, name) for name in ("arriving", "ingested", "offsets"))
    for part in range(_ARRIVALS):
        events.where(F.col("event_id") % _ARRIVALS == part).write.mode("append").parquet(source)
        ingest_files(spark, source, events.schema, target, checkpoint)
    again = ingest_files(spark, source, events.schema, target, checkpoint)
    return ingested(spark, target).withColumn("rows_again", F.lit(again.rows))


def _streamed(spark: SparkSession, sf_dir: str, windows) -> DataFrame:
    """Closed windows of the events, run after each part arrives; two rows far ahead of all others close the last ones."""
    session = state_session(spark, _STATE_PARTITIONS)
    session.conf.set("spark.sql.session.timeZone", "UTC")  # windows count from midnight of the times as they stand
    events = table(session, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    source, target, checkpoint = (scratch_path(spark, name) for name in ("arriving", "closed", "state"))
    arrival = F.unix_seconds("ts") + 3600 * (F.col("event_id") % 5)
    bounds = events.agg(F.min(arrival).alias("first"), F.max(arrival).alias("last")).first()
    cuts = [bounds["first"] + (bounds["last"] + 1 - bounds["first"]) * i // _ARRIVALS for i in range(_ARRIVALS + 1)]
    parts = [events.where((arrival >= a) & (arrival < b)) for a, b in zip(cuts, cuts[1:])]
    ahead = [session.range(1).selectExpr("-1L AS event_id", "-1L AS user_id", "'' AS event_type", f"TIMESTAMP'{year}-01-01' AS ts", "0D AS value") for year in (2100, 2200)]
    for part in [*parts, *ahead]:
        part.write.mode("append").parquet(source)
        run_windows(windows(file_stream(session, source, events.schema)), target, checkpoint)
    return session.read.parquet(target)


def _ntz(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")} | {"total": F.round("total", 6)})


def _metrics() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")]


def q_stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = _streamed(spark, sf_dir, lambda rows: event_windows(rows, "ts", ["event_type"], "6 hours", _metrics(), "12 hours"))
    return _ntz(closed.where("event_type <> ''"))


def q_stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = _streamed(spark, sf_dir, lambda rows: sessions(rows, "ts", ["user_id"], "6 hours", _metrics(), "12 hours"))
    return _ntz(closed.where("user_id >= 0"))


QUERIES = {
    "stream_ingest": q_stream_ingest,
    "stream_tumbling": q_stream_tumbling,
    "stream_sessions": q_stream_sessions,
}

ORACLE_SQL = {
    "stream_ingest": "SELECT *, 0 AS rows_again FROM events",
    "stream_tumbling": """
SELECT time_bucket(INTERVAL 6 HOURS, ts) AS window_start, time_bucket(INTERVAL 6 HOURS, ts) + INTERVAL 6 HOURS AS window_end,
       event_type, count(*) AS n, round(sum(value), 6) AS total
FROM events GROUP BY 1, 2, 3""",
    "stream_sessions": """
WITH apart AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 HOURS THEN 0 ELSE 1 END AS fresh
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
), numbered AS (
  SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS number FROM apart
)
SELECT min(ts) AS window_start, max(ts) + INTERVAL 6 HOURS AS window_end, user_id, count(*) AS n, round(sum(value), 6) AS total
FROM numbered GROUP BY user_id, number""",
}
