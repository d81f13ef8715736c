"""Streams of files: every row once, also after a failed run; windows equal to the batch ones; late rows counted."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableops.streaming.ingest import file_stream, ingest_files, ingested
from tableops.streaming.runs import state_session
from tableops.streaming.windows import event_windows, run_windows, sessions

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
EVENTS = T.StructType([T.StructField("user", T.LongType()), T.StructField("ts", T.TimestampType()), T.StructField("value", T.LongType())])


def lines(path, content):
    path.write_text(content)
    return path


def test_each_row_once(spark, tmp_path):
    source, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    source.mkdir()
    arguments = (spark, str(source), SCHEMA, target, checkpoint, "csv")
    lines(source / "a.csv", "1,a\n2,b\n")
    lines(source / "b.csv", "3,c\n")
    run = ingest_files(*arguments, {"mode": "FAILFAST"}, files_per_batch=1)
    assert (run.rows, run.batches) == (3, 2)
    assert ingest_files(*arguments, {"mode": "FAILFAST"}).rows == 0
    bad = lines(source / "c.csv", "4,d\nx,y,z\n")
    lines(source / "d.csv", "5,e\n")
    with pytest.raises(StreamingQueryException):
        ingest_files(*arguments, {"mode": "FAILFAST"})
    assert ingested(spark, target).count() == 3
    lines(bad, "4,d\n6,f\n")
    ingest_files(*arguments, {"mode": "FAILFAST"})
    assert sorted(tuple(r) for r in ingested(spark, target).collect()) == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e"), (6, "f")]


def test_stamp_and_directories(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    lines(source / "a.json", '{"id":1,"name":"a"}\n{"id":2,"name":"b"}\n')
    ingest_files(spark, str(source), SCHEMA, str(tmp_path / "out"), str(tmp_path / "c"), "json", partition_by=["name"], stamp=True)
    rows = ingested(spark, str(tmp_path / "out")).collect()
    assert {(r["id"], r["name"], r["source_file"]) for r in rows} == {(1, "a", "a.json"), (2, "b", "a.json")}
    assert os.path.isdir(tmp_path / "out" / "name=a")
    with pytest.raises(ValueError):
        file_stream(spark, str(source), SCHEMA, "xlsx")


def write_batches(spark, folder, batches):
    """One file per batch, oldest first."""
    for i, rows in enumerate(batches):
        path = f"{folder}/b{i}"
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.json(f"{folder}-tmp{i}")
        part = next(f for f in os.listdir(f"{folder}-tmp{i}") if f.startswith("part-"))
        os.makedirs(folder, exist_ok=True)
        os.link(f"{folder}-tmp{i}/{part}", f"{path}.json")
        os.utime(f"{path}.json", (1_700_000_000 + i, 1_700_000_000 + i))


def at(minutes):
    return datetime(2024, 1, 1) + timedelta(minutes=minutes)


def metrics():
    return [F.count("*").alias("n"), F.sum("value").alias("total")]


@pytest.mark.parametrize("kind", ["tumbling", "sliding", "sessions"])
def test_windows_equal_the_batch(spark, tmp_path, kind):
    def windows(rows, delay=None):
        if kind == "sessions":
            return sessions(rows, "ts", ["user"], "10 minutes", metrics(), delay)
        return event_windows(rows, "ts", ["user"], "30 minutes", metrics(), delay, "10 minutes" if kind == "sliding" else None)

    jitter = [0, 25, -20, 10, -5, 15]
    rows = [(i % 3, at(4 * i + jitter[i % 6]), i) for i in range(90)] + [(1, None, 5)]
    flush = [[(9, at(100_000 + 100 * i), 0)] for i in range(2)]
    folder, target, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    session = state_session(spark, 2)
    stream = lambda: file_stream(session, folder, EVENTS, "json", files_per_batch=1)
    write_batches(spark, folder, [rows[i : i + 15] for i in range(0, 45, 15)])
    first = run_windows(windows(stream(), "60 minutes"), target, checkpoint)
    assert first.batches == 3 and first.late == 0
    write_batches(spark, str(tmp_path / "later"), [rows[i : i + 15] for i in range(45, 91, 15)] + flush)
    for i, name in enumerate(sorted(os.listdir(tmp_path / "later"))):
        os.link(tmp_path / "later" / name, f"{folder}/z{i}.json")
        os.utime(f"{folder}/z{i}.json", (1_700_001_000 + i, 1_700_001_000 + i))
    second = run_windows(windows(stream(), "60 minutes"), target, checkpoint)
    assert second.late == 0 and first.rows + second.rows == len(rows) + 2
    got = sorted(tuple(r) for r in spark.read.parquet(target).collect() if r["user"] != 9)
    want = sorted(tuple(r) for r in windows(spark.createDataFrame(rows, EVENTS)).collect())
    assert got == want and len(want) > 10


def test_late_rows_are_counted(spark, tmp_path):
    folder = str(tmp_path / "in")
    batches = [[(1, at(0), 1)], [(1, at(500), 1)], [(1, at(600), 1)], [(1, at(700), 1)], [(1, at(5), 7), (2, at(6), 7), (2, at(710), 1)], [(1, at(9_000), 1)], [(1, at(9_900), 1)]]
    write_batches(spark, folder, batches)
    stream = file_stream(state_session(spark, 2), folder, EVENTS, "json", files_per_batch=1)
    run = run_windows(event_windows(stream, "ts", ["user"], "30 minutes", metrics(), "60 minutes"), str(tmp_path / "out"), str(tmp_path / "c"))
    assert run.late == 2 and run.rows == 9
    closed = spark.read.parquet(str(tmp_path / "out"))
    assert closed.agg(F.sum("n")).first()[0] == run.rows - run.late - 1  # the last window is open
    with pytest.raises(ValueError):
        event_windows(stream, "ts", [], "5 minutes", metrics())
