"""Upserts by key: equal to a full rewrite, only touched directories written, whole or not at all."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableops.plans import upsert as module
from tableops.plans.upsert import KeyedTable, Upserted, read_current, unused_files, upsert

SCHEMA = T.StructType().add("id", T.LongType()).add("place", T.StringType()).add("year", T.IntegerType()).add("body", T.StringType())


def keyed(path):
    return KeyedTable(str(path / "table"), SCHEMA, ("id",), ("year", "place"))


def some(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(spark, table):
    rows = [tuple(r) for r in read_current(spark, table).collect()]
    assert len(rows) == len({r[0] for r in rows})
    return {r[0]: r for r in rows}


def test_equals_a_full_rewrite(spark, tmp_path):
    table = keyed(tmp_path)
    assert content(spark, table) == {}
    first = [(i, [None, "a/b", "1:a", ""][i % 4], 2000 + i % 3, f"v{i}") for i in range(200)]
    assert upsert(spark, table, some(spark, first)) == Upserted(1, 0, 200, 9, 0)
    want = {r[0]: r for r in first}
    want = {k: (r[0], r[1] or None, *r[2:]) for k, r in want.items()}  # directories know no empty text
    assert content(spark, table) == want
    second = [(i, "a/b", 2000, "new") for i in range(190, 230)] + [(5, "1:a", 2002, "moved")]
    result = upsert(spark, table, some(spark, second))
    want |= {r[0]: r for r in second}
    assert content(spark, table) == want and (result.replaced, result.added) == (11, 30)
    assert upsert(spark, table, some(spark, [])) == Upserted(2, 0, 0, 0, result.written + result.left)


def versions(spark, table):
    return {tuple(r)[:-1]: r["__version"] for r in module._newest(spark, table)[1].collect()}


def test_only_touched_directories(spark, tmp_path):
    table = keyed(tmp_path)
    upsert(spark, table, some(spark, [(i, f"p{i % 5}", 2000 + i % 2, "x") for i in range(100)]))
    assert upsert(spark, table, some(spark, [(10, "p0", 2000, "y"), (500, "p9", 2007, "z")])) == Upserted(2, 1, 1, 2, 9)
    found = versions(spark, table)
    assert {place for place, version in found.items() if version == 2} == {(2000, "p0"), (2007, "p9")}
    assert upsert(spark, table, some(spark, [(500, "p0", 2000, "back")])) == Upserted(3, 1, 0, 1, 9)
    assert (2007, "p9") not in versions(spark, table)  # its last row moved away
    stale = [r["path"] for r in unused_files(spark, table).collect()]
    assert stale and all("year=2000/place=p0" in p or "year=2007/place=p9" in p for p in stale)
    assert not any("__version=3" in p for p in stale)


def test_failure_leaves_the_old_table(spark, tmp_path, monkeypatch):
    table = keyed(tmp_path)
    upsert(spark, table, some(spark, [(1, "p", 2000, "old"), (2, "q", 2000, "old")]))
    before = content(spark, table)

    def fails(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(module, "_publish", fails)
        with pytest.raises(OSError):
            upsert(spark, table, some(spark, [(1, "q", 2000, "half")]))
    assert content(spark, table) == before
    upsert(spark, table, some(spark, [(2, "q", 2000, "whole")]))
    assert content(spark, table) == {1: (1, "p", 2000, "old"), 2: (2, "q", 2000, "whole")}


def test_equal_and_null_keys(spark, tmp_path):
    table = keyed(tmp_path)
    twice = some(spark, [(1, "p", 2000, "b"), (1, "q", 2001, "a")])
    with pytest.raises(ValueError):
        upsert(spark, table, twice)
    with pytest.raises(ValueError):
        upsert(spark, table, some(spark, [(None, "p", 2000, "b")]))
    with pytest.raises(ValueError):
        upsert(spark, table, twice.drop("body"))
    upsert(spark, table, twice, order_by=[F.col("body")])
    assert content(spark, table) == {1: (1, "q", 2001, "a")}


def test_many_directories_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(module, "MAX_NAMED", 1)
    test_only_touched_directories(spark, tmp_path)
