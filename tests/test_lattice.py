"""Grouping lattice against Spark's own grouping sets."""

import random

import pytest
from pyspark.sql import functions as F

from tableops.operators.lattice import cube_sets, grouping_lattice, rollup_sets


def data(spark, n=500):
    r = random.Random(4)
    rows = [(r.choice([None, "a", "b", "a b"]), r.choice([1, 2, None]), r.choice(["x", "y"]), r.choice([None, r.randrange(90)]), r.randrange(40), r.choice([None, "u", "v"])) for _ in range(n)]
    return spark.createDataFrame(rows, "`a.1` string, b int, c string, v int, who int, how string")


def rows_of(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)


METRICS = {"v": ["sum", "count", "avg", "min", "max"]}


@pytest.mark.parametrize("sets", [cube_sets(["a.1", "b", "c"]), rollup_sets(["c", "a.1"]), [["b"], ["c"], ["b"], ["c", "b"]], [["a.1", "c"], ["b"]], [[]]])
def test_same_as_spark(spark, sets):
    df = data(spark)
    found = grouping_lattice(df, sets, METRICS, ["who", "how"])
    columns = list(dict.fromkeys(c for s in sets for c in s))
    df.withColumnRenamed("a.1", "a_1").createOrReplaceTempView("lattice_rows")
    want, names = [], [c.replace(".", "_") for c in columns]
    for s in {tuple(sorted(s)) for s in map(tuple, sets)}:
        ids = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s)
        kept = [n if c in s else f"CAST(NULL AS {dict(df.dtypes)[c]})" for c, n in zip(columns, names)]
        by = [n for c, n in zip(columns, names) if c in s]
        want += rows_of(
            spark.sql(
                f"SELECT {''.join(k + ', ' for k in kept)} {ids}L, sum(v), count(v), avg(v), min(v), max(v), count(DISTINCT who), count(DISTINCT how) "
                f"FROM lattice_rows {'GROUP BY ' + ', '.join(by) if by else ''}"
            )
        )
    assert rows_of(found) == sorted(want, key=repr)
    assert found.columns == [*columns, "grouping_id", *[f"{m}_v" for m in METRICS["v"]], "distinct_who", "distinct_how"]


def test_sketches(spark):
    df = spark.range(60_000).selectExpr("id % 3 AS g", "id % 20000 AS who", "id AS v")
    found = {r.g: r.distinct_who for r in grouping_lattice(df, cube_sets(["g"]), {"v": ["sum"]}, ["who"], sketch=True).collect()}
    assert set(found) == {None, 0, 1, 2} and all(abs(n - 20_000) < 800 for n in found.values())


def test_raw_rows_are_shuffled_once(spark):
    df = data(spark)
    found = grouping_lattice(df, cube_sets(["a.1", "b", "c"]), METRICS, ["who"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation" not in plan  # it reads the finest states only


def test_only_distinct_and_empty(spark):
    df = data(spark, 50)
    one = grouping_lattice(df, [["c"], []], {}, ["who"]).where("c IS NULL").first()
    assert one["distinct_who"] == df.select("who").distinct().count()
    nothing = grouping_lattice(df.limit(0), cube_sets(["b"]), METRICS, ["who"]).collect()
    assert [tuple(r) for r in nothing] == [(None, 1, None, 0, None, None, None, 0)]
    for wrong in (([], METRICS), ([["b"]], {}), ([["b"]], {"v": ["median"]})):
        with pytest.raises(ValueError):
            grouping_lattice(df, *wrong)
