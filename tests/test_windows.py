import random

import pytest
from pyspark.sql import functions as F

from tableops.operators import windows
from tableops.operators.windows import _chunk_carry, _Spec, window_columns
from tableops.scratch import Tables

@pytest.fixture(autouse=True)
def small_chunks(spark):
    """Adaptive execution then leaves several chunks also on small tables."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


SCHEMA = "id long, g string, o int, v long"
COLUMNS = ["row_num", "rank", "dense_rank", "lag_v", "lead_v", "running_total"]


def brute_force(rows, lag, lead):
    """Expected window columns by id, from a plain Python sort per group."""
    expected = {}
    for group in {g for _, g, _, _ in rows}:
        # order: o descending with nulls last, then id ascending
        members = sorted((r for r in rows if r[1] == group), key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
        rank = dense = 0
        for i, (key, _, o, v) in enumerate(members):
            if i == 0 or members[i - 1][2] != o:
                rank, dense = i + 1, dense + 1
            after = [m[3] for m in members[i:] if m[3] is not None]
            expected[key] = (
                i + 1,
                rank,
                dense,
                members[i - lag][3] if i >= lag else None,
                members[i + lead][3] if i + lead < len(members) else None,
                sum(after) if after else None,
            )
    return expected


def random_rows(seed, n, values):
    """A hot group with a third of the rows, null groups, many ties and a hot order value."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        group = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", None])
        order = 3 if rng.random() < 0.34 else rng.choice([None, *range(values)])
        rows.append((i, group, order, rng.choice([None, 1, 2, 5, -4])))
    return rows


def result(df):
    return {r["id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("lag, lead", [(1, 1), (3, 2), (40, 55)])
@pytest.mark.parametrize("values", [4, 1000])
def test_against_brute_force(spark, split, lag, lead, values):
    rows = random_rows(lag + values, 400, values)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = window_columns(
        df, "g", "o", "v", lag=lag, lead=lead, tie_break=["id"], split=split
    )
    assert got.columns == ["id", "g", "o", "v", *COLUMNS]
    assert result(got) == brute_force(rows, lag, lead)


def test_split_and_plain_have_the_same_schema(spark):
    df = spark.createDataFrame(random_rows(1, 50, 4), SCHEMA).withColumn("v", F.col("v").cast("decimal(9,2)"))
    plans = [window_columns(df, ["g"], "o", "v", tie_break=["id"], split=s) for s in (False, True)]
    assert [f.dataType for f in plans[0].schema] == [f.dataType for f in plans[1].schema]


def test_one_value_in_every_row(spark):
    """All rows are peers: every chunk continues the same run."""
    df = spark.range(200).select("id", F.lit("x").alias("g"), F.lit(7).alias("o"), F.col("id").alias("v"))
    got = window_columns(df, "g", "o", "v", tie_break=["id"], split=True)
    summary = got.agg(F.max("rank"), F.max("dense_rank"), F.count_distinct("row_num"), F.max("row_num")).first()
    assert tuple(summary) == (1, 1, 200, 200)


def test_copies_of_a_row_spread_over_chunks(spark):
    df = spark.range(0, 400, numPartitions=8).select(F.lit("x").alias("g"), F.lit(1).alias("o"), F.lit(2).alias("v"))
    got = window_columns(df, "g", "o", "v", split=True)
    row = got.agg(F.count_distinct("row_num"), F.max("running_total"), F.min("running_total")).first()
    assert tuple(row) == (400, 800, 2)


def jobs_of(spark, call):
    tracker, group = spark.sparkContext.statusTracker(), f"windows-{id(call)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        return call(), len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_plans(spark):
    """The default is safe for any group and runs the one write; the plain form runs nothing."""
    df = spark.createDataFrame(random_rows(2, 100, 4), SCHEMA)
    plain, none = jobs_of(spark, lambda: window_columns(df, "g", "o", "v", tie_break=["id"], split=False))
    split, some = jobs_of(spark, lambda: window_columns(df, "g", "o", "v", tie_break=["id"]))
    assert none == 0 and 1 <= some <= 3  # the sample of the range shuffle, the shuffle, the write
    assert "__chunk" not in plain._jdf.queryExecution().toString()
    assert "__chunk" in split._jdf.queryExecution().toString()
    assert result(plain) == result(split)


def test_table_goes_with_the_context(spark):
    df = spark.createDataFrame(random_rows(3, 100, 4), SCHEMA)
    with Tables(spark) as tables:
        got = window_columns(df, "g", "o", "v", tie_break=["id"], tables=tables)
        assert got.count() == 100
        assert len(spark.catalog.listTables(tables.database)) == 1
    assert not spark.catalog.databaseExists(tables.database)


def test_carried_values_are_few(spark):
    df = spark.range(300).selectExpr("id", "'x' AS g", "id AS o", "id AS v").repartition(6)
    spec = _Spec(["g"], "o", ["id"], "v", 20, 7)
    rows = df.repartitionByRange(8, "o").withColumn("__chunk", F.spark_partition_id()).withColumn("__group", F.struct("g"))
    sizes = _chunk_carry(rows, spec).select(F.max(F.size("__carry.tail_before")), F.max(F.size("__carry.head_after"))).first()
    assert tuple(sizes) == (20, 7)


def test_column_names_of_the_table_do_not_matter(spark):
    df = spark.range(30).selectExpr("id", "'x' AS rows", "id % 3 AS continues", "id AS position")
    got = window_columns(df, "rows", "continues", "position", tie_break=["id"], split=True)
    assert got.count() == 30
    with pytest.raises(ValueError, match="already present"):
        window_columns(df.withColumn("rank", F.lit(1)), "rows", "continues", "position")


def test_order_column_as_value(spark):
    """Not-a-number is the largest order value, and minus zero equals zero."""
    numbers = [float("nan"), float("nan"), 2.5, 0.0, -0.0, -1.0, None]
    rows = [(i, numbers[i % 7]) for i in range(70)]
    df = spark.createDataFrame(rows, "id int, x double").withColumn("g", F.lit(None).cast("string"))
    columns = ["id", "row_num", "rank", "dense_rank"]
    plain, split = (
        {tuple(r) for r in window_columns(df, "g", "x", "x", tie_break=["id"], split=s).select(*columns).collect()}
        for s in (False, True)
    )
    assert plain == split
    assert {r[2:] for r in split} == {(1, 1), (21, 2), (31, 3), (51, 4), (61, 5)}


def test_offsets_must_be_positive(spark):
    with pytest.raises(ValueError, match="at least 1"):
        window_columns(spark.range(3), "id", "id", "id", lag=0)


def test_plain_plan_has_one_shuffle(spark):
    df = spark.range(100).selectExpr("id", "id % 3 AS g", "id % 7 AS o", "id AS v")
    plan = window_columns(df, "g", "o", "v", tie_break=["id"], split=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("+- Sort ") + plan.count("Sort [") >= 2


def test_measured_groups(spark, monkeypatch):
    """Groups beyond the limit of one task are split, smaller ones are not."""
    df = spark.createDataFrame(random_rows(5, 200, 3), SCHEMA)
    results = []
    for limit in (20, 200):
        monkeypatch.setattr(windows, "PLAIN_ROWS", limit)
        found = window_columns(df, "g", "o", "v", tie_break=["id"], split=None)
        assert ("__chunk" in found._jdf.queryExecution().toString()) == (limit == 20)
        results.append(result(found))
    assert results[0] == results[1]


def test_split_plan_shuffles_no_stored_row(spark):
    """Stored chunks are read without a shuffle of their rows: only sums and edges of chunks move."""
    df = spark.range(3000).selectExpr("id", "id % 2 AS g", "id % 97 AS o", "CAST(id AS DECIMAL(12,2)) AS v").repartition(6)
    plan = window_columns(df, "g", "o", "v", tie_break=["id"])._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert all("__chunk" not in line for line in moved)
    assert "rangepartitioning" not in plan
