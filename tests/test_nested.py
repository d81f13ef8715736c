"""JSON by path with bad texts defined; nesting and back again."""

import pytest

from tableops.operators.nested import extract_paths, json_schema, nest_rows, unnest_rows

TEXTS = [(1, '{"k": 5, "in": {"a": [1, 2]}}'), (2, '{"k": "x"}'), (3, "{bad"), (4, None), (5, ""), (6, "[1]"), (7, "null"), (8, '{"k": null}')]


def test_paths(spark):
    df = spark.createDataFrame(TEXTS, "id int, `a.b` string")
    got = extract_paths(df, "a.b", {"k": ("$.k", "int"), "text": ("$.k", "string"), "second": ("$.in.a[1]", "int")}, flag="bad")
    rows = {r["id"]: (r["k"], r["text"], r["second"], r["bad"]) for r in got.collect()}
    none = (None, None, None, False)
    assert rows[1] == (5, "5", 2, False) and rows[2] == (None, "x", None, False)
    assert rows[3] == rows[5] == (None, None, None, True)
    assert rows[4] == rows[6] == rows[7] == rows[8] == none
    with pytest.raises(ValueError):
        extract_paths(df, "a.b", {"id": ("$.k", "int")})


def test_schema(spark):
    df = spark.createDataFrame(TEXTS[:1] + TEXTS[2:4], "id int, t string")
    assert json_schema(df, "t") == "OBJECT<in: OBJECT<a: ARRAY<BIGINT>>, k: BIGINT>"
    assert json_schema(df.where("id = 3"), "t") == json_schema(df.limit(0), "t") == "VOID"


def test_round_trip_in_parts(spark):
    df = spark.range(2_500).selectExpr("id % 2 AS g", "id AS pos", "concat('v', id) AS v").union(spark.sql("SELECT 0L, NULL, 'loose'"))
    nested = nest_rows(df, ["g"], "pos", ["v"], "items", per_row=1_000)
    assert sorted((r["g"], r["part"], len(r["items"])) for r in nested.where("part IS NOT NULL").collect()) == [
        (g, p, n) for g in (0, 1) for p, n in ((0, 500), (1, 500), (2, 250))
    ]
    assert all([i["pos"] for i in r["items"]] == sorted(i["pos"] for i in r["items"]) for r in nested.where("part IS NOT NULL").collect())
    back = unnest_rows(nested, "items").drop("part")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    empty = spark.sql("SELECT 1 AS g, CAST(array() AS array<struct<a: int>>) AS items")
    assert unnest_rows(empty, "items").count() == 0 and tuple(unnest_rows(empty, "items", outer=True).first()) == (1, None)
    assert nest_rows(df.limit(0), ["g"], "pos", ["v"], "items").count() == 0
