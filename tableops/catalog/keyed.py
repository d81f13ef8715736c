"""Queries that look up or replace rows by key, compare snapshots, or read nested columns, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableops.catalog.tables import table
from tableops.operators.bloom import bloom_join
from tableops.operators.nested import extract_paths, nest_rows, unnest_rows
from tableops.plans.drift import key_overlap, quantile_drift, store_profile
from tableops.plans.upsert import KeyedTable, read_current, upsert
from tableops.scratch import scratch_path


def _returned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of orders with a returned line that had the highest discount."""
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' AND l_discount >= 0.1")
    return lines.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")


def _bloom(how: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return bloom_join(table(spark, sf_dir, "orders"), _returned(spark, sf_dir), "o_orderkey", how)

    return query


def q_upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by year and status, after those that wait are finished a year later and each customer's first one is copied."""
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    kept = KeyedTable(scratch_path(spark, "orders"), orders.schema, ("o_orderkey",), ("year", "o_orderstatus"))
    upsert(spark, kept, orders)
    later = orders.where("o_orderstatus = 'P'").withColumns({"o_orderstatus": F.lit("F"), "year": F.col("year") + 1})
    firsts = orders.groupBy("o_custkey").agg(F.min_by(F.struct(*orders.columns), "o_orderkey").alias("o")).select("o.*")
    copies = firsts.withColumns({"o_orderkey": -1 - F.col("o_orderkey"), "o_orderpriority": F.lit("copy")})
    upsert(spark, kept, later.unionByName(copies))
    return read_current(spark, kept)


def _half_years(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    """Profiles of the orders up to the middle of their time and of those after it, with the orders."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("day"))
    first, last = orders.agg(F.min("day"), F.max("day")).first()
    middle = first + (last - first) // 2
    parts = {"before": orders.where(F.col("day") <= middle), "after": orders.where(F.col("day") > middle)}
    path = scratch_path(spark, "profiles")
    for name, rows in parts.items():
        store_profile(rows, path, name, ["o_custkey"], ["o_totalprice"])
    return path, parts


def q_drift_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of both halves of the orders' time and of either."""
    path, _ = _half_years(spark, sf_dir)
    return key_overlap(spark, path, "before", "after", ["o_custkey"])


def q_drift_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the shift of the prices' quantiles between the halves is within 1 % of the rows of the exact one."""
    path, parts = _half_years(spark, sf_dir)
    found = quantile_drift(spark, path, "before", "after", ["o_totalprice"]).collect()  # one row per share
    exact = [F.count_if(F.col("o_totalprice") <= r["value_after"]) / F.count("o_totalprice") for r in found]
    near = [
        F.struct(F.lit(r["share"]).alias("share"), (F.abs(x - F.lit(r["rank_before"])) <= 0.01).alias("near"))
        for r, x in zip(found, exact)
    ]
    return parts["before"].agg(F.array(*near).alias("shares")).select(F.inline("shares"))


def q_json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a number out of their properties; every seventh event's properties are cut short and so no JSON."""
    cut = F.when(F.col("event_id") % 7 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    events = table(spark, sf_dir, "events").select("event_id", cut.alias("props"))
    return extract_paths(events, "props", {"k": ("$.k", "int"), "other": ("$.other.x", "string")}, flag="bad")


def _nested_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nest_rows(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", ["role", "text"], "turns")


def q_nested_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of each conversation's array of turns."""
    letters = F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + F.coalesce(F.length(t["text"]), F.lit(0)))
    asked = F.size(F.filter("turns", lambda t: t["role"] == "user")).cast("long")
    return _nested_turns(spark, sf_dir).select(
        "conv_id", "part", F.size("turns").cast("long").alias("n_turns"), asked.alias("n_user"), letters.alias("n_chars")
    )


def q_nested_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unnest_rows(_nested_turns(spark, sf_dir), "turns").drop("part")


QUERIES = {
    "join_bloom_semi": _bloom("semi"),
    "join_bloom_anti": _bloom("anti"),
    "join_bloom_inner": _bloom("inner"),
    "upsert_orders": q_upsert_orders,
    "drift_keys": q_drift_keys,
    "drift_prices": q_drift_prices,
    "json_paths": q_json_paths,
    "nested_conversations": q_nested_conversations,
    "nested_round_trip": q_nested_round_trip,
}

_RETURNED = "SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_discount >= 0.1"
ORACLE_SQL = {
    "join_bloom_semi": f"SELECT * FROM orders WHERE o_orderkey IN ({_RETURNED})",
    "join_bloom_anti": f"SELECT * FROM orders WHERE o_orderkey NOT IN ({_RETURNED})",
    "join_bloom_inner": """
SELECT orders.*, l_linenumber, l_quantity
FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND l_discount >= 0.1""",
    "upsert_orders": """
WITH o AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
SELECT * REPLACE (CASE o_orderstatus WHEN 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
                  CAST(CASE o_orderstatus WHEN 'P' THEN year + 1 ELSE year END AS INTEGER) AS year) FROM o
UNION ALL
SELECT * REPLACE (-1 - o_orderkey AS o_orderkey, 'copy' AS o_orderpriority) FROM o
WHERE o_orderkey IN (SELECT min(o_orderkey) FROM orders GROUP BY o_custkey)""",
    "drift_keys": """
WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders),
h AS (SELECT min(day) + CAST((max(day) - min(day)) // 2 AS INTEGER) AS middle FROM o),
c AS (SELECT o_custkey, bool_or(day <= middle) AS old, bool_or(day > middle) AS new FROM o, h GROUP BY o_custkey)
SELECT 'o_custkey' AS key, count(*) FILTER (old) AS before, count(*) FILTER (new) AS after, count(*) FILTER (old AND new) AS both,
       count(*) FILTER (NOT new) AS gone, count(*) FILTER (NOT old) AS fresh
FROM c WHERE o_custkey IS NOT NULL""",
    "drift_prices": "SELECT CAST(share AS DOUBLE) AS share, true AS near FROM (VALUES (0.05), (0.25), (0.5), (0.75), (0.95)) v(share)",
    "json_paths": """
WITH e AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END AS props FROM events)
SELECT *, CASE WHEN json_valid(props) THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
       CASE WHEN json_valid(props) THEN json_extract_string(props, '$.other.x') END AS other,
       props IS NOT NULL AND NOT json_valid(props) AS bad
FROM e""",
    "nested_conversations": """
SELECT conv_id, CAST(turn // 1000 AS BIGINT) AS part, count(*) AS n_turns, count(*) FILTER (role = 'user') AS n_user,
       CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS n_chars
FROM conversations GROUP BY ALL""",
    "nested_round_trip": "SELECT * FROM conversations",
}
