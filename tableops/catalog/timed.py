"""Queries over times and values in order, and over several groupings, with their SQL."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableops.catalog.tables import sales, table
from tableops.operators.asof import asof_join
from tableops.operators.frames import range_frame
from tableops.operators.intervals import interval_join
from tableops.operators.lattice import cube_sets, grouping_lattice, rollup_sets
from tableops.plans.upkeep import Kept, refresh_states, summarise
from tableops.scratch import scratch_path
from tableops.sinks import write_parquet

# --- as-of joins: each event with a purchase of the same user ----------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")


def _purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    return bought.select("user_id", F.col("ts").alias("bought_at"), F.col("event_id").alias("purchase"), F.col("value").alias("price"))


def _asof(**options):
    def query(spark, sf_dir):
        return asof_join(_events(spark, sf_dir), _purchases(spark, sf_dir), "user_id", "ts", "bought_at", tie_break=["purchase"], **options)

    return query


_PURCHASES = """
p AS (
  SELECT user_id, ts AS bought_at, max(event_id) AS purchase, max_by(value, event_id) AS price
  FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts
), e AS (SELECT event_id, user_id, ts, event_type FROM events)"""

# --- interval joins ------------------------------------------------------------------------------------------------


def q_interval_join(spark, sf_dir):
    """Purchases of any user during an outage, which lasts as many minutes as the error's value says."""
    errors = table(spark, sf_dir, "events").where("event_type = 'error'")
    minutes = F.make_dt_interval(mins=F.floor("value").cast("int"))
    outages = errors.select(F.col("event_id").alias("outage"), F.col("ts").alias("began"), (F.col("ts") + minutes).alias("ended"))
    bought = _purchases(spark, sf_dir).select("purchase", "bought_at")
    return interval_join(bought, outages, ("bought_at", "bought_at"), ("began", "ended"))


def _open_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order from its date to the last shipment of its lines, where that is not before it."""
    shipped = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("shipped"))
    orders = table(spark, sf_dir, "orders").join(shipped, "o_orderkey")
    return orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("opened"), F.col("shipped").cast("date").alias("closed"))


def q_interval_join_keys(spark, sf_dir):
    """Pairs of a customer's orders that were open at the same time."""
    orders = _open_orders(spark, sf_dir)
    pairs = interval_join(orders, orders, ("opened", "closed"), ("opened", "closed"), "o_custkey", closed=False)
    return pairs.where("o_orderkey < o_orderkey_right")


# --- frames of values --------------------------------------------------------------------------------------------


def q_range_frame(spark, sf_dir):
    """Sum, count and largest revenue of the customer's last 30 days, for each sale."""
    rows = sales(spark, sf_dir).select("customer_id", "order_id", "product", "order_date", "revenue")
    framed = range_frame(rows, "customer_id", "order_date", "revenue", timedelta(days=30), aggregates=["sum", "count", "max"])
    return framed.withColumns({c: F.col(c).cast("double") for c in ("revenue", "sum_revenue", "max_revenue")})


def q_range_frame_region(spark, sf_dir):
    """Average and least units around each sale, seven days before to three after, per region: five large groups."""
    rows = sales(spark, sf_dir).select("region", "order_id", "product", "order_date", "quantity")
    framed = range_frame(rows, "region", "order_date", "quantity", 7, 3, ["avg", "min"])
    return framed.withColumn("avg_quantity", F.round("avg_quantity", 6))


# --- groupings ---------------------------------------------------------------------------------------------------

_METRICS = {"revenue": ["sum", "max"], "quantity": ["sum", "avg", "count"]}


def _lattice(sets: list[list[str]]):
    def query(spark, sf_dir):
        found = grouping_lattice(sales(spark, sf_dir), sets, _METRICS, ["customer_id"])
        return found.withColumns({c: F.col(c).cast("double") for c in ("sum_revenue", "max_revenue")} | {"avg_quantity": F.round("avg_quantity", 6)})

    return query


_DIMENSIONS = ["region", "product", "order_month"]
_SETS = [["region", "product"], ["order_month"], ["payment_method", "region"], []]


def _lattice_sql(columns: list[str], grouping: str) -> tuple[str, str]:
    names = ", ".join(columns)
    return (
        "sales",
        f"""
SELECT {names}, CAST(grouping({names}) AS BIGINT) AS grouping_id, CAST(sum(revenue) AS DOUBLE) AS sum_revenue,
       CAST(max(revenue) AS DOUBLE) AS max_revenue, CAST(sum(quantity) AS BIGINT) AS sum_quantity,
       round(avg(quantity), 6) AS avg_quantity, count(quantity) AS count_quantity, count(DISTINCT customer_id) AS distinct_customer_id
FROM sales GROUP BY {grouping}""",
    )


# --- summaries kept up by directory ------------------------------------------------------------------------------

_KEPT = Kept(("order_year", "order_month"), ("region", "product"), ("revenue", "quantity"), ("quantity",), ("customer_id",))


def q_summary_upkeep(spark, sf_dir):
    """Sales by month; the months of one year are written anew with half their units, and only these are read again."""
    rows = sales(spark, sf_dir).select("order_year", "order_month", "region", "product", "customer_id", "quantity", "revenue")
    path, states = scratch_path(spark, "sales_by_month"), scratch_path(spark, "sales_states")
    write_parquet(rows, path, _KEPT.directories)
    first = refresh_states(spark, path, states, _KEPT)
    halved = rows.where("order_year = 1997").withColumn("quantity", F.floor(F.col("quantity") / 2).cast("int"))
    write_parquet(halved, path, _KEPT.directories)
    second = refresh_states(spark, path, states, _KEPT)
    found = summarise(spark, states, _KEPT, ["order_year", "region"], {"quantity": [0.5]})
    near = (F.col("p50_quantity") >= F.col("min_quantity")) & (F.col("p50_quantity") <= F.col("max_quantity"))
    money = [F.col(f"{m}_revenue").cast("double").alias(f"{m}_revenue") for m in ("sum", "max")]
    left = F.lit(second.same + second.changed - first.changed).cast("int").alias("months_more")
    return found.select("order_year", "region", "rows", *money, "sum_quantity", "max_quantity", near.cast("int").alias("median_within"), F.lit(second.changed).alias("months_again"), left)


QUERIES = {
    "asof_join": _asof(),
    "asof_join_forward": _asof(direction="forward", exact=False, tolerance=timedelta(days=1), how="inner"),
    "asof_join_nearest": _asof(direction="nearest"),
    "interval_join": q_interval_join,
    "interval_join_keys": q_interval_join_keys,
    "range_frame": q_range_frame,
    "range_frame_region": q_range_frame_region,
    "group_cube": _lattice(cube_sets(_DIMENSIONS)),
    "group_rollup": _lattice(rollup_sets(_DIMENSIONS)),
    "group_sets": _lattice(_SETS),
    "summary_upkeep": q_summary_upkeep,
}

# Statements over the tables, and those that need the sales records as "sales".
ORACLE_SQL: dict[str, str | tuple[str, str]] = {
    "asof_join": f"""
WITH {_PURCHASES}
SELECT e.*, bought_at, purchase, price FROM e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts >= p.bought_at""",
    "asof_join_forward": f"""
WITH {_PURCHASES}
SELECT e.*, bought_at, purchase, price FROM e ASOF JOIN p ON e.user_id = p.user_id AND e.ts < p.bought_at
WHERE bought_at <= ts + INTERVAL 1 DAY""",
    "asof_join_nearest": f"""
WITH {_PURCHASES},
b AS (SELECT e.*, bought_at, purchase, price FROM e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts >= p.bought_at),
f AS (SELECT e.event_id, bought_at, purchase, price FROM e ASOF LEFT JOIN p ON e.user_id = p.user_id AND e.ts <= p.bought_at),
d AS (
  SELECT event_id, f.bought_at IS NOT NULL AND (b.bought_at IS NULL OR f.bought_at - ts < ts - b.bought_at) AS ahead
  FROM b JOIN f USING (event_id)
)
SELECT b.event_id, b.user_id, b.ts, b.event_type, CASE WHEN ahead THEN f.bought_at ELSE b.bought_at END AS bought_at,
       CASE WHEN ahead THEN f.purchase ELSE b.purchase END AS purchase, CASE WHEN ahead THEN f.price ELSE b.price END AS price
FROM b JOIN f USING (event_id) JOIN d USING (event_id)""",
    "interval_join": """
SELECT p.event_id AS purchase, p.ts AS bought_at, o.event_id AS outage, o.ts AS began,
       o.ts + to_minutes(CAST(floor(o.value) AS BIGINT)) AS ended
FROM events p JOIN events o ON p.ts >= o.ts AND p.ts <= o.ts + to_minutes(CAST(floor(o.value) AS BIGINT))
WHERE p.event_type = 'purchase' AND o.event_type = 'error'""",
    "interval_join_keys": """
WITH shipped AS (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS closed FROM lineitem GROUP BY l_orderkey),
o AS (
  SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS opened, closed
  FROM orders JOIN shipped ON l_orderkey = o_orderkey WHERE CAST(o_orderdate AS DATE) <= closed
)
SELECT a.*, b.o_orderkey AS o_orderkey_right, b.opened AS opened_right, b.closed AS closed_right
FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND a.opened < b.closed AND b.opened < a.closed""",
    "range_frame": (
        "sales",
        """
SELECT customer_id, order_id, product, order_date, CAST(revenue AS DOUBLE) AS revenue,
       CAST(sum(revenue) OVER w AS DOUBLE) AS sum_revenue, count(revenue) OVER w AS count_revenue,
       CAST(max(revenue) OVER w AS DOUBLE) AS max_revenue
FROM sales
WINDOW w AS (PARTITION BY customer_id ORDER BY order_date RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND CURRENT ROW)""",
    ),
    "range_frame_region": (
        "sales",
        """
SELECT region, order_id, product, order_date, quantity, round(avg(quantity) OVER w, 6) AS avg_quantity,
       min(quantity) OVER w AS min_quantity
FROM sales
WINDOW w AS (PARTITION BY region ORDER BY order_date RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 3 DAYS FOLLOWING)""",
    ),
    "group_cube": _lattice_sql(_DIMENSIONS, "CUBE (region, product, order_month)"),
    "group_rollup": _lattice_sql(_DIMENSIONS, "ROLLUP (region, product, order_month)"),
    "group_sets": _lattice_sql(
        ["region", "product", "order_month", "payment_method"],
        "GROUPING SETS ((region, product), (order_month), (payment_method, region), ())",
    ),
    "summary_upkeep": (
        "sales",
        """
SELECT order_year, region, count(*) AS rows, CAST(sum(revenue) AS DOUBLE) AS sum_revenue, CAST(max(revenue) AS DOUBLE) AS max_revenue,
       CAST(sum(CASE WHEN order_year = 1997 THEN quantity // 2 ELSE quantity END) AS BIGINT) AS sum_quantity,
       CAST(max(CASE WHEN order_year = 1997 THEN quantity // 2 ELSE quantity END) AS INTEGER) AS max_quantity, 1 AS median_within,
       CAST((SELECT count(DISTINCT order_month) FROM sales WHERE order_year = 1997) AS INTEGER) AS months_again, 0 AS months_more
FROM sales GROUP BY order_year, region""",
    ),
}
