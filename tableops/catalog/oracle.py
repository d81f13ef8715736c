"""The registered queries in DuckDB SQL over the same tables."""

from __future__ import annotations

from tableops.catalog import keyed, streams, timed

_RAW = """
raw_sales AS (
  SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS order_id,
         CAST(o_orderdate AS DATE) AS order_date,
         r_name AS region,
         o_custkey AS customer_id,
         p_brand AS product,
         CAST(l_quantity AS INTEGER) AS quantity,
         CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
         CAST(3 * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(4,2)) AS discount,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Credit Card' WHEN '2-HIGH' THEN 'Debit Card'
           WHEN '3-MEDIUM' THEN 'Digital Wallet' WHEN '4-NOT SPECIFIED' THEN 'Cash' ELSE 'Bank Transfer' END
           AS payment_method,
         CAST(18 + c_custkey % 53 AS INTEGER) AS customer_age
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""

_PRICED = "CAST(round(quantity * unit_price * (1 - discount), 2) AS DECIMAL(14,2))"

_SALES = f"""{_RAW},
sales AS (
  SELECT *, {_PRICED} AS revenue,
         CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month
  FROM raw_sales
)"""

_GAPPY = """
gappy AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
         CASE WHEN l_linenumber <> 7 THEN l_discount END AS l_discount,
         CASE WHEN l_linenumber <> 6 THEN l_linenumber END AS l_line,
         CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS l_returnflag
  FROM lineitem
)"""

_DISCOUNT_LEVEL = (
    "CASE WHEN discount = 0 THEN 'None' WHEN discount <= 0.10 THEN 'Low' "
    "WHEN discount <= 0.25 THEN 'Medium' ELSE 'High' END"
)
_TIER = (
    "CASE WHEN revenue >= 10000 THEN 'Platinum' WHEN revenue >= 5000 THEN 'Gold' "
    "WHEN revenue >= 1000 THEN 'Silver' ELSE 'Bronze' END"
)
_AGE = (
    "CASE WHEN customer_age < 25 THEN '18-24' WHEN customer_age < 35 THEN '25-34' "
    "WHEN customer_age < 45 THEN '35-44' WHEN customer_age < 55 THEN '45-54' ELSE '55+' END"
)
_FLAG = "CASE WHEN payment_method IN ('Credit Card', 'Digital Wallet') THEN 1 ELSE 0 END"
_MARGIN = (
    "CASE WHEN unit_price > 0 THEN round(CAST(revenue AS DOUBLE) / CAST(quantity * unit_price AS DOUBLE), 4) ELSE 0 END"
)


def _mean(total: str, count: str) -> str:
    """Mean of money in decimal arithmetic, half up to 6 places and then to 2; a mean of doubles may miss a tie."""
    cents = f"CAST({total} * 100 AS HUGEINT)"
    return f"CAST(((2 * {cents} * 10000 + {count}) // (2 * {count}) + 5000) // 10000 AS DOUBLE) / 100"


def _with_raw(select: str) -> str:
    return f"WITH {_RAW}\n{select}"


def _with_sales(select: str) -> str:
    return f"WITH {_SALES}\n{select}"


def _with_gappy(select: str) -> str:
    return f"WITH {_GAPPY}\n{select}"


_ORDER_FIELDS = "o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice, o_orderpriority"
_ORDER_RECORDS = f"SELECT {_ORDER_FIELDS} FROM orders"

_EVENT_RECORDS = "SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM events"

_RANKED = "PARTITION BY region ORDER BY order_date DESC NULLS LAST, order_id, product, revenue"
_BY_VALUE = "PARTITION BY region ORDER BY order_date DESC NULLS LAST"
_RISING = (
    "PARTITION BY region ORDER BY order_date, order_id DESC, product DESC, revenue DESC "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
)
_WINDOWS = {
    "row_num": f"row_number() OVER ({_RANKED})",
    "rank": f"rank() OVER ({_BY_VALUE})",
    "dense_rank": f"dense_rank() OVER ({_BY_VALUE})",
    "lag_revenue": f"CAST(lag(revenue, 1) OVER ({_RANKED}) AS DOUBLE)",
    "lead_revenue": f"CAST(lead(revenue, 1) OVER ({_RANKED}) AS DOUBLE)",
    "running_total": f"CAST(sum(revenue) OVER ({_RISING}) AS DOUBLE)",
}


def _window(expressions: dict[str, str], *names: str) -> str:
    added = ", ".join(f"{expressions[n]} AS {n}" for n in names)
    return _with_sales(
        f"SELECT region, order_date, order_id, product, CAST(revenue AS DOUBLE) AS revenue, {added} FROM sales"
    )


def _metric(name: str, column: str, result: str) -> str:
    return _with_sales(f"SELECT region, product, {result} AS {name}_{column} FROM sales GROUP BY region, product")


_EVENTS = "(SELECT user_id AS c_custkey, event_id, event_type, value FROM events) e"
_CUSTOMERS = "(SELECT c_custkey, c_name, c_mktsegment FROM customer) c"


def _join_events(how: str, where: str = "") -> str:
    return (
        "SELECT coalesce(c.c_custkey, e.c_custkey) AS c_custkey, c_name, c_mktsegment, event_id, event_type, value "
        f"FROM {_CUSTOMERS} {how} JOIN {_EVENTS} ON c.c_custkey = e.c_custkey {where}"
    )


def _summary(column: str, digits: bool) -> str:
    value = f"CAST({column} AS DOUBLE)" if digits else column
    return (
        f"round(avg({column}), 4) AS mean_{column}, round(stddev_samp(CAST({column} AS DOUBLE)), 4) AS stddev_{column}, "
        f"min({value}) AS min_{column}, max({value}) AS max_{column}"
    )


_MONTHLY = """monthly AS (
  SELECT region, order_year, order_month, sum(revenue) AS monthly_revenue
  FROM sales GROUP BY region, order_year, order_month
)"""
_ROLLING = f"""WITH {_SALES},
{_MONTHLY}
SELECT region, order_year, order_month, CAST(monthly_revenue AS DOUBLE) AS monthly_revenue,
       {_mean('sum(monthly_revenue) OVER w', 'count(*) OVER w')} AS rolling_3m_avg_revenue
FROM monthly
WINDOW w AS (PARTITION BY region ORDER BY order_year, order_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""

_TRANSFORMED = f"""WITH {_RAW},
priced AS (
  SELECT *, {_PRICED} AS revenue,
         row_number() OVER (PARTITION BY order_id ORDER BY order_date, region, customer_id, product, quantity,
                            unit_price, discount, payment_method, customer_age) AS copy
  FROM raw_sales WHERE quantity > 0 AND unit_price > 0
),
transformed AS (
  SELECT order_id, order_date, upper(trim(region)) AS region, customer_id, upper(trim(product)) AS product, quantity,
         unit_price, discount, upper(trim(payment_method)) AS payment_method, customer_age, revenue,
         {_MARGIN} AS profit_margin, CAST(year(order_date) AS INTEGER) AS order_year,
         CAST(month(order_date) AS INTEGER) AS order_month, CAST(quarter(order_date) AS INTEGER) AS order_quarter,
         {_AGE} AS age_bucket, {_TIER} AS sales_tier, {_FLAG} AS payment_flag, {_DISCOUNT_LEVEL} AS discount_level
  FROM priced WHERE copy = 1
)"""

_RANKED_ORDERS = "PARTITION BY region ORDER BY order_date DESC, order_id, revenue"
_RISING_ORDERS = (
    "PARTITION BY region ORDER BY order_date, order_id DESC, revenue DESC "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
)

_DOUBLE_MONEY = (
    "* REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount AS DOUBLE) AS discount, "
    "CAST(revenue AS DOUBLE) AS revenue)"
)

_BROKEN = "o_orderpriority = '5-LOW'"

ORACLE_SQL: dict[str, str] = {
    "scan_csv": _ORDER_RECORDS,
    "scan_csv_inferred": _ORDER_RECORDS,
    "scan_csv_mode": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN NOT {_BROKEN} THEN CAST(o_orderdate AS DATE) END AS o_orderdate,
       CASE WHEN NOT {_BROKEN} THEN o_totalprice END AS o_totalprice,
       CASE WHEN NOT {_BROKEN} THEN o_orderpriority END AS o_orderpriority,
       CAST({_BROKEN} AS INTEGER) AS is_corrupt
FROM orders""",
    "scan_csv_dropmalformed": f"{_ORDER_RECORDS} WHERE NOT {_BROKEN}",
    "scan_csv_timestamps": _EVENT_RECORDS,
    "scan_json": _EVENT_RECORDS,
    "scan_json_inferred": _EVENT_RECORDS,
    "scan_json_multiline": _EVENT_RECORDS,
    "scan_json_permissive": """
SELECT event_id, date_trunc('second', ts) AS ts, user_id, event_type, value, props, NULL AS corrupt
FROM events WHERE event_type <> 'error'
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL,
       substr('{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '"', 1, 30)
FROM events WHERE event_type = 'error'""",
    "scan_json_dropmalformed": f"{_EVENT_RECORDS} WHERE event_type <> 'error'",
    "scan_files": "SELECT * FROM part",
    "scan_dispatch": "SELECT * FROM supplier",
    "scan_incremental": """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
WHERE o_orderdate > TIMESTAMP '1999-06-15 00:00:00'""",
    "validate_columns": "SELECT *, 1 AS names_what_lacks FROM customer",
    "validate_row_count": "SELECT o_orderstatus, count(o_orderkey) AS count_o_orderkey FROM orders GROUP BY o_orderstatus",
    "null_ratio_profile": _with_gappy(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_nulls, count(*) AS n_rows, "
            f"round((count(*) - count({c})) / count(*), 6) AS null_ratio FROM gappy"
            for c in ("l_orderkey", "l_discount", "l_line", "l_returnflag")
        )
    ),
    "readback_validate": f"""
SELECT {_ORDER_FIELDS}, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders WHERE year(o_orderdate) = 1996""",
    "filter_expr": "SELECT * FROM lineitem WHERE l_quantity > 45 AND l_discount >= 0.05 AND l_returnflag = 'R'",
    "select_rename": "SELECT c_custkey AS id, c_name AS customer, c_mktsegment AS segment FROM customer",
    "cast_columns": """
SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity,
       TRY_CAST(l_returnflag AS DOUBLE) AS l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate,
       CASE l_linenumber WHEN 2 THEN 2 WHEN 3 THEN 12 WHEN 4 THEN -3 WHEN 6 THEN 6 WHEN 7 THEN 7 END AS l_text
FROM lineitem""",
    "nulls_drop": _with_gappy("SELECT * FROM gappy WHERE l_discount IS NOT NULL AND l_returnflag IS NOT NULL"),
    "nulls_fill": _with_gappy(
        "SELECT * REPLACE (coalesce(l_discount, 0.5) AS l_discount, coalesce(l_returnflag, 'none') AS l_returnflag) FROM gappy"
    ),
    "nulls_fill_default": _with_gappy(
        "SELECT * REPLACE (coalesce(l_discount, 0) AS l_discount, coalesce(l_line, 0) AS l_line, "
        "coalesce(l_returnflag, 'UNKNOWN') AS l_returnflag) FROM gappy"
    ),
    "derive_revenue": _with_raw(
        "SELECT order_id, product, quantity, CAST(unit_price AS DOUBLE) AS unit_price, "
        f"CAST(discount AS DOUBLE) AS discount, CAST({_PRICED} AS DOUBLE) AS revenue FROM raw_sales"
    ),
    "derive_profit_margin": _with_sales(
        f"SELECT order_id, product, CAST(revenue AS DOUBLE) AS revenue, {_MARGIN} AS profit_margin FROM sales"
    ),
    "derive_date_parts": _with_sales(
        "SELECT order_id, product, order_date, order_year, order_month, "
        "CAST(quarter(order_date) AS INTEGER) AS order_quarter FROM sales"
    ),
    "bucket_age": _with_raw(
        f"SELECT {_AGE} AS age_bucket, count(order_id) AS n, min(customer_age) AS youngest, "
        "max(customer_age) AS oldest FROM raw_sales GROUP BY 1"
    ),
    "add_ingestion_ts": """
SELECT o_orderstatus, count(*) AS n_stamped, CAST(1 AS BIGINT) AS n_moments FROM orders GROUP BY o_orderstatus""",
    "tier_revenue": _with_sales(
        f"SELECT order_id, product, CAST(revenue AS DOUBLE) AS revenue, {_TIER} AS sales_tier FROM sales"
    ),
    "flag_payment": _with_sales(
        f"SELECT payment_method, {_FLAG} AS payment_flag, count(order_id) AS n FROM sales GROUP BY 1, 2"
    ),
    "level_discount": _with_sales(
        f"SELECT order_id, product, CAST(discount AS DOUBLE) AS discount, {_DISCOUNT_LEVEL} AS discount_level FROM sales"
    ),
    "standardise_strings": "SELECT p_partkey, upper(trim(p_name)) AS p_name, upper(trim(p_type)) AS p_type FROM part",
    "dedup_rows": "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem",
    "dedup_keys": _with_sales("""
SELECT order_id, product, CAST(revenue AS DOUBLE) AS revenue, quantity, payment_method
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY revenue DESC, product, quantity, payment_method) AS copy
      FROM sales)
WHERE copy = 1"""),
    "dedup_keys_any": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "group_aggregate": _with_sales("""
SELECT region, payment_method, CAST(sum(revenue) AS DOUBLE) AS sum_revenue, CAST(max(revenue) AS DOUBLE) AS max_revenue,
       CAST(sum(quantity) AS BIGINT) AS sum_quantity, min(quantity) AS min_quantity, count(order_id) AS count_order_id
FROM sales GROUP BY region, payment_method"""),
    "agg_sum": _metric("sum", "revenue", "CAST(sum(revenue) AS DOUBLE)"),
    "agg_avg": _metric("avg", "quantity", "round(avg(quantity), 4)"),
    "agg_mean": _metric("mean", "quantity", "round(avg(quantity), 4)"),
    "agg_max": _metric("max", "revenue", "CAST(max(revenue) AS DOUBLE)"),
    "agg_min": _metric("min", "revenue", "CAST(min(revenue) AS DOUBLE)"),
    "agg_count": _with_gappy("SELECT l_linenumber, count(l_discount) AS count_l_discount FROM gappy GROUP BY l_linenumber"),
    "agg_stddev": _metric("stddev", "quantity", "round(stddev_samp(quantity), 4)"),
    "stats_summary": _with_sales(
        f"SELECT {_summary('quantity', False)}, {_summary('customer_age', False)}, {_summary('revenue', True)} FROM sales"
    ),
    "stats_percentiles": _with_sales(
        "SELECT "
        + ", ".join(
            f"CAST(quantile_disc({c}, 0.{p}) AS {kind}) AS p{p}_{c}"
            for c, kind in (("revenue", "DOUBLE"), ("quantity", "INTEGER"))
            for p in (25, 50, 75, 95)
        )
        + " FROM sales"
    ),
    "stats_percentiles_bound": "SELECT count(l_extendedprice) AS n, "
    + ", ".join(f"1 AS p{p}_price_within" for p in (10, 25, 50, 75, 95))
    + " FROM lineitem",
    "stats_skip_missing": _with_sales(f"SELECT {_summary('quantity', False)} FROM sales"),
    "sales_summary": _with_sales(f"""
SELECT region, product, CAST(sum(revenue) AS DOUBLE) AS total_revenue, count(order_id) AS total_orders,
       {_mean('sum(revenue)', 'count(*)')} AS avg_order_value, CAST(max(revenue) AS DOUBLE) AS max_revenue,
       count(DISTINCT customer_id) AS unique_customers
FROM sales GROUP BY region, product"""),
    "agg_count_distinct": _with_sales(
        "SELECT region, product, count(DISTINCT customer_id) AS unique_customers FROM sales GROUP BY region, product"
    ),
    "group_monthly_region": _with_sales(f"""
SELECT region, order_year, order_month, CAST(sum(revenue) AS DOUBLE) AS sum_revenue,
       {_mean('sum(revenue)', 'count(*)')} AS avg_revenue, CAST(max(revenue) AS DOUBLE) AS max_revenue,
       CAST(sum(quantity) AS BIGINT) AS sum_quantity, count(order_id) AS count_order_id
FROM sales GROUP BY region, order_year, order_month"""),
    "win_row_number": _window(_WINDOWS, "row_num"),
    "win_rank": _window(_WINDOWS, "rank"),
    "win_dense_rank": _window(_WINDOWS, "dense_rank"),
    "win_lag": _window(_WINDOWS, "lag_revenue"),
    "win_lead": _window(_WINDOWS, "lead_revenue"),
    "win_running_total": _window(_WINDOWS, "running_total"),
    "win_all": _window(_WINDOWS, *_WINDOWS),
    "win_all_split": _window(_WINDOWS, *_WINDOWS),
    "win_offsets_split": _window(
        {
            "lag_revenue": f"CAST(lag(revenue, 3) OVER ({_RANKED}) AS DOUBLE)",
            "lead_revenue": f"CAST(lead(revenue, 2) OVER ({_RANKED}) AS DOUBLE)",
        },
        "lag_revenue",
        "lead_revenue",
    ),
    "win_rolling_avg": _ROLLING,
    "win_rank_over_agg": _with_sales("""
SELECT region, customer_id, CAST(sum(quantity) AS BIGINT) AS units,
       dense_rank() OVER (PARTITION BY region ORDER BY sum(quantity) DESC) AS dense_rank
FROM sales GROUP BY region, customer_id"""),
    "join_inner": _join_events("INNER"),
    "join_left": _join_events("LEFT"),
    "join_right": _join_events("LEFT"),
    "join_full": """
SELECT coalesce(l.doc_id, e.vec_id) AS doc_id, quality, toxic, label
FROM labels l FULL JOIN embeddings e ON l.doc_id = e.vec_id""",
    "join_where": _join_events(
        "LEFT", "WHERE c_mktsegment = 'BUILDING' AND (event_type IS NULL OR event_type = 'purchase')"
    ),
    "join_broadcast": """
SELECT c_nationkey, c_custkey, c_acctbal, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "join_select": "SELECT c_custkey AS customer, upper(c_name) AS name, value FROM customer JOIN events ON c_custkey = user_id",
    "join_full_native": """
SELECT coalesce(l.doc_id, e.vec_id) AS doc_id, quality, toxic, label
FROM labels l FULL JOIN embeddings e ON l.doc_id = e.vec_id""",
    "join_salted": """
SELECT event_type, event_id, value, n_of_type
FROM events JOIN (SELECT event_type, count(*) AS n_of_type FROM events GROUP BY event_type) USING (event_type)""",
    "join_salted_full": _join_events("FULL"),
    "sort_desc": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC",
    "sort_multi": "SELECT c_custkey, c_mktsegment, c_nationkey FROM customer ORDER BY c_mktsegment, c_nationkey, c_custkey",
    "topk_per_group": _with_sales("""
SELECT region, order_id, product, CAST(revenue AS DOUBLE) AS revenue, rank
FROM (SELECT *, dense_rank() OVER (PARTITION BY region ORDER BY revenue DESC) AS rank FROM sales)
WHERE rank <= 5"""),
    "limit_preview": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "sql_register": """
SELECT c_mktsegment, count(o_orderkey) AS n_orders, count(DISTINCT o_custkey) AS n_buyers
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
    "sql_drop": "SELECT c_mktsegment, count(*) AS n, 1 AS dropped, 0 AS dropped_again FROM customer GROUP BY c_mktsegment",
    "sql_drop_all": """
SELECT count(*) AS n, 0 AS views_left FROM customer UNION ALL SELECT count(*), 0 FROM customer""",
    "sql_raw": """
SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS highest FROM orders GROUP BY o_orderpriority""",
    "report_top_products": _with_sales("""
SELECT region, product, CAST(product_revenue AS DOUBLE) AS product_revenue, product_orders,
       CAST(total_revenue AS DOUBLE) AS total_revenue,
       round(product_revenue / nullif(total_revenue, 0) * 100, 2) AS revenue_share_pct, product_rank
FROM (
  SELECT s.region, s.product, sum(s.revenue) AS product_revenue, count(s.order_id) AS product_orders, t.total_revenue,
         dense_rank() OVER (PARTITION BY s.region ORDER BY sum(s.revenue) DESC) AS product_rank
  FROM sales s JOIN (SELECT region, sum(revenue) AS total_revenue FROM sales GROUP BY region) t ON s.region = t.region
  GROUP BY s.region, s.product, t.total_revenue
)
WHERE product_rank <= 5"""),
    "report_high_value_customers": _with_sales(f"""
SELECT customer_id, CAST(sum(revenue) AS DOUBLE) AS total_spend, count(order_id) AS num_orders,
       (SELECT {_mean('sum(revenue)', 'count(*)')} FROM sales) AS avg_order_overall
FROM sales GROUP BY customer_id HAVING sum(revenue) > (SELECT avg(revenue) FROM sales)"""),
    "report_high_value_customers_times": _with_sales(f"""
SELECT customer_id, CAST(sum(revenue) AS DOUBLE) AS total_spend, count(order_id) AS num_orders,
       (SELECT {_mean('sum(revenue)', 'count(*)')} FROM sales) AS avg_order_overall
FROM sales GROUP BY customer_id HAVING sum(revenue) > 40 * (SELECT avg(revenue) FROM sales)"""),
    "scalar_subquery": """
SELECT o_orderkey, o_totalprice FROM orders
WHERE CAST(o_totalprice AS DECIMAL(14,2)) > (SELECT avg(CAST(o_totalprice AS DECIMAL(14,2))) FROM orders)""",
    "having_filter": _with_sales("""
SELECT customer_id, CAST(sum(quantity) AS BIGINT) AS sum_quantity FROM sales
GROUP BY customer_id HAVING sum(quantity) > 1200"""),
    "report_rolling_revenue": _ROLLING,
    "layout_repartition": "SELECT CAST(16 AS BIGINT) AS n_partitions, count(*) AS n_rows, 1 AS is_even FROM orders",
    "layout_cache": """
SELECT c_mktsegment AS name, count(*) AS n, 1 AS on_disk, 0 AS in_memory FROM customer GROUP BY c_mktsegment""",
    "layout_unpersist": """
SELECT c_mktsegment AS name, count(*) AS n, 0 AS on_disk, 0 AS in_memory FROM customer GROUP BY c_mktsegment""",
    # The partition of eight to which Spark's hash deals each line number; the others stay empty.
    "partition_skew_profile": """
WITH sizes AS (
  SELECT CASE l_linenumber WHEN 1 THEN 3 WHEN 2 THEN 6 WHEN 3 THEN 3 WHEN 4 THEN 6 WHEN 5 THEN 2 WHEN 6 THEN 1 ELSE 3 END
           AS part, count(*) AS n
  FROM lineitem GROUP BY part
)
SELECT CAST(8 AS BIGINT) AS n_partitions, CAST(sum(n) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS min_rows, max(n) AS max_rows,
       round(max(n) / (sum(n) / 8), 6) AS skew
FROM sizes""",
    "key_skew_profile": """
SELECT user_id, count(*) AS n_rows, round(count(*) / (SELECT count(*) FROM events), 6) AS share
FROM events GROUP BY user_id ORDER BY n_rows DESC, user_id LIMIT 20""",
    "write_parquet": "SELECT * FROM customer",
    "write_partitioned": f"""
SELECT {_ORDER_FIELDS}, CAST(year(o_orderdate) AS INTEGER) AS o_year, CAST(month(o_orderdate) AS INTEGER) AS o_month
FROM orders""",
    "write_dynamic_overwrite": """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate,
       CASE WHEN year(o_orderdate) >= 1998 THEN 0.0::DOUBLE ELSE o_totalprice END AS o_totalprice, o_orderpriority,
       CAST(year(o_orderdate) AS INTEGER) AS o_year, CAST(month(o_orderdate) AS INTEGER) AS o_month
FROM orders""",
    "list_partitions": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, CAST(month(o_orderdate) AS INTEGER) AS o_month,
       count(*) AS n_rows, 1 AS has_files
FROM orders GROUP BY 1, 2""",
    "sales_transform": f"""{_TRANSFORMED}
SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount AS DOUBLE) AS discount,
                  CAST(revenue AS DOUBLE) AS revenue)
FROM transformed""",
    "sales_pipeline": f"""{_TRANSFORMED}
SELECT region, order_year, order_month, CAST(sum(revenue) AS DOUBLE) AS sum_revenue,
       {_mean('sum(revenue)', 'count(*)')} AS avg_revenue, CAST(max(revenue) AS DOUBLE) AS max_revenue,
       CAST(sum(quantity) AS BIGINT) AS sum_quantity, count(order_id) AS count_order_id
FROM transformed GROUP BY region, order_year, order_month""",
    "sales_pipeline_windowed": f"""{_TRANSFORMED}
SELECT {_DOUBLE_MONEY},
       row_number() OVER ({_RANKED_ORDERS}) AS row_num,
       rank() OVER (PARTITION BY region ORDER BY order_date DESC) AS rank,
       dense_rank() OVER (PARTITION BY region ORDER BY order_date DESC) AS dense_rank,
       CAST(lag(revenue, 1) OVER ({_RANKED_ORDERS}) AS DOUBLE) AS lag_revenue,
       CAST(lead(revenue, 1) OVER ({_RANKED_ORDERS}) AS DOUBLE) AS lead_revenue,
       CAST(sum(revenue) OVER ({_RISING_ORDERS}) AS DOUBLE) AS running_total
FROM transformed""",
    "sales_pipeline_transformed": f"{_TRANSFORMED}\nSELECT {_DOUBLE_MONEY} FROM transformed",
    "sales_pipeline_top_products": f"""{_TRANSFORMED},
totals AS (SELECT region, sum(revenue) AS total_revenue FROM transformed GROUP BY region)
SELECT region, product, CAST(product_revenue AS DOUBLE) AS product_revenue, product_orders,
       CAST(total_revenue AS DOUBLE) AS total_revenue,
       round(product_revenue / nullif(total_revenue, 0) * 100, 2) AS revenue_share_pct, product_rank
FROM (
  SELECT region, product, sum(revenue) AS product_revenue, count(order_id) AS product_orders,
         dense_rank() OVER (PARTITION BY region ORDER BY sum(revenue) DESC) AS product_rank
  FROM transformed GROUP BY region, product
) JOIN totals USING (region)
WHERE product_rank <= 5""",
    "sales_pipeline_high_value_customers": f"""{_TRANSFORMED}
SELECT customer_id, CAST(sum(revenue) AS DOUBLE) AS total_spend, count(order_id) AS num_orders,
       (SELECT {_mean('sum(revenue)', 'count(*)')} FROM transformed) AS avg_order_overall
FROM transformed GROUP BY customer_id HAVING sum(revenue) > (SELECT avg(revenue) FROM transformed)""",
    "sales_pipeline_rolling_revenue": f"""{_TRANSFORMED},
monthly AS (
  SELECT region, order_year, order_month, sum(revenue) AS monthly_revenue
  FROM transformed GROUP BY region, order_year, order_month
)
SELECT region, order_year, order_month, CAST(monthly_revenue AS DOUBLE) AS monthly_revenue,
       {_mean('sum(monthly_revenue) OVER w', 'count(*) OVER w')} AS rolling_3m_avg_revenue
FROM monthly
WINDOW w AS (PARTITION BY region ORDER BY order_year, order_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "sales_pipeline_stats": f"""{_TRANSFORMED}
SELECT {_summary('revenue', True)}, {_summary('quantity', False)}, {_summary('unit_price', True)}, 1 AS percentiles_in_order
FROM transformed""",
}

ORACLE_SQL |= {name: sql if isinstance(sql, str) else _with_sales(sql[1]) for name, sql in timed.ORACLE_SQL.items()}
ORACLE_SQL |= streams.ORACLE_SQL | keyed.ORACLE_SQL
