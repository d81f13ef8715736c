"""One query per operator. Each takes (spark, sf_dir), reads whole tables and returns a DataFrame.

Money is decimal while it is summed and becomes double in the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableops.catalog import keyed, streams, timed
from tableops.catalog.tables import raw_sales, sales, table
from tableops.operators import aggregates, dedup, joins, layout, ordering, quality, transforms, windows
from tableops.plans import pipeline, reports
from tableops.plans.views import Views, run_sql
from tableops.scratch import Tables, scratch_path, stored
from tableops.sinks import list_partitions, read_back, write_parquet
from tableops.sources import scan, scan_csv, scan_files, scan_incremental, scan_json

Query = Callable[[SparkSession, str], DataFrame]

TIES = ["order_id", "product"]
ROW = ["region", "order_date", "order_id", "product", "revenue"]


def _doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines return the same type."""
    decimals = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals}) if decimals else df


# --- sources ---------------------------------------------------------------------------------------------------

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_orderdate", T.DateType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)
EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def _order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(*[F.col(f.name).cast(f.dataType) for f in ORDERS_SCHEMA])


def _orders_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "orders_csv")
    _order_records(spark, sf_dir).write.option("header", True).csv(path)
    return path


def _broken_orders_csv(spark: SparkSession, sf_dir: str) -> str:
    """Orders as text lines; those of the lowest priority have a bad date and too few fields."""
    orders = _order_records(spark, sf_dir)
    good = F.concat_ws(",", *[F.col(name).cast("string") for name in ORDERS_SCHEMA.names])
    broken = F.concat_ws(",", *[F.col(c).cast("string") for c in ("o_orderkey", "o_custkey", "o_orderstatus")], F.lit("INVALID_DATE"))
    path = scratch_path(spark, "broken_orders_csv")
    orders.select(F.when(F.col("o_orderpriority") == "5-LOW", broken).otherwise(good).alias("value")).write.text(path)
    return path


def q_scan_csv(spark, sf_dir):
    return scan_csv(spark, _orders_csv(spark, sf_dir), ORDERS_SCHEMA)


def q_scan_csv_timestamps(spark, sf_dir):
    events = _whole_seconds(spark, sf_dir)
    path = scratch_path(spark, "events_csv")
    stamped = events.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    stamped.write.options(header=True, escape='"').csv(path)
    return scan_csv(spark, path, EVENTS_SCHEMA, escape='"')


def q_scan_csv_inferred(spark, sf_dir):
    return scan_csv(spark, _orders_csv(spark, sf_dir))


def q_scan_csv_mode(spark, sf_dir):
    path = _broken_orders_csv(spark, sf_dir)
    rows = scan_csv(spark, path, ORDERS_SCHEMA, header=False, keep_corrupt=True)
    return rows.select(*ORDERS_SCHEMA.names, F.col("_corrupt_record").isNotNull().cast("int").alias("is_corrupt"))


def q_scan_csv_dropmalformed(spark, sf_dir):
    path = _broken_orders_csv(spark, sf_dir)
    return scan_csv(spark, path, ORDERS_SCHEMA, header=False, mode="DROPMALFORMED")


def _whole_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with all their columns but props last, their time cut to seconds as the text formats hold it."""
    return table(spark, sf_dir, "events").select(*EVENTS_SCHEMA.names).withColumn("ts", F.date_trunc("second", "ts").cast("timestamp_ntz"))


_EVENTS_A_FILE = 5_000


def _events_json(spark: SparkSession, sf_dir: str, pretty: bool = False, broken: bool = False) -> str:
    """Events as JSON lines; or each spread over several lines, one array a file; or errors cut off in their middle."""
    path = scratch_path(spark, "events_json")
    events = _whole_seconds(spark, sf_dir)
    record = F.to_json(F.struct(*EVENTS_SCHEMA.names), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss", "pretty": str(pretty).lower()})
    if broken:
        record = F.when(F.col("event_type") == "error", F.substring(record, 1, 30)).otherwise(record)
    if pretty:  # a file per few thousand events, about a megabyte: one task reads a whole file, and each file costs a listing
        files = events.groupBy(F.floor(F.col("event_id") / _EVENTS_A_FILE).alias("file")).agg(F.array_join(F.collect_list(record), ",\n").alias("all"))
        arrays = files.select(F.concat(F.lit("["), "all", F.lit("]")).alias("value"))
        arrays.repartition(16).write.option("maxRecordsPerFile", 1).text(path)
    else:
        events.select(record.alias("value")).write.text(path)
    return path


def q_scan_json(spark, sf_dir):
    return scan_json(spark, _events_json(spark, sf_dir), EVENTS_SCHEMA)


def q_scan_json_inferred(spark, sf_dir):
    return scan_json(spark, _events_json(spark, sf_dir)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def q_scan_json_multiline(spark, sf_dir):
    return scan_json(spark, _events_json(spark, sf_dir, pretty=True), EVENTS_SCHEMA, multiline=True)


def q_scan_json_permissive(spark, sf_dir):
    schema = T.StructType([*EVENTS_SCHEMA, T.StructField("_corrupt_record", T.StringType())])
    rows = scan_json(spark, _events_json(spark, sf_dir, broken=True), schema)
    return rows.withColumnRenamed("_corrupt_record", "corrupt")


def q_scan_json_dropmalformed(spark, sf_dir):
    return scan_json(spark, _events_json(spark, sf_dir, broken=True), EVENTS_SCHEMA, mode="DROPMALFORMED")


def q_scan_files(spark, sf_dir):
    path = scratch_path(spark, "parts_orc")
    table(spark, sf_dir, "part").write.orc(path)
    return scan_files(spark, path, "orc")


def q_scan_dispatch(spark, sf_dir):
    path = scratch_path(spark, "suppliers_orc")
    table(spark, sf_dir, "supplier").write.orc(path)
    return scan(spark, path, "ORC")


def q_scan_incremental(spark, sf_dir):
    newer = scan_incremental(spark, f"{sf_dir}/orders.parquet", "o_orderdate", "1999-06-15")
    return newer.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))


# --- quality ---------------------------------------------------------------------------------------------------


def _gappy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in which the last lines of an order lack their discount and the returned ones their mode."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        F.when(F.col("l_linenumber") != 7, F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_linenumber") != 6, F.col("l_linenumber")).alias("l_line"),
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("l_returnflag"),
    )


def q_validate_columns(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    checked = quality.require_columns(customers, ["c_custkey", "c_name", "c_mktsegment"])
    try:
        quality.require_columns(customers, ["c_custkey", "c_phone", "c_address"])
        message = None
    except ValueError as error:
        message = str(error)
    named = F.lit(message is not None and "c_phone" in message and "c_address" in message and "c_custkey" not in message)
    return checked.withColumn("names_what_lacks", named.cast("int"))


def q_validate_row_count(spark, sf_dir):
    checked = quality.validate(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey"], min_rows=100)
    return aggregates.group_aggregate(checked, ["o_orderstatus"], {"o_orderkey": ["count"]})


def q_null_ratio_profile(spark, sf_dir):
    profile = quality.null_profile(_gappy_lines(spark, sf_dir), ["l_orderkey", "l_discount", "l_line", "l_returnflag"])
    return profile.withColumn("null_ratio", F.round("null_ratio", 6))


def q_readback_validate(spark, sf_dir):
    orders = _order_records(spark, sf_dir).withColumn("o_year", F.year("o_orderdate"))
    path = scratch_path(spark, "orders_checked")
    rows = write_parquet(orders, path, ["o_year"])
    read_back(spark, path, expected_rows=rows)
    return read_back(spark, path, expected_columns=["o_orderkey", "o_year"], where="o_year = 1996")


# --- projections, filters, cleaning ------------------------------------------------------------------------------


def q_filter_expr(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return transforms.filter_rows(lines, "l_quantity > 45 AND l_discount >= 0.05 AND l_returnflag = 'R'")


def q_select_rename(spark, sf_dir):
    names = {"c_custkey": "id", "c_name": "customer", "c_mktsegment": "segment"}
    return transforms.select_rename(table(spark, sf_dir, "customer"), names)


def q_cast_columns(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    number = F.col("l_linenumber")
    text = F.when(number == 1, "1e5").when(number == 2, "2.7").when(number == 3, " 12 ").when(number == 4, "-3.").when(number == 5, "x")
    lines = lines.withColumn("l_text", F.coalesce(text, number.cast("string")))
    return transforms.cast_columns(
        lines, {"l_text": "int", "l_quantity": "int", "l_linenumber": "string", "l_returnflag": "double", "l_shipdate": "date"}
    )


def q_nulls_drop(spark, sf_dir):
    return transforms.handle_nulls(_gappy_lines(spark, sf_dir), "drop", subset=["l_discount", "l_returnflag"])


def q_nulls_fill(spark, sf_dir):
    return transforms.handle_nulls(_gappy_lines(spark, sf_dir), "fill", {"l_discount": 0.5, "l_returnflag": "none"})


def q_nulls_fill_default(spark, sf_dir):
    return transforms.handle_nulls(_gappy_lines(spark, sf_dir), "fill_default")


def q_derive_revenue(spark, sf_dir):
    df = transforms.add_revenue(raw_sales(spark, sf_dir))
    return _doubles(df.select("order_id", "product", "quantity", "unit_price", "discount", "revenue"))


def q_derive_profit_margin(spark, sf_dir):
    df = transforms.add_profit_margin(transforms.add_revenue(raw_sales(spark, sf_dir)))
    return _doubles(df.select("order_id", "product", "revenue", "profit_margin"))


def q_derive_date_parts(spark, sf_dir):
    df = transforms.add_date_parts(raw_sales(spark, sf_dir))
    return df.select("order_id", "product", "order_date", "order_year", "order_month", "order_quarter")


def q_bucket_age(spark, sf_dir):
    df = transforms.add_age_band(raw_sales(spark, sf_dir))
    return df.groupBy("age_bucket").agg(
        F.count("order_id").alias("n"), F.min("customer_age").alias("youngest"), F.max("customer_age").alias("oldest")
    )


def q_add_ingestion_ts(spark, sf_dir):
    df = transforms.add_ingestion_ts(table(spark, sf_dir, "orders"))
    return df.groupBy("o_orderstatus").agg(
        F.count("ingestion_ts").alias("n_stamped"), F.count_distinct("ingestion_ts").alias("n_moments")
    )


def _classified(spark, sf_dir):
    return transforms.classify(sales(spark, sf_dir))


def q_tier_revenue(spark, sf_dir):
    return _doubles(_classified(spark, sf_dir).select("order_id", "product", "revenue", "sales_tier"))


def q_flag_payment(spark, sf_dir):
    return _classified(spark, sf_dir).groupBy("payment_method", "payment_flag").agg(F.count("order_id").alias("n"))


def q_level_discount(spark, sf_dir):
    return _doubles(_classified(spark, sf_dir).select("order_id", "product", "discount", "discount_level"))


def q_standardise_strings(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("p_name", F.concat(F.lit("  "), F.lower("p_name"), F.lit(" ")))
    return transforms.standardise_strings(parts, ["p_name", "p_type", "no_such_column"]).select("p_partkey", "p_name", "p_type")


# --- dedup -----------------------------------------------------------------------------------------------------


def q_dedup_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    return dedup.dedup_rows(lines)


def q_dedup_keys(spark, sf_dir):
    rows = sales(spark, sf_dir).select("order_id", "product", "revenue", "quantity", "payment_method")
    return _doubles(dedup.dedup_keys(rows, ["order_id"], [F.desc("revenue"), "product", "quantity", "payment_method"]))


def q_dedup_keys_any(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return dedup.dedup_keys(lines, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber")


# --- aggregates ------------------------------------------------------------------------------------------------


def q_group_aggregate(spark, sf_dir):
    df = aggregates.group_aggregate(
        sales(spark, sf_dir),
        ["region", "payment_method"],
        {"revenue": ["sum", "max"], "quantity": ["sum", "min"], "order_id": ["count"]},
    )
    return _doubles(df)


def _one_metric(name: str, column: str) -> Query:
    def query(spark, sf_dir):
        df = aggregates.group_aggregate(sales(spark, sf_dir), ["region", "product"], {column: [name]})
        return _doubles(df)

    return query


def _one_mean(name: str) -> Query:
    def query(spark, sf_dir):
        df = aggregates.group_aggregate(sales(spark, sf_dir), ["region", "product"], {"quantity": [name]})
        return df.withColumn(f"{name}_quantity", F.round(f"{name}_quantity", 4))

    return query


def q_agg_count(spark, sf_dir):
    return aggregates.group_aggregate(_gappy_lines(spark, sf_dir), ["l_linenumber"], {"l_discount": ["count"]})


def q_stats_summary(spark, sf_dir):
    return _doubles(aggregates.stats_summary(sales(spark, sf_dir), ["quantity", "customer_age", "revenue"]))


def q_stats_percentiles(spark, sf_dir):
    return _doubles(aggregates.exact_percentiles(sales(spark, sf_dir), ["revenue", "quantity"], [0.25, 0.5, 0.75, 0.95]))


def q_stats_percentiles_bound(spark, sf_dir):
    """Whether each percentile of the randomised sketch has a rank within five times its usual error, for any table size."""
    prices = table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("price"))
    shares = [0.1, 0.25, 0.5, 0.75, 0.95]
    found = Tables(spark).put(aggregates.stats_summary(prices, ["price"], shares), "percentiles", keep=True)  # one draw
    names = [f"p{round(share * 100)}_price" for share in shares]
    ranks = prices.agg(
        F.count("price").alias("n"),
        *[F.count_if(F.col("price") < found.select(name).scalar()).alias(f"below_{name}") for name in names],
        *[F.count_if(F.col("price") <= found.select(name).scalar()).alias(f"upto_{name}") for name in names],
    )
    slack = F.col("n") * 0.005 + 1
    checks = [
        ((F.col(f"below_{name}") <= F.col("n") * share + slack) & (F.col(f"upto_{name}") >= F.col("n") * share - slack))
        .cast("int")
        .alias(f"{name}_within")
        for share, name in zip(shares, names)
    ]
    return ranks.select("n", *checks)


def q_stats_skip_missing(spark, sf_dir):
    return aggregates.stats_summary(sales(spark, sf_dir), ["no_such_column", "quantity"])


def q_sales_summary(spark, sf_dir):
    return _doubles(aggregates.sales_summary(sales(spark, sf_dir)))


def q_agg_count_distinct(spark, sf_dir):
    return aggregates.sales_summary(sales(spark, sf_dir)).select("region", "product", "unique_customers")


def q_group_monthly_region(spark, sf_dir):
    df = aggregates.group_aggregate(sales(spark, sf_dir), ["region", "order_year", "order_month"], pipeline.MONTHLY)
    return _doubles(df.withColumn("avg_revenue", F.round("avg_revenue", 2)))


# --- windows ---------------------------------------------------------------------------------------------------


def _window(*columns: str, **options) -> Query:
    def query(spark, sf_dir):
        df = sales(spark, sf_dir).select(*ROW)
        added = windows.window_columns(df, "region", "order_date", tie_break=TIES, **options)
        return _doubles(added.select(*ROW, *columns))

    return query


WINDOW_COLUMNS = ("row_num", "rank", "dense_rank", "lag_revenue", "lead_revenue", "running_total")


def q_win_rank_over_agg(spark, sf_dir):
    per_customer = sales(spark, sf_dir).groupBy("region", "customer_id").agg(F.sum("quantity").alias("units"))
    ranked = windows.window_columns(per_customer, "region", "units", "units", tie_break=["customer_id"])
    return ranked.select("region", "customer_id", "units", "dense_rank")


# --- joins -----------------------------------------------------------------------------------------------------


def _user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"), "event_id", "event_type", "value")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")


def _join_events(how: str) -> Query:
    def query(spark, sf_dir):
        return joins.join_tables(_customers(spark, sf_dir), _user_events(spark, sf_dir), "c_custkey", how)

    return query


def q_join_right(spark, sf_dir):
    return joins.join_tables(_user_events(spark, sf_dir), _customers(spark, sf_dir), "c_custkey", "right")


def q_join_full(spark, sf_dir):
    return joins.join_tables(table(spark, sf_dir, "labels"), _vectors(spark, sf_dir), "doc_id", "full")


def q_join_where(spark, sf_dir):
    return joins.join_tables(
        _customers(spark, sf_dir),
        _user_events(spark, sf_dir),
        "c_custkey",
        "left",
        where="c_mktsegment = 'BUILDING' AND (event_type IS NULL OR event_type = 'purchase')",
    )


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    return nations.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")


def q_join_broadcast(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return joins.broadcast_join(customers, _nations(spark, sf_dir), "c_nationkey")


def q_join_select(spark, sf_dir):
    wanted = ["c_custkey AS customer", "upper(c_name) AS name", "value"]
    return joins.join_tables(_customers(spark, sf_dir), _user_events(spark, sf_dir), "c_custkey", select=wanted)


def q_join_full_native(spark, sf_dir):
    return joins.join_tables(table(spark, sf_dir, "labels"), _vectors(spark, sf_dir), "doc_id", "full", skew_safe=False)


def q_join_salted(spark, sf_dir):
    """Every event type holds about a fifth of the events, so all keys are hot."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    types = events.groupBy("event_type").agg(F.count("*").alias("n_of_type"))
    return joins.salted_join(events, types, "event_type", hot_share=0.05)


def q_join_salted_full(spark, sf_dir):
    events = _user_events(spark, sf_dir)
    return joins.salted_join(events, _customers(spark, sf_dir), "c_custkey", "full", hot_share=0.0005)


# --- sort, limit, top-k ----------------------------------------------------------------------------------------


def q_sort_desc(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ordering.sort_rows(orders, F.desc("o_totalprice"))


def q_sort_multi(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return ordering.sort_rows(customers, "c_mktsegment", "c_nationkey", "c_custkey")


def q_topk_per_group(spark, sf_dir):
    lines = sales(spark, sf_dir).select("region", "order_id", "product", "revenue")
    return _doubles(ordering.top_k_per_group(lines, ["region"], "revenue", 5))


def q_limit_preview(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ordering.preview(orders, [F.desc("o_totalprice"), "o_orderkey"], 10)


# --- SQL and reports -------------------------------------------------------------------------------------------


def q_sql_register(spark, sf_dir):
    with Views(spark) as views:
        views.register(table(spark, sf_dir, "orders"), "tableops_orders")
        views.register(table(spark, sf_dir, "customer"), "tableops_customers", global_view=True)
        return views.sql(
            "SELECT c_mktsegment, count(o_orderkey) AS n_orders, count(DISTINCT o_custkey) AS n_buyers "
            "FROM tableops_orders JOIN global_temp.tableops_customers ON o_custkey = c_custkey GROUP BY c_mktsegment"
        )


def q_sql_drop(spark, sf_dir):
    views = Views(spark)
    views.register(table(spark, sf_dir, "customer"), "tableops_dropped")
    counted = views.sql("SELECT c_mktsegment, count(*) AS n FROM tableops_dropped GROUP BY c_mktsegment")
    dropped = views.drop("tableops_dropped")
    again = views.drop("tableops_dropped")
    return counted.withColumns({"dropped": F.lit(int(dropped)), "dropped_again": F.lit(int(again))})


def q_sql_drop_all(spark, sf_dir):
    views = Views(spark)
    views.register(table(spark, sf_dir, "customer"), "tableops_a")
    views.register(table(spark, sf_dir, "customer"), "tableops_b", global_view=True)
    counted = views.sql("SELECT count(*) AS n FROM tableops_a UNION ALL SELECT count(*) FROM global_temp.tableops_b")
    views.drop_all()
    left = sum([spark.catalog.tableExists("tableops_a"), spark.catalog.tableExists("global_temp.tableops_b")])
    return counted.withColumn("views_left", F.lit(left))


def q_sql_raw(spark, sf_dir):
    return run_sql(
        spark,
        "SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS highest FROM {orders} GROUP BY o_orderpriority",
        orders=table(spark, sf_dir, "orders"),
    )


def q_report_top_products(spark, sf_dir):
    return _doubles(reports.top_products(sales(spark, sf_dir)))


def q_report_high_value_customers(spark, sf_dir):
    return _doubles(reports.high_value_customers(sales(spark, sf_dir)))


def q_report_high_value_customers_times(spark, sf_dir):
    return _doubles(reports.high_value_customers(sales(spark, sf_dir), times=40))


def q_scalar_subquery(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(14,2)"))
    return orders.filter(F.col("price") > orders.agg(F.avg("price")).scalar()).select("o_orderkey", "o_totalprice")


def q_having_filter(spark, sf_dir):
    units = aggregates.group_aggregate(sales(spark, sf_dir), ["customer_id"], {"quantity": ["sum"]})
    return transforms.filter_rows(units, "sum_quantity > 1200")


def q_report_rolling_revenue(spark, sf_dir):
    return _doubles(reports.rolling_revenue(sales(spark, sf_dir)))


# --- layout ----------------------------------------------------------------------------------------------------


def q_layout_repartition(spark, sf_dir):
    spread = layout.set_partitions(table(spark, sf_dir, "orders"), 16, by="o_orderstatus")  # three values
    sizes = spread.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"), F.count_distinct("o_orderstatus").alias("values"))
    even = F.max("n") <= 2 * F.avg("n")
    return sizes.agg(F.count("*").alias("n_partitions"), F.sum("n").alias("n_rows"), even.cast("int").alias("is_even"))


def _cache_rows(df: DataFrame, kept: DataFrame, by: str) -> DataFrame:
    found = stored(df.groupBy(F.col(by).alias("name")).agg(F.count("*").alias("n")), "counted")  # while it is cached
    level = kept.storageLevel
    return found.withColumns({"on_disk": F.lit(int(level.useDisk)), "in_memory": F.lit(int(level.useMemory))})


def q_layout_cache(spark, sf_dir):
    with layout.cached(table(spark, sf_dir, "customer"), "disk_only") as kept:
        return _cache_rows(kept, kept, "c_mktsegment")


def q_layout_unpersist(spark, sf_dir):
    kept = layout.cache(table(spark, sf_dir, "customer"))
    kept.count()
    return _cache_rows(kept, layout.uncache(kept), "c_mktsegment")


def q_partition_skew_profile(spark, sf_dir):
    """Lines dealt to eight partitions by the hash of their number, 1 to 7: the SQL knows where each number goes."""
    spread = table(spark, sf_dir, "lineitem").select("l_linenumber").repartition(8, "l_linenumber")
    return layout.partition_profile(spread, 8).withColumn("skew", F.round("skew", 6))


def q_key_skew_profile(spark, sf_dir):
    profile = layout.key_profile(table(spark, sf_dir, "events"), ["user_id"], 20)
    return profile.withColumn("share", F.round("share", 6))


# --- sinks -----------------------------------------------------------------------------------------------------


def q_write_parquet(spark, sf_dir):
    path = scratch_path(spark, "customers")
    write_parquet(table(spark, sf_dir, "customer"), path, compression="zstd")
    return read_back(spark, path)


def _orders_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _order_records(spark, sf_dir)
    return orders.withColumns({"o_year": F.year("o_orderdate"), "o_month": F.month("o_orderdate")})


def q_write_partitioned(spark, sf_dir):
    path = scratch_path(spark, "orders_by_month")
    write_parquet(_orders_by_month(spark, sf_dir), path, ["o_year", "o_month"])
    return read_back(spark, path)


def q_write_dynamic_overwrite(spark, sf_dir):
    path = scratch_path(spark, "orders_overwritten")
    orders = _orders_by_month(spark, sf_dir)
    write_parquet(orders, path, ["o_year"])
    later = orders.filter("o_year >= 1998").withColumn("o_totalprice", F.lit(0.0))
    write_parquet(later, path, ["o_year"])
    return read_back(spark, path)


def q_list_partitions(spark, sf_dir):
    path = scratch_path(spark, "orders_listed")
    write_parquet(_orders_by_month(spark, sf_dir), path, ["o_year", "o_month"])
    listed = list_partitions(spark, path, ["o_year", "o_month"])
    return listed.select("o_year", "o_month", "n_rows", (F.col("n_files") > 0).cast("int").alias("has_files"))


# --- the whole job ---------------------------------------------------------------------------------------------

EXACT_CASTS = {"quantity": "int", "unit_price": "decimal(12,2)", "discount": "decimal(4,2)"}


def _pipeline_output(name: str, drop: tuple[str, ...] = (), whole: bool = False, **rounded: int) -> Query:
    """One output of the job with all its columns, from a run of its own that writes it, or all outputs if ``whole``.

    A run shared by the queries of a session would charge all of it to the one that happens to come first.
    """

    def query(spark, sf_dir):
        out = scratch_path(spark, "pipeline")
        outputs = [o for o in pipeline.OUTPUTS if whole or o == name]
        pipeline.run_sales_pipeline(spark, raw_sales(spark, sf_dir), out, EXACT_CASTS, outputs=outputs)
        df = read_back(spark, f"{out}/{name}").drop(*drop)
        return _doubles(df.withColumns({c: F.round(c, digits) for c, digits in rounded.items()}))

    return query


def q_sales_pipeline_stats(spark, sf_dir):
    """The measures; percentiles come from a randomised sketch, so only their order is compared."""
    df = _pipeline_output("stats")(spark, sf_dir)
    columns = ("revenue", "quantity", "unit_price")
    rising = [F.col(f"p{a}_{c}") <= F.col(f"p{b}_{c}") for c in columns for a, b in ((25, 50), (50, 75), (75, 95))]
    inside = [(F.col(f"min_{c}") <= F.col(f"p25_{c}")) & (F.col(f"p95_{c}") <= F.col(f"max_{c}")) for c in columns]
    ordered = rising[0]
    for check in [*rising[1:], *inside]:
        ordered = ordered & check
    measures = [f"{m}_{c}" for c in columns for m in ("mean", "stddev", "min", "max")]
    return df.select(*measures, ordered.cast("int").alias("percentiles_in_order"))


def q_sales_transform(spark, sf_dir):
    df = pipeline.transform_sales(raw_sales(spark, sf_dir), casts=EXACT_CASTS)
    return _doubles(df.drop("ingestion_ts"))


QUERIES: dict[str, Query] = {
    "scan_csv": q_scan_csv,
    "scan_csv_inferred": q_scan_csv_inferred,
    "scan_csv_timestamps": q_scan_csv_timestamps,
    "scan_csv_mode": q_scan_csv_mode,
    "scan_csv_dropmalformed": q_scan_csv_dropmalformed,
    "scan_json": q_scan_json,
    "scan_json_inferred": q_scan_json_inferred,
    "scan_json_multiline": q_scan_json_multiline,
    "scan_json_permissive": q_scan_json_permissive,
    "scan_json_dropmalformed": q_scan_json_dropmalformed,
    "scan_files": q_scan_files,
    "scan_dispatch": q_scan_dispatch,
    "scan_incremental": q_scan_incremental,
    "validate_columns": q_validate_columns,
    "validate_row_count": q_validate_row_count,
    "null_ratio_profile": q_null_ratio_profile,
    "readback_validate": q_readback_validate,
    "filter_expr": q_filter_expr,
    "select_rename": q_select_rename,
    "cast_columns": q_cast_columns,
    "nulls_drop": q_nulls_drop,
    "nulls_fill": q_nulls_fill,
    "nulls_fill_default": q_nulls_fill_default,
    "derive_revenue": q_derive_revenue,
    "derive_profit_margin": q_derive_profit_margin,
    "derive_date_parts": q_derive_date_parts,
    "bucket_age": q_bucket_age,
    "add_ingestion_ts": q_add_ingestion_ts,
    "tier_revenue": q_tier_revenue,
    "flag_payment": q_flag_payment,
    "level_discount": q_level_discount,
    "standardise_strings": q_standardise_strings,
    "dedup_rows": q_dedup_rows,
    "dedup_keys": q_dedup_keys,
    "dedup_keys_any": q_dedup_keys_any,
    "group_aggregate": q_group_aggregate,
    "agg_sum": _one_metric("sum", "revenue"),
    "agg_avg": _one_mean("avg"),
    "agg_mean": _one_mean("mean"),
    "agg_max": _one_metric("max", "revenue"),
    "agg_min": _one_metric("min", "revenue"),
    "agg_count": q_agg_count,
    "agg_stddev": _one_mean("stddev"),
    "stats_summary": q_stats_summary,
    "stats_percentiles": q_stats_percentiles,
    "stats_percentiles_bound": q_stats_percentiles_bound,
    "stats_skip_missing": q_stats_skip_missing,
    "sales_summary": q_sales_summary,
    "agg_count_distinct": q_agg_count_distinct,
    "group_monthly_region": q_group_monthly_region,
    "win_row_number": _window("row_num"),
    "win_rank": _window("rank"),
    "win_dense_rank": _window("dense_rank"),
    "win_lag": _window("lag_revenue"),
    "win_lead": _window("lead_revenue"),
    "win_running_total": _window("running_total"),
    "win_all": _window(*WINDOW_COLUMNS, split=None),
    "win_all_split": _window(*WINDOW_COLUMNS),
    "win_offsets_split": _window("lag_revenue", "lead_revenue", lag=3, lead=2),
    "win_rolling_avg": q_report_rolling_revenue,
    "win_rank_over_agg": q_win_rank_over_agg,
    "join_inner": _join_events("inner"),
    "join_left": _join_events("left"),
    "join_right": q_join_right,
    "join_full": q_join_full,
    "join_where": q_join_where,
    "join_select": q_join_select,
    "join_full_native": q_join_full_native,
    "join_broadcast": q_join_broadcast,
    "join_salted": q_join_salted,
    "join_salted_full": q_join_salted_full,
    "sort_desc": q_sort_desc,
    "sort_multi": q_sort_multi,
    "topk_per_group": q_topk_per_group,
    "limit_preview": q_limit_preview,
    "sql_register": q_sql_register,
    "sql_drop": q_sql_drop,
    "sql_drop_all": q_sql_drop_all,
    "sql_raw": q_sql_raw,
    "report_top_products": q_report_top_products,
    "report_high_value_customers": q_report_high_value_customers,
    "report_high_value_customers_times": q_report_high_value_customers_times,
    "scalar_subquery": q_scalar_subquery,
    "having_filter": q_having_filter,
    "report_rolling_revenue": q_report_rolling_revenue,
    "layout_repartition": q_layout_repartition,
    "layout_cache": q_layout_cache,
    "layout_unpersist": q_layout_unpersist,
    "partition_skew_profile": q_partition_skew_profile,
    "key_skew_profile": q_key_skew_profile,
    "write_parquet": q_write_parquet,
    "write_partitioned": q_write_partitioned,
    "write_dynamic_overwrite": q_write_dynamic_overwrite,
    "list_partitions": q_list_partitions,
    "sales_transform": q_sales_transform,
    "sales_pipeline": _pipeline_output("regional_summary", whole=True, avg_revenue=2),
    "sales_pipeline_windowed": _pipeline_output("windowed", ("ingestion_ts",)),
    "sales_pipeline_transformed": _pipeline_output("transformed", ("ingestion_ts",)),
    "sales_pipeline_top_products": _pipeline_output("top_products"),
    "sales_pipeline_high_value_customers": _pipeline_output("high_value_customers"),
    "sales_pipeline_rolling_revenue": _pipeline_output("rolling_revenue"),
    "sales_pipeline_stats": q_sales_pipeline_stats,
}
QUERIES |= timed.QUERIES | streams.QUERIES | keyed.QUERIES
