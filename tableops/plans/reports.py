"""Reports over a sales table.

Each report aggregates the table once. Where a report needs the aggregate twice, both uses have the same plan up to
the shuffle, so Spark runs it once and reuses the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableops.operators.ordering import top_k_per_group


def top_products(sales: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` best products per region by revenue, with their share of the region's revenue in percent."""
    products = _shared(
        sales.groupBy("region", "product").agg(
            F.sum("revenue").alias("product_revenue"), F.count("order_id").alias("product_orders")
        ),
        "product_orders",
    ).filter(F.col("region").isNotNull())
    totals = products.groupBy("region").agg(F.sum("product_revenue").alias("total_revenue"))
    best = top_k_per_group(products, ["region"], "product_revenue", k, "product_rank")
    share = F.try_divide(F.col("product_revenue"), F.col("total_revenue")) * 100
    return (
        best.join(totals, "region")
        .select(
            "region",
            "product",
            "product_revenue",
            "product_orders",
            "total_revenue",
            F.round(share, 2).alias("revenue_share_pct"),
            "product_rank",
        )
        .orderBy("region", "product_rank", "product")
    )


def high_value_customers(sales: DataFrame, times: float = 1) -> DataFrame:
    """Customers who spent more in total than ``times`` the average row's revenue, largest spend first."""
    spend = _shared(
        sales.groupBy("customer_id").agg(
            F.sum("revenue").alias("spend"),
            F.count("order_id").alias("num_orders"),
            F.count("revenue").alias("n_priced"),
        ),
        "num_orders",
        "n_priced",
    )
    average = spend.agg(F.try_divide(F.sum("spend"), F.sum("n_priced"))).scalar()
    return (
        spend.filter(F.col("spend") > average * times)
        .select(
            "customer_id",
            F.round("spend", 2).alias("total_spend"),
            "num_orders",
            F.round(average, 2).alias("avg_order_overall"),
        )
        .orderBy(F.desc("total_spend"), "customer_id")
    )


def rolling_revenue(sales: DataFrame, months: int = 3) -> DataFrame:
    """Monthly revenue per region and its average over the last ``months`` monthly rows (a missing month is no row)."""
    monthly = sales.groupBy("region", "order_year", "order_month").agg(
        F.round(F.sum("revenue"), 2).alias("monthly_revenue")
    )
    # The window sees months, not sales rows: a few hundred per region.
    recent = Window.partitionBy("region").orderBy("order_year", "order_month").rowsBetween(1 - months, 0)
    return monthly.withColumn(
        f"rolling_{months}m_avg_revenue", F.round(F.avg("monthly_revenue").over(recent), 2)
    ).orderBy("region", "order_year", "order_month")


def _shared(aggregate: DataFrame, *counts: str) -> DataFrame:
    """The same rows, but every use computes all of the named counts.

    A count is never negative, so the filter keeps all rows. It stops column pruning from giving each use its own
    narrower aggregate, which Spark could not share.
    """
    for count in counts:
        aggregate = aggregate.filter(F.col(count) >= 0)
    return aggregate
