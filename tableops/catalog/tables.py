"""Input tables of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableops.functions import revenue

# Payment method per order priority.
_PAYMENT = {
    "1-URGENT": "Credit Card",
    "2-HIGH": "Debit Card",
    "3-MEDIUM": "Digital Wallet",
    "4-NOT SPECIFIED": "Cash",
}
_PAYMENT_DEFAULT = "Bank Transfer"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as sales records. Money is decimal, so sums do not depend on the order of the rows."""
    lines, orders, customers, nations, regions, parts = (
        table(spark, sf_dir, name) for name in ("lineitem", "orders", "customer", "nation", "region", "part")
    )
    # Dimensions first: the lines, by far the largest, are shuffled for orders and for parts only.
    buyers = regions.join(nations, F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = buyers.join(customers, F.col("c_nationkey") == F.col("n_nationkey"))
    bought = buyers.join(orders, F.col("o_custkey") == F.col("c_custkey"))
    joined = bought.join(lines, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    method = F.coalesce(
        *[F.when(F.col("o_orderpriority") == level, name) for level, name in _PAYMENT.items()], F.lit(_PAYMENT_DEFAULT)
    )
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("r_name").alias("region"),
        F.col("o_custkey").alias("customer_id"),
        F.col("p_brand").alias("product"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("unit_price"),
        (F.col("l_discount").cast("decimal(4,2)") * 3).cast("decimal(4,2)").alias("discount"),
        method.alias("payment_method"),
        (F.col("c_custkey") % 53 + 18).cast("int").alias("customer_age"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales records with revenue and date parts."""
    df = raw_sales(spark, sf_dir)
    return df.withColumns(
        {
            "revenue": revenue(F.col("quantity"), F.col("unit_price"), F.col("discount")).cast("decimal(14,2)"),
            "order_year": F.year("order_date"),
            "order_month": F.month("order_date"),
        }
    )
