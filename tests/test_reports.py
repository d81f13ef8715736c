import pytest

from tableops.plans.reports import high_value_customers, rolling_revenue, top_products
from tableops.plans.views import Views, run_sql


@pytest.fixture(scope="module")
def sales(spark):
    rows = [
        ("1", "N", "pen", "c1", 600.0, 2024, 1),
        ("2", "N", "cap", "c1", 300.0, 2024, 1),
        ("3", "N", "mug", "c2", 100.0, 2024, 2),
        ("4", "N", "bag", "c2", 100.0, 2024, 4),
        ("5", "S", "pen", "c3", 10.0, 2024, 1),
        ("6", "S", "cap", "c3", None, 2024, 1),
        ("7", None, "cap", "c4", 50.0, 2024, 1),
        (None, "N", "mug", "c5", 0.0, 2023, 12),
    ]
    schema = "order_id string, region string, product string, customer_id string, revenue double, order_year int, order_month int"
    return spark.createDataFrame(rows, schema)


def test_top_products(sales):
    rows = [tuple(r) for r in top_products(sales, 2).collect()]
    assert rows == [
        ("N", "pen", 600.0, 1, 1100.0, 54.55, 1),
        ("N", "cap", 300.0, 1, 1100.0, 27.27, 2),
        ("S", "pen", 10.0, 1, 10.0, 100.0, 1),
        ("S", "cap", None, 1, 10.0, None, 2),
    ]


def test_top_products_keeps_ties(sales):
    products = {r["product"] for r in top_products(sales, 3).filter("region = 'N'").collect()}
    assert products == {"pen", "cap", "mug", "bag"}


def test_share_of_nothing_is_null(spark, sales):
    zero = sales.filter("customer_id = 'c5'")
    assert top_products(zero).first()["revenue_share_pct"] is None


def test_high_value_customers(sales):
    # mean revenue per priced row: 1160 / 7 = 165.71
    rows = [tuple(r) for r in high_value_customers(sales).collect()]
    assert rows == [("c1", 900.0, 2, 165.71), ("c2", 200.0, 2, 165.71)]


def test_rolling_revenue(sales):
    rows = [tuple(r) for r in rolling_revenue(sales).filter("region = 'N'").collect()]
    assert rows == [
        ("N", 2023, 12, 0.0, 0.0),
        ("N", 2024, 1, 900.0, 450.0),
        ("N", 2024, 2, 100.0, 333.33),
        ("N", 2024, 4, 100.0, 366.67),
    ]
    assert "rolling_2m_avg_revenue" in rolling_revenue(sales, 2).columns


def test_reports_aggregate_once(sales):
    """Both uses of the aggregate share one shuffle of the sales rows."""
    for report in (top_products, high_value_customers):
        df = report(sales)
        df.collect()
        assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


class TestViews:
    def test_lifetime(self, spark):
        with Views(spark) as views:
            views.register(spark.range(3), "v_local")
            views.register(spark.range(4), "v_global", global_view=True)
            counted = views.sql("SELECT count(*) AS n FROM v_local")
            assert views.sql("SELECT count(*) AS n FROM global_temp.v_global").first()["n"] == 4
        assert not spark.catalog.tableExists("v_local")
        assert not spark.catalog.tableExists("global_temp.v_global")
        assert counted.first()["n"] == 3

    def test_replace_and_drop(self, spark):
        views = Views(spark)
        views.register(spark.range(3), "v_replaced")
        views.register(spark.range(5), "v_replaced")
        assert views.sql("SELECT * FROM v_replaced").count() == 5
        assert views.drop("v_replaced") is True
        assert views.drop("v_replaced") is False

    def test_dropped_after_an_error(self, spark):
        with pytest.raises(RuntimeError):
            with Views(spark) as views:
                views.register(spark.range(3), "v_error")
                raise RuntimeError
        assert not spark.catalog.tableExists("v_error")

    def test_frames_in_sql(self, spark):
        df = run_sql(spark, "SELECT a.id FROM {a} a JOIN {b} b ON a.id = b.id", a=spark.range(5), b=spark.range(3))
        assert df.count() == 3
        assert run_sql(spark, "SELECT 1 AS one").first()["one"] == 1
