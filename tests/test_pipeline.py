import os

import pytest
from pyspark.sql import functions as F

from tableops.catalog.queries import QUERIES
from tableops.plans import pipeline
from tableops.plans.pipeline import of_run, run_sales_pipeline, transform_sales
from tableops.sources import scan_csv

HEADER = "order_id,order_date,region,customer_id,product,quantity,unit_price,discount,payment_method,customer_age"
OUTPUTS = {
    "transformed",
    "regional_summary",
    "windowed",
    "top_products",
    "high_value_customers",
    "rolling_revenue",
    "stats",
}


def csv_lines():
    """150 orders, the first ten of them twice, and three short lines with a bad date."""
    regions, products = ["north", "South ", "EAST"], ["pen", "cap", "mug", "bag", "hat", "cup"]
    lines = []
    for i in range(150):
        date = f"2024-{i % 4 + 1:02d}-{i % 28 + 1:02d}"
        price = 10 + i * 7.25
        lines.append(
            f"O{i},{date},{regions[i % 3]},C{i % 20},{products[i % 6]},{i % 9 + 1},{price},"
            f"{[0, 0.05, 0.2, ''][i % 4]},{['Credit Card', 'Cash'][i % 2]},{18 + i % 50}"
        )
    bad = [f"O9{i},INVALID_DATE,north,,BAD_ROW" for i in range(3)]
    return [HEADER, *lines, *lines[:10], *bad]


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("pipeline") / "sales.csv"
    path.write_text("\n".join(csv_lines()))
    return scan_csv(spark, str(path))


@pytest.fixture(scope="module")
def run(spark, source, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    return out, run_sales_pipeline(spark, source, out)


def test_outputs(spark, run):
    out, written = run
    assert set(written) == OUTPUTS
    for name, rows in written.items():
        assert spark.read.parquet(f"{out}/{name}").count() == rows
    assert written["transformed"] == written["windowed"] == 150
    assert written["top_products"] == 6 and written["stats"] == 1


def test_layout(run):
    out, _ = run
    path = f"{out}/transformed/order_year=2024/order_month=1"
    assert sorted(d for d in os.listdir(path) if d.startswith("region")) == ["region=EAST", "region=NORTH", "region=SOUTH"]


def test_transformed(spark, run):
    df = spark.read.parquet(f"{run[0]}/transformed")
    row = df.filter("order_id = 'O3'").first()  # quantity 4, price 31.75, no discount given
    assert (row["revenue"], row["discount"], row["region"], row["product"]) == (127.0, 0.0, "NORTH", "BAG")
    assert (row["sales_tier"], row["payment_flag"], row["discount_level"], row["payment_method"]) == ("Bronze", 0, "None", "CASH")
    assert df.filter("payment_method = 'CREDIT CARD' AND payment_flag = 0").count() == 0
    assert df.select("ingestion_ts").distinct().count() == 1


def test_summary_adds_up(spark, run):
    out, _ = run
    sales = spark.read.parquet(f"{out}/transformed").agg(F.sum("revenue"), F.sum("quantity")).first()
    summary = spark.read.parquet(f"{out}/regional_summary").agg(F.sum("sum_revenue"), F.sum("sum_quantity")).first()
    assert summary[0] == pytest.approx(sales[0]) and summary[1] == sales[1]


def test_windowed_without_split_groups(spark, source, run, tmp_path):
    run_sales_pipeline(spark, source, str(tmp_path), split_windows=False)
    columns = ["order_id", "row_num", "rank", "dense_rank", "lag_revenue", "lead_revenue"]
    plain, split = (
        {tuple(r) for r in spark.read.parquet(f"{p}/windowed").select(*columns).collect()} for p in (run[0], tmp_path)
    )
    assert plain == split


def test_second_run_keeps_other_directories(spark, source, tmp_path):
    """Directories of an earlier run stay and do not enter the new run's reports."""
    run_sales_pipeline(spark, source, str(tmp_path), min_rows=1)
    later = source.filter("order_date LIKE '2024-02%'")
    written = run_sales_pipeline(spark, later, str(tmp_path), min_rows=1)
    stored = spark.read.parquet(f"{tmp_path}/transformed")
    assert stored.count() == 150
    summary = spark.read.parquet(f"{tmp_path}/regional_summary").agg(F.sum("count_order_id"), F.sum("sum_revenue")).first()
    assert summary[0] == 150 and summary[1] == pytest.approx(stored.agg(F.sum("revenue")).first()[0])
    assert stored.filter("order_month = 2").count() == written["transformed"] == written["windowed"] < 150


def test_reads_only_the_directories_of_the_run(spark, run):
    stored = spark.read.parquet(f"{run[0]}/transformed")
    started = stored.select("ingestion_ts").first()[0]
    plan = of_run(stored, started)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_dedup_comes_before_the_derived_columns(source):
    plan = transform_sales(source)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("profit_margin") < plan.index("Window")  # printed from the result down
    by_revenue = transform_sales(source, dedup_order=["revenue"])
    assert by_revenue.count() == 150


def test_failed_check_writes_nothing(spark, source, tmp_path):
    with pytest.raises(ValueError, match="minimum required"):
        run_sales_pipeline(spark, source, str(tmp_path / "out"), min_rows=1000)
    assert not os.path.exists(tmp_path / "out")
    with pytest.raises(ValueError, match="Missing required columns"):
        run_sales_pipeline(spark, source.drop("product"), str(tmp_path / "out"))


def test_text_input_is_cast_before_the_filter(spark):
    """Numbers read as text: the ones that are none drop out instead of failing the job."""
    rows = [("1", "2024-01-01", "n", "c", "p", "2", "1.5"), ("2", "2024-01-01", "n", "c", "p", "two", "1.5")]
    schema = "order_id string, order_date string, region string, customer_id string, product string, quantity string, unit_price string"
    df = transform_sales(spark.createDataFrame(rows, schema))
    assert [r["order_id"] for r in df.collect()] == ["1"]


def test_writes_only_the_outputs_asked_for(spark, source, tmp_path):
    written = run_sales_pipeline(spark, source, str(tmp_path), outputs=["stats"])
    assert written == {"transformed": 150, "stats": 1}
    assert sorted(os.listdir(tmp_path)) == ["stats", "transformed"]
    with pytest.raises(ValueError, match="Unknown outputs"):
        run_sales_pipeline(spark, source, str(tmp_path), outputs=["stat"])


def test_a_query_does_not_depend_on_another_ones_run(spark, monkeypatch):
    """Each pays for its own run, whichever comes first."""
    runs = []

    def run_and_note(*args, **options):
        runs.append(options["outputs"])
        return run_sales_pipeline(*args, **options)

    monkeypatch.setattr(pipeline, "run_sales_pipeline", run_and_note)
    for name in ("sales_pipeline_stats", "sales_pipeline_high_value_customers"):
        QUERIES[name](spark, "/root/testdata/sf0.001")
    assert runs == [["stats"], ["high_value_customers"]]


def test_rows_are_gathered_before_they_widen(source):
    plan = transform_sales(source, gather=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("profit_margin") < plan.index("RebalancePartitions") < plan.index("Window")  # from the result down
    by_revenue = transform_sales(source, dedup_order=["revenue"], gather=True)
    assert by_revenue.count() == 150
