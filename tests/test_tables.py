"""Shape of the shared input's plan."""

from tableops.catalog.tables import raw_sales


def test_lines_are_shuffled_for_orders_and_parts_only(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = raw_sales(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Printed from the result down: the shuffles above the scan of the lines, on its own branch.
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "l_orderkey" in line)
    depth, above = lines[scan].index("FileScan"), 0
    for line in reversed(lines[:scan]):
        at = len(line) - len(line.lstrip(" :+-*"))
        if at < depth:
            depth, above = at, above + ("Exchange hashpartitioning" in line)
    assert above == 2
