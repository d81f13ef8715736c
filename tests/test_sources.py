import pytest
from pyspark.sql import types as T

from tableops.sources import jdbc_options, scan, scan_csv, scan_files, scan_incremental, scan_json

TIDES = T.StructType(
    [
        T.StructField("gauge", T.IntegerType()),
        T.StructField("place", T.StringType()),
        T.StructField("metres", T.DoubleType()),
    ]
)
BROKEN = "gauge,place,metres\n17,Brest,4\nout of order\n42,Cork,2\n"


@pytest.fixture()
def text_file(tmp_path):
    def write(content, name="data.txt"):
        path = tmp_path / name
        path.write_text(content, encoding="utf-8")
        return str(path)

    return write


class TestCsv:
    def test_inferred(self, spark, text_file):
        df = scan_csv(spark, text_file("gauge,place,metres\n17,Brest,4\n42,Cork,2\n"))
        assert df.count() == 2
        assert df.dtypes == [("gauge", "int"), ("place", "string"), ("metres", "int")]

    def test_explicit_schema(self, spark, text_file):
        df = scan_csv(spark, text_file("gauge,place,metres\n17,Brest,4.25\n42,Cork,-0.5\n"), TIDES)
        assert dict(df.dtypes)["metres"] == "double"
        assert [r["metres"] for r in df.collect()] == [4.25, -0.5]

    def test_no_header_and_delimiter(self, spark, text_file):
        df = scan_csv(spark, text_file("17;Brest;4\n42;Cork;2\n"), header=False, infer_schema=False, delimiter=";")
        assert df.count() == 2
        assert [t for _, t in df.dtypes] == ["string"] * 3

    def test_empty_field_is_null(self, spark, text_file):
        df = scan_csv(spark, text_file('gauge,place,metres\n1,,2\n2,"",3\n'), TIDES)
        assert [r["place"] for r in df.collect()] == [None, None]

    def test_dates_and_timestamps(self, spark, text_file):
        schema = T.StructType([T.StructField("d", T.DateType()), T.StructField("t", T.TimestampNTZType())])
        row = scan_csv(spark, text_file("d,t\n2024-03-01,2024-03-01 10:20:30\n"), schema).first()
        assert (str(row["d"]), str(row["t"])) == ("2024-03-01", "2024-03-01 10:20:30")

    def test_quotes_and_escapes(self, spark, text_file):
        doubled = text_file('gauge,place,metres\n1,"a, ""b"" c",2\n', "doubled.csv")
        assert scan_csv(spark, doubled, TIDES, escape='"').first()["place"] == 'a, "b" c'
        slashed = text_file('gauge,place,metres\n1,"a, \\"b\\" c",2\n', "slashed.csv")
        assert scan_csv(spark, slashed, TIDES).first()["place"] == 'a, "b" c'
        single = text_file("gauge,place,metres\n1,'a, b',2\n", "single.csv")
        assert scan_csv(spark, single, TIDES, quote="'").first()["place"] == "a, b"
        lines = text_file('gauge,place,metres\n1,"a\nb",2\n', "lines.csv")
        assert [tuple(r) for r in scan_csv(spark, lines, TIDES, multiline=True).collect()] == [(1, "a\nb", 2.0)]

    def test_directory_and_glob(self, spark, text_file, tmp_path):
        text_file("gauge,place,metres\n1,A,1\n", "a.csv")
        text_file("gauge,place,metres\n2,B,2\n", "b.csv")
        assert scan_csv(spark, str(tmp_path), TIDES).count() == 2
        assert scan_csv(spark, f"{tmp_path}/b*.csv", TIDES).first()["gauge"] == 2

    def test_permissive_keeps_broken_rows(self, spark, text_file):
        assert scan_csv(spark, text_file(BROKEN)).count() == 3

    @pytest.mark.parametrize("schema", [TIDES, None])
    def test_permissive_shows_the_broken_text(self, spark, text_file, schema):
        df = scan_csv(spark, text_file(BROKEN), schema, keep_corrupt=True)
        assert df.columns == ["gauge", "place", "metres", "_corrupt_record"]
        assert [r["_corrupt_record"] for r in df.collect()] == [None, "out of order", None]

    def test_dropmalformed_counts_what_it_returns(self, spark, text_file):
        df = scan_csv(spark, text_file(BROKEN), TIDES, mode="dropmalformed")
        assert df.count() == len(df.collect()) == 2
        assert df.select("gauge").count() == 2

    def test_failfast(self, spark, text_file):
        with pytest.raises(Exception, match="(?i)malformed"):
            scan_csv(spark, text_file(BROKEN), TIDES, mode="FAILFAST").collect()

    def test_unknown_mode(self, spark, text_file):
        with pytest.raises(ValueError, match="Unknown mode"):
            scan_csv(spark, text_file(BROKEN), mode="LENIENT")


class TestJson:
    def test_lines(self, spark, text_file):
        df = scan_json(spark, text_file('{"wind": 7.5, "from": "NW"}\n{"wind": 3, "gusts": [4, 9]}\n'))
        assert df.count() == 2
        assert dict(df.dtypes) == {"wind": "double", "from": "string", "gusts": "array<bigint>"}

    def test_multiline(self, spark, text_file):
        df = scan_json(spark, text_file('[{"id": 1,\n "tags": ["a"]},\n {"id": 2}]'), multiline=True)
        assert df.count() == 2

    def test_schema_and_timestamp(self, spark, text_file):
        schema = T.StructType([T.StructField("t", T.TimestampNTZType())])
        row = scan_json(spark, text_file('{"t": "2024-01-02T03:04:05"}\n'), schema).first()
        assert str(row["t"]) == "2024-01-02 03:04:05"

    def test_broken_line(self, spark, text_file):
        path = text_file('{"id": 1}\n{"id": \n')
        assert [(r["id"], r["_corrupt_record"]) for r in scan_json(spark, path).collect()] == [(1, None), (None, '{"id": ')]
        schema = T.StructType([T.StructField("id", T.LongType())])
        dropped = scan_json(spark, path, schema, mode="DROPMALFORMED")
        assert [r["id"] for r in dropped.collect()] == [1]
        assert dropped.count() == 1


class TestFiles:
    @pytest.mark.parametrize("name", ["parquet", "orc", "json"])
    def test_formats(self, spark, tmp_path, name):
        path = str(tmp_path / name)
        spark.range(5).write.format(name).save(path)
        assert scan_files(spark, path, name).count() == 5
        assert scan(spark, path, name.upper()).count() == 5

    def test_options(self, spark, text_file):
        assert scan_files(spark, text_file("a|b\n1|2\n"), "csv", options={"header": True, "sep": "|"}).columns == ["a", "b"]

    def test_dispatch_passes_arguments(self, spark, text_file):
        df = scan(spark, text_file("1;2\n"), "csv", header=False, delimiter=";")
        assert len(df.columns) == 2

    def test_dispatch_default_is_csv(self, spark, text_file):
        assert scan(spark, text_file("a\n1\n")).columns == ["a"]

    def test_unknown_format(self, spark):
        with pytest.raises(ValueError, match="No reader for format"):
            scan(spark, "/nowhere", "avro")


class TestIncremental:
    @pytest.fixture()
    def path(self, spark, tmp_path):
        rows = [(1, "1999-12-31"), (2, "2000-02-29"), (3, "2000-03-01"), (4, None)]
        path = str(tmp_path / "incremental")
        spark.createDataFrame(rows, "id int, updated_at string").selectExpr(
            "*", "cast(updated_at as date) as day"
        ).write.parquet(path)
        return path

    def test_strictly_newer(self, spark, path):
        assert scan_incremental(spark, path, "updated_at", "2000-01-01").count() == 2
        assert [r["id"] for r in scan_incremental(spark, path, "updated_at", "2000-02-29").collect()] == [3]

    def test_value_takes_the_column_type(self, spark, path):
        ids = {r["id"] for r in scan_incremental(spark, path, "day", "2000-1-5").collect()}
        assert ids == {2, 3}

    def test_parts_add_up(self, spark, path):
        newer = scan_incremental(spark, path, "id", 2)
        assert newer.count() + spark.read.parquet(path).filter("id <= 2").count() == 4

    def test_filter_reaches_the_scan(self, spark, path):
        plan = scan_incremental(spark, path, "day", "2000-03-01")._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThan(day,2000-03-01)" in plan


class TestJdbc:
    """Options only: no database is started here."""

    def test_table(self):
        assert jdbc_options("jdbc:x:y", "t", {"user": "u"}) == {"url": "jdbc:x:y", "user": "u", "dbtable": "t"}

    def test_split(self):
        options = jdbc_options("jdbc:x:y", "t", partition_column="id", lower_bound=0, upper_bound=100)
        assert options["partitionColumn"] == "id"
        assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("0", "100", "10")

    def test_split_needs_both_bounds(self):
        assert "partitionColumn" not in jdbc_options("jdbc:x:y", "t", partition_column="id", lower_bound=0)

    def test_query(self):
        options = jdbc_options("jdbc:x:y", query="SELECT 1 AS a")
        assert options["query"] == "SELECT 1 AS a" and "dbtable" not in options

    def test_split_query_becomes_a_derived_table(self):
        options = jdbc_options("jdbc:x:y", query="SELECT a FROM t", partition_column="a", lower_bound=1, upper_bound=9)
        assert options["dbtable"] == "(SELECT a FROM t) q" and "query" not in options

    def test_needs_an_input(self):
        with pytest.raises(ValueError):
            jdbc_options("jdbc:x:y")
