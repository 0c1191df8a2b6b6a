import pytest
from pyspark.sql import types as T

from aerolith.sources import columns, files
from tests.conftest import rows_of


def test_columns_are_found_under_any_name_and_case():
    found = columns.match_columns(
        ["YEAR", "Month", "ARR_DELAY", "OP_UNIQUE_CARRIER", "Canceled", "DestCityName", "Day"]
    )
    assert found["year"] == "YEAR"
    assert found["carrier"] == "OP_UNIQUE_CARRIER"
    assert found["cancelled"] == "Canceled"
    assert found["dest"] == "DestCityName"
    assert found["day_of_month"] == "Day"
    assert found["dep_time_raw"] is None


def test_first_accepted_name_wins():
    found = columns.match_columns(["year", "month", "arr_delay", "unique_carrier", "carrier", "day", "dayofmonth"])
    assert found["carrier"] == "carrier"
    assert found["day_of_month"] == "dayofmonth"


@pytest.mark.parametrize("missing", ["year", "month", "arr_delay"])
def test_required_columns(missing):
    present = [name for name in ("year", "month", "arr_delay") if name != missing]
    with pytest.raises(ValueError, match=missing):
        columns.match_columns(present)


def test_csv_keeps_every_value_as_text(spark, tmp_path):
    path = tmp_path / "flights.csv"
    path.write_text("Year,dep_delay\n" + "2018,5\n" * 10_001 + "later,7.5\n2019,\n")
    df = files.scan_source(spark, str(path))
    assert {f.dataType for f in df.schema} == {T.StringType()}
    assert rows_of(df.filter("dep_delay <> '5' OR dep_delay IS NULL")) == [("2019", None), ("later", "7.5")]


def test_parquet_and_suffixes(spark, tmp_path):
    path = str(tmp_path / "x.pq")
    spark.range(3).write.parquet(path)
    assert files.scan_source(spark, path).count() == 3
    with pytest.raises(ValueError, match="Unsupported"):
        files.scan_source(spark, "x.json")


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_ingest_order_follows_the_source(spark, tmp_path, kind):
    path = str(tmp_path / f"rows.{kind}")
    ids = spark.range(1000, numPartitions=1).selectExpr("1000 - id AS id")
    ids.write.option("header", True).format(kind).save(path)
    df = files.scan_source(spark, path, ingest_order=True)
    ordered = [int(row.id) for row in df.orderBy(*files.INGEST_ORDER).collect()]
    assert ordered == list(range(1000, 0, -1))
    assert df.select(*files.INGEST_ORDER).distinct().count() == 1000


def test_resolve_input(spark, tmp_path):
    second = tmp_path / "second.parquet"
    second.mkdir()
    candidates = (str(tmp_path / "first.csv"), str(second))
    assert files.resolve_input(spark, None, candidates) == str(second)
    assert files.resolve_input(spark, str(second)) == str(second)
    with pytest.raises(FileNotFoundError):
        files.resolve_input(spark, str(tmp_path / "none.csv"))
    with pytest.raises(FileNotFoundError):
        files.resolve_input(spark, None, candidates[:1])
