import datetime as dt

import pytest
from pyspark.sql import functions as F

from aerolith import functions as fn


def values(spark, column, rows, schema):
    data = spark.createDataFrame([row if isinstance(row, tuple) else (row,) for row in rows], schema)
    return [row[0] for row in data.coalesce(1).select(column).collect()]


def test_season_covers_all_months_and_null(spark):
    months = [12, 1, 2, 3, 5, 6, 8, 9, 11, None]
    got = values(spark, fn.season(F.col("m")), months, "m int")
    assert got == ["winter"] * 3 + ["spring"] * 2 + ["summer"] * 2 + ["autumn"] * 3


def test_departure_hour_is_held_within_the_day(spark):
    times = [0, 5, 59, 100, 2359, 2400, -50, None]
    got = values(spark, fn.departure_hour(F.col("t")), times, "t int")
    assert got == [0, 0, 0, 1, 23, 23, 0, 0]


@pytest.mark.parametrize(
    "parts, expected",
    [
        ((2018, 1, 7), dt.date(2018, 1, 7)),
        ((2018, 2, 28), dt.date(2018, 2, 28)),
        ((2018, 2, 29), None),
        ((2018, 2, 30), None),
        ((2020, 2, 29), dt.date(2020, 2, 29)),
        ((2018, 4, 31), None),
        ((2018, 0, 1), None),
        ((2018, 13, 1), None),
        ((2018, 1, 0), None),
        ((2018, 1, 32), None),
        ((None, 1, 1), None),
        ((2018, None, 1), None),
        ((2018, 1, None), None),
        ((-5, 1, 1), None),
        ((99999, 1, 1), None),
    ],
)
def test_flight_date(spark, parts, expected):
    date = fn.flight_date(F.col("y"), F.col("m"), F.col("d"))
    assert values(spark, date, [parts], "y int, m int, d int") == [expected]


def test_iso_weekday(spark):
    days = [dt.date(2018, 1, 1), dt.date(2018, 1, 6), dt.date(2018, 1, 7), None]
    assert values(spark, fn.iso_weekday(F.col("d")), days, "d date") == [1, 6, 7, None]


def test_casts_give_null_for_what_they_cannot_read(spark):
    texts = ["2018", "2018.0", "xx", "", None, "99999999999"]
    assert values(spark, fn.as_int(F.col("x")), texts, "x string") == [2018] + [None] * 5
    assert values(spark, fn.as_int(F.col("x")), [2018.7, float("nan")], "x double") == [2018, None]
    assert values(spark, fn.as_tinyint(F.col("x")), ["1", "false", "300"], "x string") == [1, None, None]
    assert values(spark, fn.as_tinyint(F.col("x")), [True, False], "x boolean") == [1, 0]
    assert values(spark, fn.as_double(F.col("x")), ["1.5", "late"], "x string") == [1.5, None]
    assert values(spark, fn.upper_text(F.col("x")), ["aa", None], "x string") == ["AA", None]


def test_business_key(spark):
    rows = [(2018, 1, "AA"), (2018, None, "AA"), (2018, 10, None)]
    parts = [F.col("y"), F.col("m"), F.col("c")]
    schema = "y int, m int, c string"
    assert values(spark, fn.business_key(parts), rows, schema) == ["2018|1|AA", None, None]
    safe = values(spark, fn.business_key(parts, null_safe=True), rows, schema)
    assert safe == ["2018|1|AA", "2018||AA", "2018|10|"]


def test_row_hash_tells_apart_nulls_and_separators(spark):
    rows = [(None, "x"), ("x", None), ("null", "x"), ("a|1:b", "c"), ("a", "b|1:c"), ("", "x")]
    keys = values(spark, fn.row_hash_key([F.col("a"), F.col("b")]), rows, "a string, b string")
    assert len(set(keys)) == len(rows)
    assert all(len(key) == 64 for key in keys)


def test_ordinal_key_is_unique(spark):
    keys = spark.range(1000).repartition(4).select(fn.ordinal_key().alias("k"))
    assert keys.distinct().count() == 1000
