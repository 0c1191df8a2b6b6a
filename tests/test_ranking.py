import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from aerolith.operators import ranking
from tests.conftest import rows_of


def dated(spark, rows):
    days = [(None if d is None else dt.date(2018, 1, d), key, v) for d, key, v in rows]
    return spark.createDataFrame(days, "flight_date date, flight_key string, v int").repartition(5)


def test_positions_match_a_sort(spark):
    values = random.Random(1).sample(range(10_000), 500)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    got = rows_of(ranking.with_position(df, [F.col("v").desc()]), "position", "v")
    assert got == sorted(enumerate(sorted(values, reverse=True)), key=repr)


def test_running_totals_match_a_loop(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(5), rng.randrange(9)) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, a int, b int").repartition(6)
    a = b = 0
    expected = []
    for k, x, y in rows:
        a, b = a + x, b + y
        expected.append((k, a, b))
    got = ranking.with_running_totals(df, [F.col("k")], ["a", "b"])
    assert rows_of(got, "k", "total_a", "total_b") == sorted(expected, key=repr)


@pytest.mark.parametrize("n", [0, 1, 7, 20, 33, 59, 60, 100])
def test_first_rows_is_exact_with_one_hot_date_null_keys_and_copies(spark, n):
    """A third of the rows share one date and half of those are copies of one another."""
    rng = random.Random(n)
    rows = [(rng.choice([1, 2, 9, None]), rng.choice([None, "x", f"k{i}"]), i) for i in range(40)]
    rows += [(5, "copy", 0)] * 10 + [(5, None, 7)] * 5 + [(5, f"z{i}", i) for i in range(5)]
    rng.shuffle(rows)
    df = dated(spark, rows)
    head, tail = ranking.first_rows(df, n)
    assert head.count() == min(n, len(rows))
    assert sorted(rows_of(head) + rows_of(tail), key=repr) == rows_of(df)

    def place(row):
        return (row[0] is not None, row[0] or dt.date.min, row[1] is not None, row[1] or "")

    head_rows, tail_rows = head.collect(), tail.collect()
    if head_rows and tail_rows:
        assert max(map(place, head_rows)) <= min(map(place, tail_rows))


def test_time_split_sizes(spark):
    df = dated(spark, [(i % 28 + 1, f"k{i}", i) for i in range(101)])
    train, test = ranking.time_split(df)
    assert (train.count(), test.count()) == (80, 21)
    assert train.agg(F.max("flight_date")).first()[0] <= test.agg(F.min("flight_date")).first()[0]


def test_row_cap(spark):
    df = dated(spark, [(i % 28 + 1, f"k{i}", i) for i in range(50)])
    assert ranking.row_cap(df, None).count() == 50
    expected = sorted((row.flight_date, row.flight_key) for row in df.collect())[:13]
    got = ranking.row_cap(df, 13).select("flight_date", "flight_key").collect()
    assert sorted(map(tuple, got)) == expected
