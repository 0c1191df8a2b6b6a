import random

import pytest
from pyspark.sql import functions as F

from aerolith.operators import bronze, maintenance, silver
from aerolith.plans.inspect import plan_text
from aerolith.session import materialise
from aerolith.sources import tables
from aerolith.sources.files import delete_path
from tests.conftest import rows_of

ORDER = ["seq"]


def build(df, **options):
    return silver.silver_frame(df, order_by=ORDER, **options)


def test_delay_limits(flights):
    delays = [-120.0, -120.1, 360.0, 360.1, 15.0, 15.01, float("nan"), None]
    source = flights(*[{"arr_delay": d, "flight_num": str(i)} for i, d in enumerate(delays)])
    assert rows_of(build(source), "arr_delay", "is_delayed_15") == sorted(
        [(-120.0, 0), (15.0, 0), (15.01, 1), (360.0, 1)], key=repr
    )


def test_bad_dates_and_cancelled_rows_go(flights):
    source = flights(
        {"flight_num": "ok"},
        {"dayofmonth": 30, "month": 2},
        {"month": 0},
        {"month": 13},
        {"dayofmonth": 0},
        {"dayofmonth": 32},
        {"dayofmonth": None},
        {"cancelled": 1},
        {"cancelled": None},
        {"year": None},
    )
    kept = build(source)
    assert rows_of(kept, "flight_num", "day_of_week") == [("ok", 7)]
    assert kept.columns == list(silver.SILVER_COLUMNS)


def test_schema(flights):
    types = dict(build(flights({})).dtypes)
    assert types["is_delayed_15"] == types["day_of_week"] == "tinyint"
    assert types["hour"] == types["year"] == "int"
    assert types["flight_date"] == "date"
    assert types["arr_delay"] == "double"


def test_text_and_missing_columns(flights):
    source = flights({"seq": 1}).select(
        F.lit("2018").alias("YEAR"),
        F.lit("3").alias("MONTH"),
        F.lit("12.5").alias("ArrDelay"),
        F.lit("0").alias("Canceled"),
        "seq",
    )
    row = build(source).first()
    assert (row.year, row.month, row.day_of_month, row.arr_delay) == (2018, 3, 1, 12.5)
    assert (row.carrier, row.origin, row.route, row.hour) == ("UNK", "UNK", "UNK_UNK", 0)
    assert len(row.flight_key) == 64


def test_text_false_is_not_a_number(flights):
    source = flights({}).withColumn("cancelled", F.lit("false"))
    assert build(source).isEmpty()


def test_last_row_of_a_key_wins(flights):
    source = flights({"arr_delay": 1.0}, {"arr_delay": 2.0}, {"arr_delay": 3.0, "cancelled": 1})
    row = build(source).first()
    assert (row.flight_key, row.arr_delay) == ("2018|1|7|AA|10|JFK|LAX|1230", 2.0)


def test_null_key_keeps_one_row_per_batch_unless_null_safe(flights):
    source = flights(
        {"dest": None, "flight_num": "1"},
        {"dep_time": None, "flight_num": "2"},
        {"dest": None, "flight_num": "3", "month": 2},
    )
    assert rows_of(build(source), "month", "flight_num", "flight_key") == [
        (1, "2", None),
        (2, "3", None),
    ]
    safe = build(source, null_safe_key=True)
    assert safe.count() == 3
    assert safe.filter("flight_key IS NULL").isEmpty()


def test_hash_key_includes_delays(flights):
    source = flights({"arr_delay": 1.0}, {"arr_delay": 2.0}, {"arr_delay": 2.0}).drop("flight_num")
    assert build(source).count() == 2


def test_order_is_needed(flights):
    with pytest.raises(ValueError, match="order_by"):
        silver.silver_frame(flights({}))


def test_hot_key_is_reduced_before_the_shuffle(flights):
    text = plan_text(build(flights({})), "simple")
    before_shuffle = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle
    assert "CartesianProduct" not in text and "Python" not in text


def test_dedupe_matches_brute_force_with_a_hot_key(spark):
    """A third of all rows share the null key, another third one ordinary key."""
    rng = random.Random(5)
    rows = []
    for seq in range(3000):
        key = [None, "hot", f"k{rng.randrange(300)}"][seq % 3]
        rows.append((rng.randrange(3), key, seq, rng.random()))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "batch int, key string, seq int, value double").repartition(8)
    best = {}
    for row in rows:
        if (row[0], row[1]) not in best or best[row[0], row[1]][2] < row[2]:
            best[row[0], row[1]] = row
    got = silver.dedupe_keep_last(df, ["batch", "key"], ["seq"])
    assert rows_of(got) == sorted(best.values(), key=repr)


def test_funnel(flights):
    source = flights({}, {"cancelled": 1}, {"arr_delay": None}, {"dayofmonth": 40}, {"arr_delay": 999.0})
    row = silver.clean_funnel(silver.normalise(source)).first()
    assert tuple(row) == (5, 4, 3, 2, 1, 1)


def stored(spark, folder, source, **options):
    bronze_path, path = folder("bronze"), folder("silver")
    bronze.append_batches(spark, source, bronze_path)
    result = silver.build_silver(spark, bronze_path, path, order_by=ORDER, **options)
    return bronze_path, path, result.first()


def test_build_modes(spark, flights, folder):
    bronze_path, path, result = stored(spark, folder, flights({}, {"month": 2, "cancelled": 1}))
    assert tuple(result) == (2, 1, "overwrite", 0)
    bronze.append_batches(spark, flights({"month": 3}), bronze_path)
    result = silver.build_silver(spark, bronze_path, path, order_by=ORDER).first()
    assert tuple(result) == (3, 2, "merge", 2)
    assert tables.read_table(spark, path).count() == 2


def test_first_build_of_several_batches_appends(spark, flights, folder):
    _, _, result = stored(spark, folder, flights({}, {"month": 2}))
    assert tuple(result) == (2, 2, "append", 1)


def test_only_changed_months_are_built_again(spark, flights, folder):
    bronze_path, path, first = stored(spark, folder, flights({}, {"month": 2}, {"month": 4, "cancelled": 1}), changed_only=True)
    assert tuple(first) == (3, 2, "append", 1)

    def again(**options):
        return tuple(silver.build_silver(spark, bronze_path, path, order_by=ORDER, changed_only=True, **options).first())

    assert again() == (0, 0, "skip", 1)  # the month without a usable row is not tried again either
    bronze.append_batches(spark, flights({"month": 2, "flight_num": "late"}), bronze_path, late_rows=True)
    assert again() == (2, 2, "merge", 2)
    bronze.append_batches(spark, flights({"month": 3}), bronze_path)
    assert again() == (1, 1, "append", 3)
    maintenance.compact(spark, bronze_path)
    assert again() == (0, 0, "skip", 3)
    lineage = silver.silver_lineage(spark, path)
    assert rows_of(lineage, "month", "bronze_version", "silver_version") == [(1, 0, 1), (2, 1, 1), (2, 3, 2), (3, 4, 3), (4, 2, 1)]
    assert rows_of(tables.read_table(spark, path), "month", "flight_num") == [(1, "10"), (2, "10"), (2, "late"), (3, "10")]


def test_other_recipes_sources_and_overwritten_tables_build_all_months(spark, flights, folder):
    source = flights({}, {"month": 2})
    bronze_path, path, _ = stored(spark, folder, source, changed_only=True)
    build = silver.build_silver
    other = build(spark, bronze_path, path, order_by=ORDER, changed_only=True, null_safe_key=True).first()
    assert (other.input_rows, other.written_mode) == (2, "merge")
    moved = folder("bronze")
    bronze.append_batches(spark, source, moved)
    assert build(spark, moved, path, order_by=ORDER, changed_only=True).first().written_mode == "merge"
    january = materialise(tables.read_table(spark, path).filter("month = 1"))
    tables.overwrite_table(january, path, silver.PARTITIONS)
    got = build(spark, bronze_path, path, order_by=ORDER, changed_only=True).first()
    assert (got.input_rows, got.written_mode) == (2, "merge")
    assert rows_of(tables.read_table(spark, path), "month") == [(1,), (2,)]
    # A run that dies before its lineage is written builds its months again.
    delete_path(spark, f"{path}/lineage")
    assert build(spark, bronze_path, path, order_by=ORDER, changed_only=True).first().written_mode == "merge"


def test_empty_output(spark, flights, folder):
    bronze_path = folder("bronze")
    bronze.append_batches(spark, flights({"cancelled": 1}), bronze_path)
    with pytest.raises(ValueError, match="empty"):
        silver.build_silver(spark, bronze_path, folder("silver"), order_by=ORDER)


def test_skip_when_nothing_is_left_to_write(spark, flights, folder):
    _, path, _ = stored(spark, folder, flights({}))
    other = folder("bronze")
    bronze.append_batches(spark, flights({"cancelled": 1, "month": 5}), other)
    result = silver.build_silver(spark, other, path, order_by=ORDER).first()
    assert (result.output_rows, result.written_mode, result.version) == (0, "skip", 0)


def test_rerun_changes_nothing_but_null_keys(spark, flights, folder):
    source = flights({}, {"flight_num": "11"}, {"dest": None})
    bronze_path, path, _ = stored(spark, folder, source)
    before = rows_of(tables.read_table(spark, path))
    silver.build_silver(spark, bronze_path, path, order_by=ORDER)
    after = rows_of(tables.read_table(spark, path))
    assert len(after) == len(before) + 1  # the null key matches nothing and is inserted again
    assert set(after) == set(before)

    bronze_path, path, _ = stored(spark, folder, source, null_safe_key=True)
    before = rows_of(tables.read_table(spark, path))
    silver.build_silver(spark, bronze_path, path, order_by=ORDER, null_safe_key=True)
    assert rows_of(tables.read_table(spark, path)) == before


def test_upsert_updates_inserts_and_leaves_other_batches(spark, flights, folder):
    _, path, _ = stored(
        spark,
        folder,
        flights({"flight_num": "1"}, {"flight_num": "2"}, {"flight_num": "3", "month": 2}),
    )
    corrected = flights({"flight_num": "2", "arr_delay": 99.0}, {"flight_num": "4"})
    silver.upsert(spark, path, materialise(build(corrected)))
    expected = [("1", 1, 10.0), ("2", 1, 99.0), ("3", 2, 10.0), ("4", 1, 10.0)]
    assert rows_of(tables.read_table(spark, path), "flight_num", "month", "arr_delay") == expected
    live = tables.live_entries(spark, path)
    assert rows_of(live, "month", "mode", "rows") == [(1, "merge", 3), (2, "append", 1)]
    again = materialise(build(corrected))
    silver.upsert(spark, path, again)
    assert rows_of(tables.read_table(spark, path), "flight_num", "month", "arr_delay") == expected


def test_upsert_of_deduplicated_rows_gives_the_same_table(spark, flights, folder):
    corrected = flights({"flight_num": "2", "arr_delay": 99.0}, {"flight_num": "4"}, {"dest": None})
    got = []
    for options in ({}, {"deduplicated": True}):
        _, path, _ = stored(spark, folder, flights({"flight_num": "1"}, {"flight_num": "2"}, {"dest": None}))
        touched = silver.upsert(spark, path, materialise(build(corrected)), **options)
        got.append((rows_of(tables.read_table(spark, path)), rows_of(touched, "year", "month", "rows")))
    assert got[0] == got[1]
