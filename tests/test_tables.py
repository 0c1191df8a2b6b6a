import random

import pytest
from pyspark.sql import functions as F

from aerolith.operators import clustering, maintenance, silver
from aerolith.plans.inspect import plan_text
from aerolith.session import materialise
from aerolith.sources import tables
from tests.conftest import rows_of

PARTS = ("year", "month")


def batch_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "year int, month int, flight_key string, v double")


def test_versions_and_time_travel(spark, folder):
    path = folder()
    assert tables.latest_version(spark, path) is None
    with pytest.raises(ValueError, match="No table"):
        tables.read_table(spark, path)
    tables.append_load(batch_rows(spark, (2018, 1, "a", 1.0)), path, PARTS)
    tables.append_load(batch_rows(spark, (2018, 2, "b", 2.0)), path, PARTS)
    silver.upsert(spark, path, materialise(batch_rows(spark, (2018, 1, "a", 9.0))))
    first = rows_of(maintenance.time_travel(spark, path, 0))
    tables.overwrite_table(batch_rows(spark, (2020, 5, "z", 0.0)), path, PARTS)
    assert first == rows_of(maintenance.time_travel(spark, path, 0)) == [(2018, 1, "a", 1.0)]
    assert rows_of(maintenance.time_travel(spark, path, 1), "v") == [(1.0,), (2.0,)]
    assert rows_of(maintenance.time_travel(spark, path, 2), "v") == [(2.0,), (9.0,)]
    assert rows_of(tables.read_table(spark, path), "v") == [(0.0,)]
    assert tuple(tables.table_version(spark, path).first()) == (3, 4)
    for missing in (-1, 4):
        with pytest.raises(ValueError, match="versions 0 to 3"):
            maintenance.time_travel(spark, path, missing)


def test_filters_reach_partitions_and_files(spark, folder):
    path = folder()
    tables.append_load(batch_rows(spark, (2018, 1, "a", 1.0), (2019, 1, "b", 2.0)), path, PARTS)
    late = tables.read_table(spark, path).filter("year = 2018 AND v > 0.5").select("flight_key")
    text = plan_text(late)
    assert "PartitionFilters: [isnotnull(year" in text
    assert "GreaterThan(v,0.5)" in text
    assert "ReadSchema: struct<flight_key:string,v:double>" in text
    assert rows_of(late) == [("a",)]


def test_live_folders_are_picked_while_the_query_runs(spark, folder):
    """No list of folders: the entries prune load, year and month of one scan."""
    path = folder()
    tables.append_load(batch_rows(spark, (2018, 1, "a", 1.0), (2019, 1, "b", 2.0)), path, PARTS)
    silver.upsert(spark, path, materialise(batch_rows(spark, (2018, 1, "a", 9.0))))
    table = tables.read_table(spark, path)
    assert "dynamicpruning" in plan_text(table).lower()
    assert rows_of(table, "flight_key", "v") == [("a", 9.0), ("b", 2.0)]
    assert {r.v for r in tables.read_table(spark, path, 0).collect()} == {1.0, 2.0}


def test_other_layouts_of_the_past_are_not_in_the_way(spark, folder):
    path = folder()
    rows = batch_rows(spark, (2018, 1, "a", 1.0), (2018, 2, "b", 2.0))
    tables.overwrite_table(rows, path)
    tables.overwrite_table(rows, path, PARTS)
    assert rows_of(tables.read_table(spark, path)) == rows_of(rows) == rows_of(tables.read_table(spark, path, 0))
    tables.overwrite_table(rows.filter("month = 2"), path)
    assert rows_of(tables.read_table(spark, path), "flight_key") == [("b",)]
    nothing = folder("nothing")
    tables.overwrite_table(rows.filter("false"), nothing, PARTS)
    assert tables.commits(spark, nothing).isEmpty() or tables.read_table(spark, nothing).count() == 0


def test_compaction_merges_files_and_keeps_rows(spark, folder):
    path = folder()
    for i in range(4):
        tables.append_load(batch_rows(spark, (2018, 1, f"k{i}", 1.0), (2018, 1, "copy", 0.0)), path, PARTS)
    tables.append_load(batch_rows(spark, (2018, 2, "alone", 1.0)), path, PARTS)
    before = rows_of(tables.read_table(spark, path))
    report = maintenance.compact(spark, path).first()
    assert (report.batches_rewritten, report.files_before, report.files_after) == (1, 5, 2)
    assert (report.rows, report.version) == (9, 5)
    assert rows_of(tables.read_table(spark, path)) == before
    assert rows_of(maintenance.time_travel(spark, path, 1)) == rows_of(
        batch_rows(spark, *[(2018, 1, f"k{i}", 1.0) for i in range(2)], *[(2018, 1, "copy", 0.0)] * 2)
    )
    again = maintenance.compact(spark, path).first()
    assert (again.batches_rewritten, again.version) == (0, 5)


def test_compaction_of_an_unpartitioned_table(spark, folder):
    path = folder()
    for i in range(3):
        tables.append_load(spark.range(i, i + 1, numPartitions=1), path)
    report = maintenance.compact(spark, path).first()
    assert (report.files_before, report.files_after) == (3, 1)
    assert rows_of(tables.read_table(spark, path)) == [(0,), (1,), (2,)]


def test_vacuum_lists_then_deletes_what_is_not_used(spark, folder):
    path = folder()
    tables.append_load(batch_rows(spark, (2018, 1, "a", 1.0), (2018, 2, "b", 1.0)), path, PARTS)
    silver.upsert(spark, path, materialise(batch_rows(spark, (2018, 1, "a", 2.0))))
    tables.write_load(batch_rows(spark, (2018, 3, "stray", 1.0)), path, PARTS)  # never committed
    assert maintenance.vacuum(spark, path).isEmpty()  # all too young
    listed = maintenance.vacuum(spark, path, retention_hours=0)
    assert rows_of(listed, "month", "commit_version") == [(1, 0), (None, None)]
    current = rows_of(tables.read_table(spark, path))
    files = maintenance.data_files(spark, path).count()
    deleted = maintenance.vacuum(spark, path, dry_run=False, retention_hours=0).count()
    assert maintenance.data_files(spark, path).count() == files - deleted == 2
    assert rows_of(tables.read_table(spark, path)) == current
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        maintenance.time_travel(spark, path, 0)


def test_schema_evolution_rewrites_nothing(spark, folder):
    path = folder()
    tables.append_load(batch_rows(spark, (2018, 1, "a", 1.0)), path, PARTS)
    files = maintenance.data_files(spark, path).count()
    assert tuple(maintenance.evolve_schema(spark, path).first()) == (True, 1)
    assert tuple(maintenance.evolve_schema(spark, path).first()) == (False, 1)
    assert maintenance.data_files(spark, path).count() == files
    tables.append_load(batch_rows(spark, (2018, 2, "b", 1.0)), path, PARTS)
    silver.upsert(
        spark,
        path,
        materialise(batch_rows(spark, (2018, 1, "a", 5.0), (2018, 1, "c", 5.0))),
    )
    got = tables.read_table(spark, path)
    assert rows_of(got, "flight_key", "v", "pipeline_run_id") == [
        ("a", 5.0, "init"),
        ("b", 1.0, None),
        ("c", 5.0, None),
    ]
    assert rows_of(got.filter("pipeline_run_id = 'init'"), "flight_key") == [("a",)]
    assert "pipeline_run_id" not in maintenance.time_travel(spark, path, 0).columns


def test_evolved_value_is_quoted(spark, folder):
    path = folder()
    tables.append_load(batch_rows(spark, (2018, 1, "a", 1.0)), path, PARTS)
    maintenance.evolve_schema(spark, path, "note", "it's a \\ test")
    assert tables.read_table(spark, path).first().note == "it's a \\ test"


def z_by_hand(codes):
    z = 0
    for i, code in enumerate(codes):
        for bit in range(20):
            z |= ((code >> bit) & 1) << (bit * len(codes) + i)
    return z


def test_z_value_interleaves_ranks(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "p", "q", "r"]), rng.randrange(9)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a string, b int")
    ranks = [{None: 0} | {v: i + 1 for i, v in enumerate(sorted({r[c] for r in rows} - {None}))} for c in (0, 1)]
    got = clustering.with_z_value(df, ["a", "b"])
    assert rows_of(got) == sorted(
        [(a, b, z_by_hand((ranks[0][a], ranks[1][b]))) for a, b in rows], key=repr
    )


def test_one_rule_for_codes_at_every_size(spark, monkeypatch):
    for size, ranges, most in ((100_000, 256, 391), (200, 200, 1)):
        df = spark.range(size).withColumn("name", F.format_string("n%06d", "id")).repartition(4)
        coded, bits = clustering.with_codes(df, ["name"])
        codes = [row.c for row in coded.orderBy("name").select(F.col("_code_name").alias("c")).collect()]
        assert codes == sorted(codes)  # order is kept
        assert set(codes) == set(range(1, ranges + 1)) and bits["name"] == ranges.bit_length()
        assert max(codes.count(c) for c in (1, ranges // 2)) == most


def test_appends_widen_or_are_refused(spark, folder):
    path = folder()
    tables.append_load(spark.createDataFrame([(1, 1, 5)], "year int, month int, d int"), path, PARTS)
    tables.append_load(spark.createDataFrame([(1, 1, 5.9)], "year int, month int, d double"), path, PARTS)
    tables.append_load(spark.createDataFrame([(1, 1, 7)], "year int, month int, d int"), path, PARTS)
    assert rows_of(tables.read_table(spark, path), "d") == [(5.0,), (5.9,), (7.0,)]
    with pytest.raises(ValueError, match="Column d"):
        tables.append_load(spark.createDataFrame([(1, 1, "x")], "year int, month int, d string"), path, PARTS)
    assert tables.latest_version(spark, path) == 2
    text = folder()
    tables.append_load(spark.createDataFrame([("x",)], "d string"), text)
    tables.append_load(spark.createDataFrame([(5.9,)], "d double"), text)
    assert rows_of(tables.read_table(spark, text)) == [("5.9",), ("x",)]


def test_upsert_takes_new_columns_and_refuses_repeated_keys(spark, folder):
    path = folder()
    tables.append_load(batch_rows(spark, (2018, 1, "a", 1.0), (2018, 1, "c", 3.0)), path, PARTS)
    source = batch_rows(spark, (2018, 1, "a", 9.0), (2018, 1, "b", 2.0)).withColumn("extra", F.lit("new"))
    silver.upsert(spark, path, materialise(source))
    assert {tuple(r)[-3:] for r in tables.read_table(spark, path).select("flight_key", "v", "extra").collect()} == {
        ("a", 9.0, "new"), ("b", 2.0, "new"), ("c", 3.0, None)
    }
    twice = batch_rows(spark, (2018, 1, "a", 1.0), (2018, 1, "a", 2.0))
    with pytest.raises(ValueError, match="repeat"):
        silver.upsert(spark, path, materialise(twice))


def test_z_order_and_sort_keep_rows(spark, folder):
    path = folder()
    rows = [(2018 + i % 2, i % 3 + 1, f"k{i}", float(i % 5)) for i in range(50)]
    tables.append_load(batch_rows(spark, *rows), path, PARTS)
    before = rows_of(tables.read_table(spark, path))
    report = maintenance.z_order(spark, path, ["year", "v", "nothing"]).first()
    assert (report.method, list(report.columns), report.rows) == ("z_order", ["year", "v"], 50)
    assert rows_of(tables.read_table(spark, path)) == before
    report = maintenance.z_order(spark, path, ["v"], curve=False).first()
    assert report.method == "sort"
    assert rows_of(tables.read_table(spark, path)) == before
    for columns in ([], ["nothing"]):
        report = maintenance.z_order(spark, path, columns).first()
        assert (report.method, report.version) == ("skipped", 2)


def test_maintenance_report(spark, folder):
    path = folder()
    tables.append_load(batch_rows(spark, (2018, 1, "a", 1.0)), path, PARTS)
    tables.append_load(batch_rows(spark, (2018, 1, "b", 1.0)), path, PARTS)
    report = maintenance.maintenance_report(spark, path, columns=["v"]).first()
    assert report.time_travel_rows == 1
    assert '"batches_rewritten": 1' in report.compaction
    assert '"method": "z_order"' in report.z_order
    assert '"dry_run": true' in report.vacuum
    assert report.version_after_schema_evolution == 4
