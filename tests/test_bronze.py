import pytest

from aerolith.operators import bronze, maintenance
from aerolith.sources import tables
from aerolith.sources.files import scan_source
from tests.conftest import rows_of


def test_batches_load_once_and_late_rows_are_skipped(spark, flights, folder):
    path = folder()
    first = flights({"month": 1}, {"month": 2}, {"month": 2})
    result = bronze.append_batches(spark, first, path).first()
    assert result.years_written == [2018]
    assert (result.source_rows, result.written_rows, result.skipped_rows) == (3, 3, 0)
    assert result.versions == 2

    second = flights({"month": 2}, {"month": 3}, {"year": 2019})
    result = bronze.append_batches(spark, second, path).first()
    assert result.years_written == [2018, 2019]
    assert (result.source_rows, result.written_rows, result.skipped_rows) == (3, 2, 1)
    assert result.versions == 4
    assert bronze.read_bronze(spark, path).count() == 5

    result = bronze.append_batches(spark, second, path).first()
    assert (result.written_rows, result.skipped_rows, result.versions) == (0, 3, 4)
    assert result.years_written == []


def test_one_version_per_batch_in_calendar_order(spark, flights, folder):
    path = folder()
    source = flights({"year": 2019, "month": 1}, {"month": 12}, {"month": 2}, {"month": 2})
    bronze.append_batches(spark, source, path)
    history = tables.commits(spark, path)
    assert rows_of(history, "commit_version", "year", "month", "rows", "mode") == [
        (0, 2018, 2, 2, "overwrite"),
        (1, 2018, 12, 1, "append"),
        (2, 2019, 1, 1, "append"),
    ]
    assert [bronze.read_bronze(spark, path, v).count() for v in range(3)] == [2, 3, 4]


def test_rows_without_batch_are_rejected_and_fail_the_check(spark, flights, folder):
    path = folder()
    source = flights({}, {"month": None}, {"year": None}).withColumn(
        "month", bronze.F.expr("CASE WHEN seq = 0 THEN '1' ELSE 'xx' END")
    )
    result = bronze.append_batches(spark, source, path)
    row = result.first()
    assert (row.source_rows, row.written_rows, row.rejected_rows) == (3, 1, 2)
    with pytest.raises(ValueError, match="mismatch"):
        bronze.check_load(result)


def test_source_columns_survive_unchanged(spark, flights, folder):
    path = folder()
    source = flights({}, {"month": 5}).withColumnsRenamed({"year": "YEAR", "month": "Month"})
    bronze.append_batches(spark, source, path)
    stored = bronze.read_bronze(spark, path)
    assert stored.columns == source.columns
    assert rows_of(stored) == rows_of(source)


def test_max_year_and_reset(spark, flights, folder):
    path = folder()
    source = flights({"year": 2017}, {"year": 2018}, {"year": None})
    row = bronze.append_batches(spark, source, path, max_year=2017).first()
    assert (row.source_rows, row.written_rows) == (1, 1)
    row = bronze.append_batches(spark, flights({"year": 2020}), path, reset=True).first()
    assert row.written_rows == 1
    assert rows_of(bronze.read_bronze(spark, path), "year") == [(2020,)]


def test_source_needs_batch_columns_and_years(spark, flights, folder):
    with pytest.raises(ValueError, match="month"):
        bronze.append_batches(spark, flights({}).drop("month"), folder())
    with pytest.raises(ValueError, match="year"):
        bronze.append_batches(spark, flights({"year": None}), folder())


def test_new_source_columns_widen_the_table(spark, flights, folder):
    path = folder()
    bronze.append_batches(spark, flights({}), path)
    wider = flights({"month": 2}).withColumn("tail", bronze.F.lit("N1")).drop("dep_time")
    bronze.append_batches(spark, wider, path)
    stored = bronze.read_bronze(spark, path)
    assert rows_of(stored, "month", "dep_time", "tail") == [(1, 1230, None), (2, None, "N1")]


def test_uncommitted_load_stays_invisible(spark, flights, folder):
    path = folder()
    bronze.append_batches(spark, flights({}), path)
    stray = bronze.with_batch_columns(flights({"month": 7}))
    tables.write_load(stray, path, bronze.BATCH_COLUMNS)
    assert bronze.read_bronze(spark, path).count() == 1
    assert bronze.append_batches(spark, flights({"month": 7}), path).first().written_rows == 1


def test_awkward_source_names(spark, flights, folder):
    path = folder()
    source = flights({}, {"month": 2}).withColumnsRenamed({"carrier": "op.carrier", "dest": "to city"})
    bronze.append_batches(spark, source, path)
    bronze.append_batches(spark, source.withColumn("month", bronze.F.lit(3)), path)
    before = rows_of(bronze.read_bronze(spark, path))
    maintenance.z_order(spark, path, ["op.carrier", "origin"], curve=False)
    maintenance.z_order(spark, path, ["origin", "month"])
    assert rows_of(bronze.read_bronze(spark, path)) == before
    assert len(before) == 4


def csv_source(tmp_path, *lines):
    path = tmp_path / "flights.csv"
    path.write_text("\n".join(("year,month,origin,note", *lines)) + "\n")
    return str(path)


def load_result(spark, source, path):
    return bronze.append_batches(spark, scan_source(spark, source, ingest_order=True), path)


def load_csv(spark, source, path):
    return load_result(spark, source, path).first()


def test_malformed_records_are_put_aside_and_counted(spark, tmp_path, folder):
    broken = ['2018,1', '2018,1,jfk,ok,extra,more', '2018,2,"open,ok', "junk", "junk"]
    lines = ["2018,1,jfk,ok", *broken, "", '2018,2,"a,b",', ",,lax,undated"]
    source, path = csv_source(tmp_path, *lines), folder()
    row = load_csv(spark, source, path)
    counted = (row.source_rows, row.written_rows, row.rejected_rows, row.malformed_rows)
    assert counted == (8, 2, 1, 5)  # a blank line is no record
    kept = bronze.read_quarantine(spark, path)
    assert rows_of(kept, "record") == sorted((text,) for text in broken)
    assert kept.filter("ingest_file LIKE '%flights.csv' AND ingest_row IS NOT NULL").count() == 5
    table = bronze.read_bronze(spark, path)
    assert rows_of(table, "year", "month", "origin", "note") == [(2018, "1", "jfk", "ok"), (2018, "2", "a,b", None)]
    assert "ingest_malformed" not in table.columns


def test_malformed_records_of_a_repeated_source_are_kept_once(spark, tmp_path, folder):
    path = folder()
    load_csv(spark, csv_source(tmp_path, "2018,1,jfk,ok", "short", "short"), path)
    source = csv_source(tmp_path, "2018,1,jfk,ok", "short", "short", "2018,2,jfk,ok", "new,one")
    row = load_csv(spark, source, path)
    assert (row.source_rows, row.written_rows, row.skipped_rows, row.malformed_rows) == (5, 1, 1, 3)
    bronze.check_load(load_result(spark, source, folder()))
    assert rows_of(bronze.read_quarantine(spark, path), "record") == [("new,one",), ("short",), ("short",)]


def test_source_of_malformed_records_alone(spark, tmp_path, folder):
    path = folder()
    with pytest.raises(ValueError, match="no row with a usable year"):
        load_csv(spark, csv_source(tmp_path, "a", "b,c"), path)
    assert rows_of(bronze.read_quarantine(spark, path), "record") == [("a",), ("b,c",)]
    assert bronze.read_quarantine(spark, folder()).isEmpty()


def test_malformed_records_pass_the_year_bound(spark, tmp_path, folder):
    path = folder()
    source = scan_source(spark, csv_source(tmp_path, "2018,1,jfk,ok", "2020,1,jfk,ok", "2020,1"), ingest_order=True)
    row = bronze.append_batches(spark, source, path, max_year=2018).first()
    assert (row.source_rows, row.written_rows, row.malformed_rows) == (2, 1, 1)


def test_rows_without_a_batch_do_not_meet_in_one_task(spark, flights, folder, monkeypatch):
    """The batches a table has are looked up without a shuffle, which would send all null batches to one task."""
    plans, write = [], bronze.tables.write_load

    def watched(rows, *args, **options):
        plans.append(rows._jdf.queryExecution().sparkPlan().toString())
        return write(rows, *args, **options)

    monkeypatch.setattr(bronze.tables, "write_load", watched)
    path = folder()
    for _ in range(2):
        bronze.append_batches(spark, flights({"month": None}, {}), path)
    bronze.batch_status(flights({}), bronze.tables.live_batches(spark, path))
    assert plans and all("BroadcastHashJoin" in plan and "SortMergeJoin" not in plan for plan in plans)
