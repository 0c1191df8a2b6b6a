import json

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from aerolith.operators import bronze
from aerolith.plans import inspect, stages
from aerolith.registry import queries
from aerolith.session import scan_bytes_for, shuffle_partitions_for, size_for
from aerolith.sources import tables
from aerolith.streaming.bronze_stream import stream_bronze
from tests.conftest import rows_of
from tools.check_queries import TABLES, compare

# Quick queries that together touch every layer; tools/check_queries.py runs all of them.
CHECKED = (
    "bronze_load_result",
    "silver_upsert",
    "gold_analytics",
    "gold_features_write",
    "time_travel",
    "z_order",
    "time_split",
    "scan_csv",
    "stream_load",
    "silver_no_dep_time",
    "permutation_importance",
    "bronze_idempotent_rerun",
    "one_hot",
    "preprocessor",
    "classification_metrics",
)


@pytest.fixture(scope="module")
def connection(sf_dir):
    database = duckdb.connect()
    for table in TABLES:
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return database


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, connection, sf_dir, name):
    assert compare(spark, connection, name, sf_dir, entry_point.oracle_sql()[name]).startswith("ok")


def test_entry_and_names(spark):
    assert entry_point.entry(spark).count() > 0
    names = set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= names
    # Only operators of the optional package have no SQL form.
    assert all(name.startswith("op") or name == "pipeline" for name in names - set(entry_point.oracle_sql()))


def source_file(flights, tmp_path, kind="parquet"):
    path = str(tmp_path / f"flights.{kind}")
    source = flights(
        *[
            {"month": i % 3 + 1, "flight_num": str(i), "dep_delay": float(i % 9), "arr_delay": float(i)}
            for i in range(60)
        ],
        {"arr_delay": 1.0, "flight_num": "0"},
    )
    source.drop("seq").coalesce(1).write.option("header", True).format(kind).save(path)
    return path


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_command_line_layers(spark, flights, tmp_path, capsys, kind):
    source, root = source_file(flights, tmp_path, kind), str(tmp_path / "lake")

    def run(*arguments):
        capsys.readouterr()
        stages.main([arguments[0], "--root", root, *arguments[1:]])
        printed = capsys.readouterr().out
        return printed if arguments[0] == "explain" else json.loads(printed)

    loaded = run("bronze", "--input", source)
    assert (loaded["written_rows"], loaded["versions"]) == (61, 3)
    built = run("silver")
    assert (built["output_rows"], built["written_mode"]) == (60, "append")
    first = tables.read_table(spark, f"{root}/{stages.SILVER}").filter("flight_num = '0'").first()
    assert first.arr_delay == 1.0  # the last of two rows with the same key
    assert run("analytics")["rows"] == 5
    assert run("features") == {"rows": 60, "version": 0}
    assert run("features") == {"rows": 60, "version": 1}
    report = run("maintain", "--table", f"{root}/{stages.SILVER}", "--zorder-cols", "carrier", "no_such")
    assert report["time_travel_rows"] == 20
    text = run("explain", "--year", "2018", "--month", "2")
    assert "PushedFilters: [IsNotNull(arr_delay), GreaterThan(arr_delay,15.0)]" in text
    assert "ReadSchema: struct<carrier:string,arr_delay:double>" in text


def test_full_run(spark, flights, tmp_path):
    row = stages.full_run(
        spark, str(tmp_path / "lake"), source_file(flights, tmp_path), rounds=2
    ).first()
    assert (row.bronze_rows, row.silver_rows, row.gold_features_rows) == (61, 60, 60)
    assert (row.bronze_version, row.training_runs) == (2, 4)
    assert (row.source_rows, row.rejected_rows) == (61, 0)


def test_full_run_tells_of_rejected_rows_and_takes_other_folders(spark, flights, tmp_path):
    rows = flights(*[{"month": None if i % 5 == 0 else 1, "flight_num": str(i)} for i in range(25)])
    bronze_path = str(tmp_path / "elsewhere")
    row = stages.run_layers(
        spark, rows, str(tmp_path / "lake"), order_by=["seq"], with_models=False, folders={"bronze": bronze_path}
    ).first()
    assert (row.source_rows, row.bronze_rows, row.rejected_rows) == (25, 20, 5)
    assert bronze.read_bronze(spark, bronze_path).count() == 20


def test_stream_takes_new_files_once(spark, flights, folder):
    arrivals, path, checkpoint = folder("arrivals"), folder("bronze"), folder("checkpoint")
    schema = flights({}).schema

    def arrive(*rows):
        flights(*rows).coalesce(1).write.mode("append").parquet(arrivals)
        query = stream_bronze(
            spark, arrivals, path, checkpoint, schema, file_format="parquet"
        )
        query.awaitTermination()
        return bronze.read_bronze(spark, path).count()

    assert arrive({"month": 1}, {"month": 2}) == 2
    assert arrive({"month": 2}, {"month": 3}) == 4  # a late file of a known month
    assert tables.latest_version(spark, path) == 3
    assert rows_of(bronze.read_bronze(spark, path), "month") == [(1,), (2,), (2,), (3,)]
    with pytest.raises(Exception, match="rejected_rows=1"):
        arrive({"month": None}, {"month": 4})
    assert arrive({"month": 5}) == 6  # the usable row of the failed call is there, once


def test_one_pass_over_the_source(spark, flights, folder):
    passes = spark.sparkContext.accumulator(0)
    source = flights({"month": 1}, {"month": 2}, {"month": None})

    @F.udf("int")
    def counted(value):
        passes.add(1)
        return value

    rows = source.withColumn("seq", counted.asNondeterministic()("seq"))
    result = bronze.append_batches(spark, rows, folder("bronze")).first()
    assert (result.source_rows, result.written_rows, result.rejected_rows) == (3, 2, 1)
    assert passes.value == 3


def test_settings_of_the_user_stay(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000000")
        size_for(spark, 10**15)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "7000000"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_plan_has_no_python_or_cartesian_step(spark, sf_dir):
    for name in ("gold_analytics", "silver_build", "gold_features", "delay_by_carrier"):
        text = inspect.plan_text(entry_point.queries()[name](spark, sf_dir))
        assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions_for(10, 8) == 8
    assert shuffle_partitions_for(10**12, 1000) == 7451
    assert shuffle_partitions_for(100 * 10**12, 1000) == 50_000
    assert scan_bytes_for(10**12) == 128 * 1024 * 1024
    assert scan_bytes_for(100 * 10**12) == 500_000_000


@pytest.mark.parametrize("name", ["bronze_append", "bronze_idempotent_rerun"])
def test_tables_behind_raw_flights_are_joined_once(spark, sf_dir, monkeypatch, name):
    made, make = [], queries.flights_raw
    monkeypatch.setattr(queries, "flights_raw", lambda *args: made.append(args) or make(*args))
    assert queries.QUERIES[name](spark, sf_dir).count() > 0
    assert len(made) == 1
