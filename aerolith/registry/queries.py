"""One query per operator: `name -> f(spark, sf_dir) -> DataFrame`."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith import functions as fn
from aerolith.ml import encoding, features, importance, metrics, models, runs, training
from aerolith.operators import batches, bronze, clustering, gold, maintenance, ranking, silver
from aerolith.plans import inspect, stages
from aerolith.registry.fixtures import ARRIVAL_ORDER, flights_raw
from aerolith.session import materialise, scratch_path, stage
from aerolith.sources import files, tables
from aerolith.sources.columns import COLUMN_NAMES
from aerolith.streaming.bronze_stream import stream_bronze
from aerolith.streaming.silver_stream import stream_silver

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPLIT_YEAR = 1997  # queries that load in two steps take the years up to this one first


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Shared steps ---------------------------------------------------------------------------------


def _normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.normalise(flights_raw(spark, sf_dir), keep=ARRIVAL_ORDER)


def _shifted_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days moved by three, which makes impossible days and dates."""
    return _normal(spark, sf_dir).withColumn("day_of_month", F.col("day_of_month") + 3)


def _silver(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return silver.silver_frame(flights_raw(spark, sf_dir), order_by=ARRIVAL_ORDER, **options)


def _later(df: DataFrame) -> DataFrame:
    return df.filter(F.col("year") > SPLIT_YEAR)


def _delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw flights as files, for queries that load them more than once: the tables behind them are joined once."""
    return stage(flights_raw(spark, sf_dir))[0]


def _stored_bronze(spark: SparkSession, raw: DataFrame, **options) -> str:
    path = scratch_path(spark, "bronze")
    bronze.append_batches(spark, raw, path, **options)
    return path


def _stored_silver(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "silver")
    silver.append_new_batches(spark, path, _silver(spark, sf_dir))
    return path


def _stored_features(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "features")
    gold.write_features(spark, _stored_silver(spark, sf_dir), path)
    return path


def _split_silver(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Train and test part of Silver, where inputs still have nulls."""
    path = _stored_silver(spark, sf_dir)
    return ranking.time_split(tables.read_table(spark, path))


def _split_features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    path = _stored_features(spark, sf_dir)
    return ranking.time_split(tables.read_table(spark, path))


# Scans and sources ----------------------------------------------------------------------------


@query
def scan_parquet(spark, sf_dir):
    shipped = files.scan_source(spark, f"{sf_dir}/lineitem.parquet")
    return shipped.withColumn("l_shipdate", F.to_date("l_shipdate"))


@query
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "flights.csv")
    raw = flights_raw(spark, sf_dir)
    raw.write.option("header", True).csv(path)
    return files.scan_source(spark, path)


@query
def list_batches(spark, sf_dir):
    return batches.list_batches(flights_raw(spark, sf_dir))


@query
def batch_counts(spark, sf_dir):
    return batches.batch_counts(flights_raw(spark, sf_dir))


# Bronze ---------------------------------------------------------------------------------------


@query
def bronze_append(spark, sf_dir):
    """Two loads, the second adding what the first left out."""
    raw = _delivered(spark, sf_dir)
    path = _stored_bronze(spark, raw, max_year=SPLIT_YEAR)
    bronze.append_batches(spark, raw, path)
    return bronze.read_bronze(spark, path)


@query
def bronze_idempotent_rerun(spark, sf_dir):
    """Fate of each batch in a second load, and the rows the table has after a third."""
    raw = _delivered(spark, sf_dir)
    path = _stored_bronze(spark, raw, max_year=SPLIT_YEAR)
    status = materialise(bronze.batch_status(raw, tables.live_batches(spark, path)))
    for _ in range(2):
        bronze.append_batches(spark, raw, path)
    stored = batches.batch_counts(bronze.read_bronze(spark, path)).select(
        "year", "month", F.col("rows").alias("stored_rows")
    )
    return status.join(stored, ["year", "month"])


@query
def bronze_load_result(spark, sf_dir):
    raw = _delivered(spark, sf_dir)
    path = _stored_bronze(spark, raw, max_year=SPLIT_YEAR)
    result = bronze.append_batches(spark, raw, path)
    years = F.array_join(F.col("years_written").cast("array<string>"), ",")
    return result.withColumn("years_written", years)


@query
def bronze_reconcile(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    result = bronze.append_batches(spark, flights_raw(spark, sf_dir), path)
    bronze.check_load(result)
    return bronze.reconcile(result).drop("years_written")


@query
def bronze_max_year(spark, sf_dir):
    return bronze.read_bronze(spark, _stored_bronze(spark, flights_raw(spark, sf_dir), max_year=SPLIT_YEAR))


@query
def bronze_reset(spark, sf_dir):
    """A load that replaces what earlier loads left."""
    raw = _delivered(spark, sf_dir)
    path = _stored_bronze(spark, raw)
    bronze.append_batches(spark, raw, path, max_year=SPLIT_YEAR, reset=True)
    return batches.batch_counts(bronze.read_bronze(spark, path))


@query
def bronze_quarantine(spark, sf_dir):
    """Rows per month of a CSV source loaded twice, some of whose records have too few or too many values."""
    raw = flights_raw(spark, sf_dir)
    source, path = scratch_path(spark, "flights.csv"), scratch_path(spark, "bronze")
    number = F.col("l_linenumber")
    for lines in (
        raw.filter(~number.isin(4, 5)),
        raw.filter(number == 4).select("Year", "Month", "DayofMonth"),
        raw.filter(number == 5).select("*", F.lit("more"), F.lit("of it")),
    ):
        lines.write.mode("append").option("header", True).csv(source)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in raw.columns])
    for _ in range(2):
        scanned = files.scan_csv(spark, source, schema, malformed=True)
        bronze.append_batches(spark, files.with_ingest_order(scanned, "csv"), path)
    values = F.split("record", ",")
    put_aside = bronze.read_quarantine(spark, path).select(
        F.when(F.size(values) < len(raw.columns), "short").otherwise("long").alias("kind"),
        values[0].cast("int").alias("year"),
        values[1].cast("int").alias("month"),
    )
    loaded = bronze.read_bronze(spark, path).select(
        F.lit("sound").alias("kind"), F.col("Year").alias("year"), F.col("Month").cast("int").alias("month")
    )
    return loaded.unionByName(put_aside).groupBy("kind", "year", "month").agg(F.count("*").alias("rows"))


@query
def stream_load(spark, sf_dir):
    """Two deliveries that share most months, and a call that finds nothing new."""
    folder = scratch_path(spark, "arrivals.parquet")
    raw = flights_raw(spark, sf_dir)
    path, checkpoint = scratch_path(spark, "bronze"), scratch_path(spark, "checkpoint")
    for arriving in (F.col("l_linenumber") > 2, F.col("l_linenumber") <= 2, None):
        if arriving is not None:
            raw.filter(arriving).write.mode("append").parquet(folder)
        stream_bronze(spark, folder, path, checkpoint, raw.schema).awaitTermination()
    return bronze.read_bronze(spark, path)


# Normalisation --------------------------------------------------------------------------------


@query
def resolve_columns(spark, sf_dir):
    """The last accepted name of every column, in capitals."""
    raw = flights_raw(spark, sf_dir)
    by_lower = {name.lower(): name for name in raw.columns}
    for names in COLUMN_NAMES.values():
        current = next(by_lower[name] for name in names if name in by_lower)
        raw = raw.withColumnRenamed(current, names[-1].upper())
    return silver.normalise(raw, keep=ARRIVAL_ORDER)


@query
def safe_casts(spark, sf_dir):
    """Numbers arriving as text, some of them unusable."""
    raw = flights_raw(spark, sf_dir)
    line = F.col("l_linenumber")
    text = {name: F.col(name).cast("string") for name in ("Year", "Month", "dep_time", "cancelled")}
    dirty = raw.withColumns(
        {
            "Year": F.when(line == 1, F.concat(text["Year"], F.lit(".0"))).otherwise(text["Year"]),
            "Month": F.when(line == 2, "xx").otherwise(text["Month"]),
            "dep_time": F.when(line == 3, "").otherwise(text["dep_time"]),
            "cancelled": F.when(line == 4, "false").otherwise(text["cancelled"]),
            "arr_delay": F.when(line == 5, "late").otherwise(F.col("arr_delay").cast("string")),
            "DayofMonth": F.col("DayofMonth") + F.lit(0.7),
        }
    )
    return silver.normalise(dirty, keep=ARRIVAL_ORDER)


@query
def default_columns(spark, sf_dir):
    raw = flights_raw(spark, sf_dir).select("Year", "Month", "arr_delay", *ARRIVAL_ORDER)
    return silver.normalise(raw, keep=ARRIVAL_ORDER)


# Filters --------------------------------------------------------------------------------------


@query
def filter_cancelled(spark, sf_dir):
    return silver.clean(_normal(spark, sf_dir), "cancelled")


@query
def filter_required(spark, sf_dir):
    """Delays above 200 count as unknown here."""
    rows = _normal(spark, sf_dir)
    known = F.when(F.col("arr_delay") <= 200, F.col("arr_delay"))
    return silver.clean(rows.withColumn("arr_delay", known), "required")


@query
def filter_calendar(spark, sf_dir):
    return silver.clean(_shifted_days(spark, sf_dir), "calendar")


@query
def filter_outliers(spark, sf_dir):
    return silver.clean(_normal(spark, sf_dir), "outliers")


@query
def filter_valid_date(spark, sf_dir):
    return silver.clean(_shifted_days(spark, sf_dir), "valid_date")


@query
def filter_batch(spark, sf_dir):
    path = _stored_silver(spark, sf_dir)
    return batches.only_batch(tables.read_table(spark, path), SPLIT_YEAR, 3)


@query
def filter_non_null_target(spark, sf_dir):
    rows = _normal(spark, sf_dir)
    known = F.when(F.col("arr_delay") <= 200, F.col("arr_delay"))
    return gold.with_target(rows.withColumn("arr_delay", known))


@query
def clean_funnel(spark, sf_dir):
    return silver.clean_funnel(_shifted_days(spark, sf_dir))


# Scalar functions -----------------------------------------------------------------------------


@query
def season(spark, sf_dir):
    return _normal(spark, sf_dir).select(
        *ARRIVAL_ORDER, "month", fn.season(F.col("month")).alias("season")
    )


@query
def dep_hour(spark, sf_dir):
    return _normal(spark, sf_dir).select(
        *ARRIVAL_ORDER, "dep_time_raw", fn.departure_hour(F.col("dep_time_raw")).alias("hour")
    )


@query
def flight_date(spark, sf_dir):
    date = fn.flight_date(F.col("year"), F.col("month"), F.col("day_of_month"))
    return _shifted_days(spark, sf_dir).select(
        *ARRIVAL_ORDER, "year", "month", "day_of_month", date.alias("flight_date")
    )


@query
def day_of_week(spark, sf_dir):
    date = fn.flight_date(F.col("year"), F.col("month"), F.col("day_of_month"))
    return _normal(spark, sf_dir).select(
        *ARRIVAL_ORDER, date.alias("flight_date"), fn.iso_weekday(date).alias("day_of_week")
    )


@query
def route(spark, sf_dir):
    rows = silver.derive_features(_normal(spark, sf_dir))
    return rows.select(*ARRIVAL_ORDER, "origin", "dest", "route")


@query
def is_delayed_15(spark, sf_dir):
    rows = silver.derive_features(_normal(spark, sf_dir))
    return rows.select(*ARRIVAL_ORDER, "arr_delay", "is_delayed_15")


@query
def upper_codes(spark, sf_dir):
    return _normal(spark, sf_dir).select(*ARRIVAL_ORDER, "carrier", "origin", "dest")


@query
def business_key(spark, sf_dir):
    rows = _normal(spark, sf_dir)
    parts = [F.col(name) for name in silver.KEY_PARTS]
    return rows.select(
        *ARRIVAL_ORDER,
        fn.business_key(parts).alias("flight_key"),
        fn.business_key(parts, null_safe=True).alias("null_safe_key"),
    )


@query
def row_hash_key(spark, sf_dir):
    rows = silver.with_flight_key(_normal(spark, sf_dir), from_business=False)
    return rows.select(*ARRIVAL_ORDER, "flight_key")


@query
def row_ordinal_key(spark, sf_dir):
    keys = flights_raw(spark, sf_dir).select(fn.ordinal_key().alias("key"))
    return keys.agg(F.count("*").alias("n_rows"), F.countDistinct("key").alias("n_keys"))


@query
def fill_nulls(spark, sf_dir):
    rows = silver.derive_features(_normal(spark, sf_dir)).select(
        *ARRIVAL_ORDER, *gold.FEATURE_FILLS
    )
    return rows.fillna(gold.FEATURE_FILLS)


# Silver ---------------------------------------------------------------------------------------


@query
def dedupe_keep_last(spark, sf_dir):
    rows = silver.with_flight_key(_normal(spark, sf_dir), from_business=True)
    picked = silver.dedupe_keep_last(rows, ["year", "month", "flight_key"], ARRIVAL_ORDER)
    return picked.select(*ARRIVAL_ORDER, "flight_key")


@query
def silver_build(spark, sf_dir):
    return _silver(spark, sf_dir)


@query
def silver_null_safe_key(spark, sf_dir):
    return _silver(spark, sf_dir, null_safe_key=True)


@query
def silver_hash_key(spark, sf_dir):
    """A source without flight numbers is keyed by a hash over values."""
    raw = flights_raw(spark, sf_dir).drop("flight_num")
    return silver.silver_frame(raw, order_by=ARRIVAL_ORDER)


@query
def silver_no_dep_time(spark, sf_dir):
    """A source without departure times: they are no part of the key."""
    raw = flights_raw(spark, sf_dir).drop("dep_time")
    return silver.silver_frame(raw, order_by=ARRIVAL_ORDER)


@query
def silver_first_write(spark, sf_dir):
    bronze_path, path = _stored_bronze(spark, flights_raw(spark, sf_dir)), scratch_path(spark, "silver")
    silver.build_silver(spark, bronze_path, path, order_by=ARRIVAL_ORDER)
    return tables.read_table(spark, path)


@query
def silver_append(spark, sf_dir):
    path = scratch_path(spark, "silver")
    silver.append_new_batches(spark, path, _silver(spark, sf_dir, max_year=SPLIT_YEAR))
    silver.append_new_batches(spark, path, _later(_silver(spark, sf_dir)))
    return tables.read_table(spark, path)


@query
def silver_upsert(spark, sf_dir):
    """A table of later delays (some too late to be kept), then corrected by the true ones."""
    late = flights_raw(spark, sf_dir).withColumn("arr_delay", F.col("arr_delay") + 200)
    path = scratch_path(spark, "silver")
    silver.append_new_batches(spark, path, silver.silver_frame(late, order_by=ARRIVAL_ORDER))
    silver.upsert(spark, path, materialise(_silver(spark, sf_dir, max_year=SPLIT_YEAR)))
    return tables.read_table(spark, path)


@query
def silver_stream(spark, sf_dir):
    """Three deliveries: all flights with delays too high, the true delays of some years, and those once more."""
    folder = scratch_path(spark, "arrivals.parquet")
    path, checkpoint = scratch_path(spark, "silver"), scratch_path(spark, "checkpoint")
    raw = _delivered(spark, sf_dir)
    late = raw.withColumn("arr_delay", F.col("arr_delay") + 200)
    corrected = raw.filter(F.col("Year") <= SPLIT_YEAR)
    for arriving in (late, corrected, corrected):
        arriving.orderBy(*ARRIVAL_ORDER).write.mode("append").parquet(folder)
        stream_silver(spark, folder, path, checkpoint, raw.schema).awaitTermination()
    return tables.read_table(spark, path)


@query
def silver_build_result(spark, sf_dir):
    """A rerun after more Bronze arrived: old batches merge, new ones are added."""
    raw = _delivered(spark, sf_dir)
    bronze_path = _stored_bronze(spark, raw, max_year=SPLIT_YEAR)
    path = scratch_path(spark, "silver")
    silver.build_silver(spark, bronze_path, path, order_by=ARRIVAL_ORDER)
    bronze.append_batches(spark, raw, bronze_path)
    return silver.build_silver(spark, bronze_path, path, order_by=ARRIVAL_ORDER)


@query
def silver_changed_months(spark, sf_dir):
    """How often each month was written in four builds of changed months only: late rows of one month come before the
    second, new years before the third, a new layout of Bronze before the fourth, which has nothing to do."""
    raw = _delivered(spark, sf_dir)
    late = (F.col("Year") == SPLIT_YEAR) & (F.col("Month") == 3) & (F.col("l_linenumber") > 2)
    bronze_path, path = scratch_path(spark, "bronze"), scratch_path(spark, "silver")

    def build():
        return silver.build_silver(spark, bronze_path, path, order_by=ARRIVAL_ORDER, changed_only=True).first()

    bronze.append_batches(spark, raw.filter(~late), bronze_path, max_year=SPLIT_YEAR)
    build()
    bronze.append_batches(spark, raw.filter(late), bronze_path, late_rows=True)
    second = build()
    bronze.append_batches(spark, raw, bronze_path)
    build()
    maintenance.compact(spark, bronze_path)
    fourth = build()
    writes = tables.commits(spark, path).groupBy("year", "month").agg(F.count("*").alias("writes"))
    return (
        tables.live_batches(spark, path)
        .join(writes, ["year", "month"])
        .withColumns(
            {
                "late_mode": F.lit(second.written_mode),
                "late_input_rows": F.lit(second.input_rows).cast("bigint"),
                "last_mode": F.lit(fourth.written_mode),
                "last_input_rows": F.lit(fourth.input_rows).cast("bigint"),
            }
        )
    )


# Gold -----------------------------------------------------------------------------------------


@query
def gold_analytics(spark, sf_dir):
    return gold.analytics(_silver(spark, sf_dir))


@query
def delay_by_airport(spark, sf_dir):
    return gold.delay_by(_silver(spark, sf_dir), "airport")


@query
def delay_by_carrier(spark, sf_dir):
    return gold.delay_by(_silver(spark, sf_dir), "carrier")


@query
def delay_by_hour(spark, sf_dir):
    return gold.delay_by(_silver(spark, sf_dir), "hour")


@query
def delay_by_season(spark, sf_dir):
    return gold.delay_by(_silver(spark, sf_dir), "season")


@query
def union_relaxed(spark, sf_dir):
    """Whole hours and fractional delays in one column."""
    rows = _silver(spark, sf_dir)
    stacked = gold.union_relaxed(
        rows.select(F.lit("hour").alias("kind"), F.col("hour").alias("value")),
        rows.select(F.col("dep_delay").alias("value"), F.lit("dep_delay").alias("kind")),
        rows.select(F.lit("is_delayed_15").alias("kind"), F.col("is_delayed_15").alias("value")),
    )
    return stacked.groupBy("kind").agg(
        F.count("*").alias("n_rows"), F.sum("value").alias("sum_value")
    )


@query
def carrier_avg_delay(spark, sf_dir):
    path = _stored_silver(spark, sf_dir)
    return gold.carrier_average_delay(tables.read_table(spark, path), SPLIT_YEAR)


@query
def carrier_avg_delay_month(spark, sf_dir):
    path = _stored_silver(spark, sf_dir)
    return gold.carrier_average_delay(tables.read_table(spark, path), SPLIT_YEAR, 1)


@query
def gold_features(spark, sf_dir):
    return gold.feature_frame(_silver(spark, sf_dir))


@query
def gold_features_write(spark, sf_dir):
    return tables.read_table(spark, _stored_features(spark, sf_dir))


@query
def gold_analytics_write(spark, sf_dir):
    path = scratch_path(spark, "analytics")
    gold.write_analytics(spark, _stored_silver(spark, sf_dir), path)
    return tables.read_table(spark, path)


@query
def explain_query(spark, sf_dir):
    """What the plan of the example query shows: filters at the scan, two data columns read."""
    text = inspect.explain_carrier_average(spark, _stored_silver(spark, sf_dir), SPLIT_YEAR, 1)
    lines = text.splitlines()

    def line(label: str) -> str:
        return next((one for one in lines if one.startswith(label)), "")

    return spark.range(1).select(
        F.lit("year" in line("PartitionFilters") and "month" in line("PartitionFilters")).alias(
            "partition_filters"
        ),
        F.lit("GreaterThan(arr_delay,15.0)" in line("PushedFilters")).alias("pushed_filter"),
        F.lit(line("ReadSchema").removeprefix("ReadSchema: ")).alias("read_schema"),
    )


# Versioned tables -----------------------------------------------------------------------------


@query
def time_travel(spark, sf_dir):
    """The table as it was before later years were added and delays corrected."""
    path = scratch_path(spark, "silver")
    late = flights_raw(spark, sf_dir).withColumn("arr_delay", F.col("arr_delay") + 100)
    first = silver.silver_frame(late, order_by=ARRIVAL_ORDER, max_year=SPLIT_YEAR)
    silver.append_new_batches(spark, path, first)
    version = tables.latest_version(spark, path)
    silver.append_new_batches(spark, path, _later(_silver(spark, sf_dir)))
    silver.upsert(spark, path, materialise(_silver(spark, sf_dir, max_year=SPLIT_YEAR)))
    return maintenance.time_travel(spark, path, version)


@query
def table_version(spark, sf_dir):
    return tables.table_version(spark, _stored_bronze(spark, flights_raw(spark, sf_dir)))


@query
def compact(spark, sf_dir):
    """Every batch arrives in two parts, then has its files merged."""
    path = scratch_path(spark, "silver")
    rows = _silver(spark, sf_dir)
    for late in (1, 0):
        tables.append_load(rows.filter(F.col("is_delayed_15") == late), path, silver.PARTITIONS)
    maintenance.compact(spark, path)
    return tables.read_table(spark, path)


@query
def compact_report(spark, sf_dir):
    path = scratch_path(spark, "silver")
    rows = _silver(spark, sf_dir)
    for late in (1, 0):
        tables.append_load(rows.filter(F.col("is_delayed_15") == late), path, silver.PARTITIONS)
    report = maintenance.compact(spark, path)
    return report.select(
        "batches_rewritten", (F.col("files_after") < F.col("files_before")).alias("fewer"), "rows"
    )


@query
def z_order(spark, sf_dir):
    rows = _silver(spark, sf_dir)
    return clustering.with_z_value(rows, maintenance.Z_ORDER_COLUMNS)


@query
def z_order_rewrite(spark, sf_dir):
    path = _stored_silver(spark, sf_dir)
    maintenance.z_order(spark, path)
    return tables.read_table(spark, path)


@query
def sort_cluster(spark, sf_dir):
    path = _stored_silver(spark, sf_dir)
    maintenance.z_order(spark, path, ("origin", "no_such_column", "carrier"), curve=False)
    return tables.read_table(spark, path)


@query
def vacuum(spark, sf_dir):
    """Batches whose first files a correction has replaced."""
    path = _stored_silver(spark, sf_dir)
    silver.upsert(spark, path, materialise(_silver(spark, sf_dir, max_year=SPLIT_YEAR)))
    return maintenance.vacuum(spark, path, retention_hours=0).select("year", "month").distinct()


@query
def schema_evolution(spark, sf_dir):
    """Rows from before the new column read as its value, rows added later have none."""
    path = scratch_path(spark, "silver")
    silver.append_new_batches(spark, path, _silver(spark, sf_dir, max_year=SPLIT_YEAR))
    for _ in range(2):
        maintenance.evolve_schema(spark, path)
    silver.append_new_batches(spark, path, _later(_silver(spark, sf_dir)))
    return tables.read_table(spark, path)


@query
def maintenance_report(spark, sf_dir):
    report = maintenance.maintenance_report(spark, _stored_silver(spark, sf_dir))

    def number(document: str, field: str):
        return F.get_json_object(document, f"$.{field}").cast("bigint")

    return report.select(
        "time_travel_rows",
        number("compaction", "rows").alias("compaction_rows"),
        number("z_order", "rows").alias("z_order_rows"),
        number("vacuum", "retention_hours").alias("retention_hours"),
    )


# Models ---------------------------------------------------------------------------------------


@query
def ml_matrix(spark, sf_dir):
    return features.model_matrix(gold.feature_frame(_silver(spark, sf_dir)), features.LATE_TARGET)


@query
def ml_row_cap(spark, sf_dir):
    return ranking.row_cap(features.load_features(spark, _stored_features(spark, sf_dir)), 3000)


@query
def time_split(spark, sf_dir):
    train, test = _split_features(spark, sf_dir)
    columns = ("flight_key", "flight_date", "route", "arr_delay")
    return train.select(*columns, F.lit("train").alias("part")).unionByName(
        test.select(*columns, F.lit("test").alias("part"))
    )


@query
def impute_median(spark, sf_dir):
    train, _ = _split_silver(spark, sf_dir)
    return encoding.medians(train).withColumnRenamed("column", "feature")


@query
def impute_mode(spark, sf_dir):
    train, _ = _split_silver(spark, sf_dir)
    found = encoding.modes(encoding.ranked_categories(train))
    return found.select(F.col("column").alias("feature"), F.col("mode").alias("most_frequent"))


@query
def one_hot(spark, sf_dir):
    train, _ = _split_silver(spark, sf_dir)
    slots = encoding.one_hot_slots(encoding.ranked_categories(train))
    return slots.select(
        F.col("column").alias("feature"), "value", F.col("rows").alias("n_rows"), "slot"
    )


@query
def preprocessor(spark, sf_dir):
    """Test rows imputed and encoded with what the training rows taught."""
    train, test = _split_silver(spark, sf_dir)
    encoder = encoding.FeatureEncoder.fit(train)
    prepared = encoder.prepare(test)
    vectors = Pipeline(stages=encoder.vector_stages()).fit(prepared).transform(prepared)
    hot = F.lit(0.0)
    for name in features.CATEGORICAL_FEATURES:
        one = vector_to_array(F.col(f"{name}_vector"))
        hot = hot + F.aggregate(one, F.lit(0.0), lambda total, x: total + x)
    return vectors.select(
        "flight_key",
        "flight_date",
        "arr_delay",
        *features.NUMERIC_FEATURES,
        *[f"{name}_slot" for name in features.CATEGORICAL_FEATURES],
        hot.cast("int").alias("hot"),
    )


def _fitted(spark, sf_dir, name: str) -> tuple[models.DelayModel, DataFrame, DataFrame]:
    """A fitted model, the prepared training rows and the test rows."""
    train, test = _split_features(spark, sf_dir)
    encoder = encoding.FeatureEncoder.fit(train)
    prepared = materialise(encoder.prepare(train))
    model = models.DelayModel.fit(name, prepared, encoder, train_rows=prepared.count())
    return model, prepared, test


def _sizes(prepared: DataFrame, test: DataFrame) -> list:
    return [
        F.lit(part.count()).cast("bigint").alias(name)
        for name, part in (("n_train", prepared), ("n_test", test))
    ]


def _balanced(scored: DataFrame, error, limit: float):
    """Whether the errors sum to nothing, by themselves and against each numeric input."""
    sums = [F.abs(F.avg(error)) < limit]
    for name in features.NUMERIC_FEATURES:
        scale = F.greatest(F.max(F.abs(F.col(name))), F.lit(1.0))
        sums.append(F.abs(F.avg(error * F.col(name))) < limit * scale)
    return scored.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()


@query
def fit_linear(spark, sf_dir):
    """The normal equations hold, and a fit with one input has the slope and intercept SQL gives."""
    model, prepared, test = _fitted(spark, sf_dir, "linear_regression")
    held = _balanced(model.score_prepared(prepared), F.col("arr_delay") - F.col("predicted"), 1e-3)
    one = VectorAssembler(inputCols=["dep_delay"], outputCol="features").transform(prepared)
    line = models.linear_regression(prepared.count(), 0).fit(one.select("features", "arr_delay"))
    return spark.range(1).select(
        *_sizes(prepared, test),
        F.lit(all(held)).alias("residuals_balanced"),
        F.lit(round(float(line.coefficients[0]), 4)).alias("slope"),
        F.lit(round(line.intercept, 3)).alias("intercept"),
        F.lit(model.score(test).filter("predicted IS NULL").isEmpty()).alias("all_scored"),
    )


@query
def fit_logistic(spark, sf_dir):
    """The score equations hold."""
    model, prepared, test = _fitted(spark, sf_dir, "logistic_regression")
    held = _balanced(
        model.score_prepared(prepared), F.col("is_delayed_15") - F.col("probability"), 5e-3
    )
    in_range = F.col("probability").between(0.0, 1.0)
    return spark.range(1).select(
        *_sizes(prepared, test),
        F.lit(all(held)).alias("scores_balanced"),
        F.lit(model.score(test).filter(~in_range).isEmpty()).alias("probabilities_valid"),
    )


def _boosted(spark, sf_dir, name: str) -> DataFrame:
    """Training loss falls round by round and ends below that of the best constant."""
    model, prepared, test = _fitted(spark, sf_dir, name)
    *stages_, boosted = model.pipeline.stages
    vectors = PipelineModel(stages_).transform(prepared).select("features", model.target)
    target = F.col(model.target).cast("double")
    data = materialise(vectors.select("features", target.alias(model.target)))
    loss = "squared" if model.target == features.DELAY_TARGET else "logistic"
    losses = boosted.evaluateEachIteration(data, *(["squared"] if loss == "squared" else []))
    share = data.agg(F.avg(model.target)).first()[0]
    if loss == "squared":
        constant = data.agg(F.var_pop(model.target)).first()[0]
    else:  # Spark's log loss is twice the usual one
        constant = -2 * (share * math.log(share) + (1 - share) * math.log(1 - share))
    return spark.range(1).select(
        *_sizes(prepared, test),
        F.lit(all(b <= a + 1e-9 for a, b in zip(losses, losses[1:]))).alias("loss_falls"),
        F.lit(losses[-1] < constant).alias("beats_constant"),
        F.lit(0 < len(losses) <= models.BOOSTING_ROUNDS).alias("rounds_valid"),
    )


@query
def fit_gbt_reg(spark, sf_dir):
    return _boosted(spark, sf_dir, "hgb_regressor")


@query
def fit_gbt_cls(spark, sf_dir):
    return _boosted(spark, sf_dir, "gb_classifier")


def _rule_scores(spark, sf_dir) -> DataFrame:
    """Scores from a fixed rule, so that SQL can tell what the metrics must be."""
    delay = F.coalesce(F.col("dep_delay"), F.lit(0.0))
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (delay + 20.0) / 64.0))
    return _silver(spark, sf_dir).select(
        "flight_key",
        "flight_date",
        "arr_delay",
        (delay + 100.0).alias("predicted"),
        share.alias("probability"),
        "is_delayed_15",
    )


@query
def predict_threshold(spark, sf_dir):
    return _rule_scores(spark, sf_dir).withColumn(
        "label", metrics.predicted_label(F.col("probability"))
    )


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(name, 9).alias(name) for name in df.columns])


@query
def regression_metrics(spark, sf_dir):
    scored = _rule_scores(spark, sf_dir)
    return _rounded(metrics.regression_metrics(scored, actual="arr_delay"))


@query
def classification_metrics(spark, sf_dir):
    scored = _rule_scores(spark, sf_dir)
    return _rounded(metrics.classification_metrics(scored, actual="is_delayed_15"))


@query
def permutation_importance(spark, sf_dir):
    """Importance for a fixed rule on all test rows, so that SQL can tell what it must be."""
    _, test = _split_features(spark, sf_dir)
    late_carrier = F.when(F.col("carrier") < "BRAND#3", 10.0).otherwise(0.0)
    rule = F.col("dep_delay") * 2 + F.col("month") * 3 + F.col("hour") + late_carrier + 60

    found = importance.permutation_importance(
        lambda rows: rows.withColumn("predicted", rule), test, features.DELAY_TARGET
    )
    return found.withColumn("importance", F.round("importance", 9))


@query
def save_model(spark, sf_dir):
    """A model saved, loaded again and asked for the same predictions."""
    model, _, test = _fitted(spark, sf_dir, "logistic_regression")
    path = scratch_path(spark, "model")
    model.save(path)
    again = models.DelayModel.load(spark, path, model.target)
    slots = [f"{name}_slot" for name in features.CATEGORICAL_FEATURES]
    before = model.score(test).withColumnRenamed("probability", "before").drop("predicted", *slots)
    scored = again.score(before)
    same = (F.col("before") - F.col("probability")) == 0.0
    return scored.agg(F.count("*").alias("n_rows"), F.count_if(same).alias("n_same"))


def _run_summary(logged: DataFrame) -> DataFrame:
    return logged.select(
        "run_name",
        F.col("params")["target"].alias("target"),
        F.col("params")["train_rows"].cast("bigint").alias("train_rows"),
        F.col("params")["test_rows"].cast("bigint").alias("test_rows"),
        F.size("importances").alias("n_importances"),
        F.size("metrics").alias("n_metrics"),
    )


def _checked_runs(spark, path: str, runs_path: str, logged: DataFrame) -> DataFrame:
    """The summary, and whether the logged metrics are those of the saved model on the test rows."""
    _, test = ranking.time_split(tables.read_table(spark, path))
    same = {}
    for run in logged.collect():  # two models
        model = models.DelayModel.load(spark, run.model_path, run.params["target"])
        scored = model.score(test).withColumn("actual", F.col(model.target))
        delays = model.target == features.DELAY_TARGET
        measure = metrics.regression_metrics if delays else metrics.classification_metrics
        again = measure(scored).first().asDict()
        same[run.run_name] = all(math.isclose(run.metrics[k], v, rel_tol=1e-9) for k, v in again.items())
    verdict = F.create_map(*[F.lit(x) for pair in same.items() for x in pair])
    return _run_summary(logged).withColumn("metrics_repeat", verdict[F.col("run_name")])


@query
def train_regression(spark, sf_dir):
    path, runs_path = _stored_features(spark, sf_dir), scratch_path(spark, "runs")
    logged = training.train_regression(spark, path, runs_path)
    return _checked_runs(spark, path, runs_path, logged)


@query
def train_classification(spark, sf_dir):
    path, runs_path = _stored_features(spark, sf_dir), scratch_path(spark, "runs")
    logged = training.train_classification(spark, path, runs_path)
    return _checked_runs(spark, path, runs_path, logged)


@query
def run_log(spark, sf_dir):
    """Metrics of the rule, written to the run log and read back."""
    scored = _rule_scores(spark, sf_dir)
    measured = metrics.regression_metrics(scored, actual="arr_delay").first().asDict()
    path = scratch_path(spark, "runs")
    runs.log_run(
        spark,
        path,
        "run-1",
        experiment="check",
        run_name="regression_rule",
        params={"target": features.DELAY_TARGET},
        metrics=measured,
        importances={},
        feature_table_version=0,
        model_path="",
    )
    logged = runs.read_runs(spark, path)
    listed = logged.select("run_name", "params", F.explode("metrics").alias("metric", "value"))
    return listed.select(
        "run_name",
        F.col("params")["target"].alias("target"),
        "metric",
        F.round("value", 9).alias("value"),
    )


@query
def feature_lineage(spark, sf_dir):
    """Runs read the version of the feature table that they say they used, here the older one of two."""
    silver_path, path = _stored_silver(spark, sf_dir), scratch_path(spark, "features")
    runs_path = scratch_path(spark, "runs")
    early = gold.feature_frame(tables.read_table(spark, silver_path)).filter(F.col("year") <= SPLIT_YEAR)
    tables.overwrite_table(early, path, silver.PARTITIONS)
    gold.write_features(spark, silver_path, path)
    training.train(
        spark, path, runs_path, models=["linear_regression"], experiment="lineage", feature_table_version=0
    )
    lineage = runs.feature_lineage(spark, runs_path, path)
    return lineage.select(
        "run_name",
        "feature_table_version",
        F.col("features_committed_at").isNotNull().alias("version_known"),
        sum(F.col("params")[part].cast("bigint") for part in ("train_rows", "test_rows")).alias("rows_read"),
    )


@query
def full_run(spark, sf_dir):
    """All layers and models in one go."""
    return stages.run_layers(
        spark,
        flights_raw(spark, sf_dir),
        scratch_path(spark, "lakehouse"),
        order_by=ARRIVAL_ORDER,
    )
