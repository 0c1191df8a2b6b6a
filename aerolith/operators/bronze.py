"""Bronze: raw rows, loaded once per (year, month) batch."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.functions import as_int
from aerolith.sources import tables
from aerolith.sources.columns import quoted, require_column
from aerolith.sources.files import INGEST_FILE, INGEST_MALFORMED, INGEST_ORDER, delete_path, path_exists

BATCH_COLUMNS = ("batch_year", "batch_month")
FATES = ("source", "written", "skipped", "rejected", "malformed")  # counts of a load


# The folder of a load that holds the rows of no batch.
NO_BATCH = f"{BATCH_COLUMNS[0]}=__HIVE_DEFAULT_PARTITION__"
QUARANTINE_SCHEMA = f"record string, {INGEST_ORDER[0]} string, {INGEST_ORDER[1]} bigint, {INGEST_ORDER[2]} bigint"


def malformed(columns: Sequence[str]) -> Column:
    """Whether a row is a record that did not fit its source's columns."""
    return F.col(INGEST_MALFORMED).isNotNull() if INGEST_MALFORMED in columns else F.lit(False)


def with_batch_columns(source: DataFrame) -> DataFrame:
    """The source with its year cast to int, plus the batch each row belongs to; malformed records have none."""
    year = require_column(source.columns, "year")
    month = require_column(source.columns, "month")
    sound = ~malformed(source.columns)
    return source.withColumn(year, as_int(F.col(year))).withColumns(
        {"batch_year": F.when(sound, F.col(year)), "batch_month": F.when(sound, as_int(F.col(month)))}
    )


def batch_status(source: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows and fate of every batch of a source: `written`, `skipped`, `rejected` or `malformed`.

    `loaded` lists the batches (`year`, `month`) a table already has. Rows without a usable year or
    month belong to no batch and are rejected; malformed records are put aside.
    """
    known = F.broadcast(loaded.select("year", "month", F.lit(True).alias("_known")))  # one row per batch
    return (
        with_batch_columns(source)
        .groupBy(
            F.col("batch_year").alias("year"),
            F.col("batch_month").alias("month"),
            malformed(source.columns).alias("_malformed"),
        )
        .agg(F.count("*").alias("rows"))
        .join(known, ["year", "month"], "left")
        .withColumn(
            "status",
            F.when(F.col("_malformed"), "malformed")
            .when(F.col("year").isNull() | F.col("month").isNull(), "rejected")
            .when(F.col("_known"), "skipped")
            .otherwise("written"),
        )
        .select("year", "month", "rows", "status")
    )


def append_batches(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    *,
    max_year: int | None = None,
    reset: bool = False,
    late_rows: bool = False,
    load_id: str | None = None,
) -> DataFrame:
    """Append the batches a Bronze table does not have yet; one version per batch, one write.

    Batches already loaded are skipped as a whole, late rows included; with `late_rows` nothing is skipped,
    for sources that never repeat a row. `reset` supersedes whatever the table held. A
    `load_id` that is committed already makes the call a repetition, which writes nothing.

    Malformed records of a CSV scan are written along with the others and then put into the table's quarantine
    (`read_quarantine`); `max_year` does not apply to them. One with the same file and text as before is not kept again.

    The source is read once: what becomes of its rows is observed while they are written. Returns one row:
    years_written, source_rows, written_rows, skipped_rows, rejected_rows, malformed_rows, versions.
    """
    broken = malformed(source.columns)
    if max_year is not None:
        year = as_int(F.col(require_column(source.columns, "year")))
        source = source.filter(broken | (year <= int(max_year)))
    current = tables.find_snapshot(spark, path)
    known = current is not None and not reset
    no_batches = spark.createDataFrame([], "commit_version int, year int, month int, rows bigint")
    loaded = tables.batch_totals(current.entries) if known and not late_rows else no_batches
    before = 0 if current is None else current.version + 1
    if load_id is not None and known and tables.is_committed(spark, path, load_id):
        return _load_result(no_batches, dict.fromkeys(FATES, 0), before)

    batched = with_batch_columns(source)
    done = loaded.select(
        F.col("year").alias("batch_year"), F.col("month").alias("batch_month"), F.lit(True).alias("_known")
    )
    dated = F.col("batch_year").isNotNull() & F.col("batch_month").isNotNull()
    seen = Observation()
    # One row per batch, broadcast: a shuffle would bring all rows without a batch together in one task.
    fresh = (
        batched.join(F.broadcast(done), list(BATCH_COLUMNS), "left")
        .observe(
            seen,
            F.count(F.lit(1)).alias("source"),
            F.count_if(F.coalesce("_known", F.lit(False))).alias("skipped"),
            F.count_if(~dated & ~broken).alias("rejected"),
            F.count_if(broken).alias("malformed"),
            F.count("batch_year").alias("dated"),
        )
        .filter(broken | (dated & F.col("_known").isNull()))
        .select(*quoted([*batched.columns]))
    )
    schema = fresh.drop(*BATCH_COLUMNS, INGEST_MALFORMED).schema
    if known:
        schema = tables.widened_schema(current.schema, schema)
        working = [fresh.schema[name] for name in (*BATCH_COLUMNS, INGEST_MALFORMED) if name in fresh.columns]
        fresh = tables.fit_schema(fresh, T.StructType([*schema.fields, *working]))
    load_id = tables.write_load(fresh, path, BATCH_COLUMNS, load_id=load_id)
    stored = tables.load_batches(spark, path, load_id, BATCH_COLUMNS)
    added = stored.filter(F.col("year").isNotNull())
    dated_rows = F.when(F.col("year").isNotNull(), F.col("rows"))
    n_stored = stored.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("all"), F.coalesce(F.sum(dated_rows), F.lit(0)).alias("written")
    ).first()
    n_written = n_stored.written
    if n_stored["all"] > n_written:
        _set_aside(spark, path, load_id, fresh.schema, once=not late_rows)
    counts = dict(seen.get) if n_stored["all"] else {}
    if not counts or counts["source"] != n_stored["all"] + counts["skipped"] + counts["rejected"]:
        # Without a row to write Spark drops the step that observes, and tasks that ran twice are
        # observed twice: then, and only then, the source is counted again.
        counts = _status_counts(batch_status(source, loaded))
    if not counts["dated"]:
        delete_path(spark, f"{path}/data/load_id={load_id}")
        raise ValueError("The source has no row with a usable year.")
    counts["written"] = n_written
    if not n_written:
        delete_path(spark, f"{path}/data/load_id={load_id}")
        return _load_result(no_batches, counts, before)
    written = tables.commit(
        spark,
        path,
        added,
        mode=tables.APPEND,
        first_mode=None if known else tables.OVERWRITE,
        load_id=load_id,
        schema=schema,
        partition_by=BATCH_COLUMNS,
        version_per_batch=True,
        after=current,
    )
    return _load_result(written, counts, before)


def _set_aside(spark: SparkSession, path: str, load_id: str, written: T.StructType, *, once: bool) -> None:
    """Move the malformed records of a load into the quarantine; with `once` only those it does not have yet."""
    folder = f"{path}/data/load_id={load_id}/{NO_BATCH}"
    fields = [field for field in written if field.name not in BATCH_COLUMNS]
    rows = spark.read.schema(T.StructType(fields)).parquet(folder)
    placed = INGEST_FILE in written.names
    records = rows.select(
        F.col(INGEST_MALFORMED).alias("record"),
        *[F.col(name) if placed else F.lit(None).alias(name) for name in INGEST_ORDER],
    )
    if once and placed and path_exists(spark, f"{path}/quarantine"):
        before = read_quarantine(spark, path).filter(F.col(tables.LOAD_ID) != load_id)
        records = records.join(before, ["record", INGEST_FILE], "left_anti")
    records = records.select("record", *[F.col(n).cast("string" if n == INGEST_FILE else "bigint") for n in INGEST_ORDER])
    records.write.mode("overwrite").parquet(f"{path}/quarantine/{tables.LOAD_ID}={load_id}")
    delete_path(spark, folder)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Malformed records of all loads: record (the text), where it stood in the source, load_id.

    A load keeps them before it commits, so those of a load that failed are here too.
    """
    folder = f"{path}/quarantine"
    schema = f"{QUARANTINE_SCHEMA}, {tables.LOAD_ID} string"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def _status_counts(status: DataFrame) -> dict[str, int]:
    def rows(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("rows"))), F.lit(0))

    return (
        status.agg(
            rows(F.lit(True)).alias("source"),
            rows(F.col("status") == "skipped").alias("skipped"),
            rows(F.col("status") == "rejected").alias("rejected"),
            rows(F.col("status") == "malformed").alias("malformed"),
            rows(F.col("year").isNotNull()).alias("dated"),
        )
        .first()
        .asDict()
    )


def _load_result(written: DataFrame, counts: dict[str, int], before: int) -> DataFrame:
    return written.agg(
        F.sort_array(F.collect_set("year")).alias("years_written"),
        F.coalesce(F.max("commit_version") + 1, F.lit(before)).cast("bigint").alias("versions"),
    ).select(
        "years_written",
        *[
            F.lit(counts.get(name, 0)).cast("bigint").alias(f"{name}_rows")
            for name in FATES
        ],
        "versions",
    )


def reconcile(result: DataFrame) -> DataFrame:
    """Load result with its checks: rows add up, a version exists, versions cover the years."""
    return result.select(
        "*",
        (
            F.col("source_rows") == F.col("written_rows") + F.col("skipped_rows") + F.col("malformed_rows")
        ).alias("rows_match"),
        (F.col("versions") >= 1).alias("has_version"),
        (F.col("versions") >= F.size("years_written")).alias("versions_cover_years"),
    )


def check_load(result: DataFrame) -> None:
    """Fail when a load lost rows or left no version; warn when versions look too few.

    Malformed records are in the quarantine, so they are not lost.
    """
    row = reconcile(result).first()
    if not row.rows_match:
        raise ValueError(
            f"Row count mismatch: source_rows={row.source_rows} written_rows={row.written_rows} "
            f"skipped_rows={row.skipped_rows} rejected_rows={row.rejected_rows} malformed_rows={row.malformed_rows}"
        )
    if not row.has_version:
        raise ValueError("The table has no version after the load.")
    if not row.versions_cover_years:
        warnings.warn(
            f"{row.versions} versions for {len(row.years_written)} years written", stacklevel=2
        )


def read_bronze(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return tables.read_table(spark, path, version)
