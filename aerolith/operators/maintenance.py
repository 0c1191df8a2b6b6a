"""Upkeep of versioned tables: old versions, file layout, retention and schema."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.operators.clustering import sort_cluster, z_order_rows
from aerolith.session import TARGET_PARTITION_BYTES, materialise
from aerolith.sources import tables
from aerolith.sources.columns import quoted
from aerolith.sources.files import delete_path
from aerolith.sources.tables import data_files

# Defaults of the maintenance run.
RETENTION_HOURS = 168
Z_ORDER_COLUMNS = ("year", "month", "origin", "dest", "carrier")
EVOLVED_COLUMN = "pipeline_run_id"
EVOLVED_VALUE = "init"


def time_travel(spark: SparkSession, path: str, version: int) -> DataFrame:
    """The table as it was at a version."""
    return tables.read_table(spark, path, version)


def _live_files(spark: SparkSession, path: str, entries: DataFrame) -> DataFrame:
    live = entries.select("year", "month", tables.entry_folder().alias("folder"))
    return data_files(spark, path).join(live, "folder")


def _all_columns(current: tables.Snapshot) -> list[Column]:
    """Columns of the table and those it is partitioned by."""
    return quoted(dict.fromkeys([*current.schema.names, *current.partition_by]))


def _rewrite(spark: SparkSession, path: str, rows: DataFrame, current: tables.Snapshot) -> DataFrame:
    """Commit rows that are laid out anew: supersedes exactly the batches they are in."""
    load_id = tables.write_load(rows, path, current.partition_by, keep_layout=True)
    return tables.commit(
        spark,
        path,
        tables.load_batches(spark, path, load_id, current.partition_by),
        mode=tables.REWRITE,
        load_id=load_id,
        schema=current.schema,
        partition_by=current.partition_by,
        after=current,
    )


def _into_files(rows: DataFrame, plan: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Send the rows of each batch to as many tasks as `plan` wants files for it.

    Rows are dealt by a hash over the row and the task that read it, so copies spread too.
    """
    if not partition_by:
        return rows.repartition(plan.first().wanted)
    year, month = partition_by
    # One row per batch.
    wanted = plan.select(F.col("year").alias(year), F.col("month").alias(month), "wanted")
    columns = quoted(rows.columns)
    spread = F.xxhash64(*columns, F.spark_partition_id())
    return (
        rows.withColumn("_spread", spread)
        .join(F.broadcast(wanted), [year, month])
        .withColumn("_file", F.pmod("_spread", "wanted"))
        .repartition(year, month, "_file")
        .select(*columns)
    )


def compact(
    spark: SparkSession, path: str, target_bytes: int = TARGET_PARTITION_BYTES
) -> DataFrame:
    """Merge the small files of each batch; batches that would keep as many files stay untouched.

    One row: method, batches_rewritten, files_before, files_after, rows, version.
    """
    current = tables.snapshot(spark, path)
    batch_files = materialise(
        _live_files(spark, path, current.entries)
        .groupBy("year", "month")
        .agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
        .withColumn("wanted", F.ceil(F.col("bytes") / target_bytes))
    )
    crowded = batch_files.filter(F.col("files") > F.col("wanted"))
    found = batch_files.agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
        F.count_if(F.col("files") > F.col("wanted")).alias("crowded"),
    ).first()
    files_after = found.files
    if found.crowded:
        todo = current.entries
        if current.partition_by:
            todo = todo.join(crowded.select("year", "month"), ["year", "month"], "left_semi")
        rows = tables.read_entries(spark, path, todo, current.schema)
        rows = _into_files(rows.select(*_all_columns(current)), crowded, current.partition_by)
        _rewrite(spark, path, rows, current)
        current = tables.snapshot(spark, path)
        files_after = _live_files(spark, path, current.entries).count()
    return current.entries.agg(
        F.lit("compact").alias("method"),
        F.lit(found.crowded).cast("bigint").alias("batches_rewritten"),
        F.lit(found.files).cast("bigint").alias("files_before"),
        F.lit(files_after).cast("bigint").alias("files_after"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.lit(current.version).cast("int").alias("version"),
    )


def z_order(
    spark: SparkSession, path: str, columns: Sequence[str] = Z_ORDER_COLUMNS, *, curve: bool = True
) -> DataFrame:
    """Rewrite a table clustered by columns: along a z curve, or sorted when `curve` is off.

    Unknown columns are left out. One row: method, columns, rows, version; the method is `skipped`
    when no column is left.
    """
    current = tables.snapshot(spark, path)
    existing = [name for name in columns if name in current.schema.names]
    method = "skipped"
    if existing:
        method = "z_order" if curve else "sort"
        rows = tables.read_entries(spark, path, current.entries, current.schema)
        lay_out = z_order_rows if curve else sort_cluster
        rows = lay_out(rows.select(*_all_columns(current)), existing, current.partition_by)
        _rewrite(spark, path, rows, current)
        current = tables.snapshot(spark, path)
    return current.entries.agg(
        F.lit(method).alias("method"),
        F.lit(existing).cast("array<string>").alias("columns"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.lit(current.version).cast("int").alias("version"),
    )


def vacuum(
    spark: SparkSession,
    path: str,
    *,
    dry_run: bool = True,
    retention_hours: float = RETENTION_HOURS,
) -> DataFrame:
    """Data files the newest version does not use and that left it longer ago than the retention.

    Files of a write that was never committed count from their own age. A dry run only lists them;
    otherwise their folders are deleted and versions that need them can no longer be read.
    """
    entries = tables.with_supersession(tables.commits(spark, path)).select(
        "year",
        "month",
        "commit_version",
        "superseded_at",
        F.col("superseded_version").isNull().alias("live"),
        tables.entry_folder().alias("folder"),
    )
    left_at = F.when(F.col("commit_version").isNull(), F.col("modified_at")).otherwise(
        F.col("superseded_at")
    )
    hours = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(retention_hours) * 3600))
    expired = (
        data_files(spark, path)
        .join(entries, "folder", "left")
        .filter(~F.coalesce("live", F.lit(False)) & (left_at <= F.current_timestamp() - hours))
        .select("path", "folder", "bytes", "commit_version", "year", "month", left_at.alias("left_at"))
    )
    if dry_run:
        return expired
    expired = materialise(expired)
    # A folder is one batch of one load and is used as a whole or not at all.
    for row in expired.select("folder").distinct().collect():
        delete_path(spark, f"{path}/data/{row.folder}")
    return expired


def evolve_schema(
    spark: SparkSession, path: str, column: str = EVOLVED_COLUMN, value: str = EVOLVED_VALUE
) -> DataFrame:
    """Add a text column holding `value` in every present row; nothing happens if it exists.

    No data is rewritten: the new schema carries the value that readers put in for files without
    the column. One row: changed, version.
    """
    current = tables.snapshot(spark, path)
    present = column.lower() in [name.lower() for name in current.schema.names]
    if not present:
        literal = "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        field = T.StructField(
            column, T.StringType(), True, {"EXISTS_DEFAULT": literal, "CURRENT_DEFAULT": literal}
        )
        nothing = spark.createDataFrame([(None, None, 0)], "year int, month int, rows bigint")
        tables.commit(
            spark,
            path,
            nothing,
            mode=tables.EVOLVE,
            load_id=None,
            schema=T.StructType([*current.schema.fields, field]),
            after=current,
        )
    return spark.range(1).select(
        F.lit(not present).alias("changed"),
        F.lit(current.version + (not present)).cast("int").alias("version"),
    )


def maintenance_report(
    spark: SparkSession,
    path: str,
    *,
    version: int = 0,
    columns: Sequence[str] = Z_ORDER_COLUMNS,
) -> DataFrame:
    """Time travel, compaction, z-order, dry-run vacuum and schema evolution, in this order.

    One row: time_travel_rows, compaction, z_order and vacuum as JSON, and the version afterwards.
    """
    travelled = time_travel(spark, path, version).count()
    compaction = compact(spark, path).first().asDict()
    ordered = z_order(spark, path, columns).first().asDict()
    expired = vacuum(spark, path).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    vacuumed = {
        "dry_run": True,
        "retention_hours": RETENTION_HOURS,
        **expired.first().asDict(),
    }
    return evolve_schema(spark, path).select(
        F.lit(travelled).cast("bigint").alias("time_travel_rows"),
        F.lit(json.dumps(compaction)).alias("compaction"),
        F.lit(json.dumps(ordered)).alias("z_order"),
        F.lit(json.dumps(vacuumed)).alias("vacuum"),
        F.col("version").alias("version_after_schema_evolution"),
    )
