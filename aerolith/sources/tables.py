"""Versioned tables on plain Parquet.

A table is a folder with two parts:

* `data/load_id=<id>/[<year>=../<month>=../]` holds the rows; every write makes a new load.
* `commits/` is a small Parquet table with one row per (version, batch): which load holds the
  batch, how it entered the table, how many rows it has and the table's schema at that version.

Rows count only once a commit names them, so a write that dies half-way leaves nothing visible and
can simply be run again. One writer per table at a time is assumed. The commits grow with the number
of batches, never with the number of rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.sources.columns import quoted
from aerolith.sources.files import path_exists

APPEND = "append"  # adds a batch
OVERWRITE = "overwrite"  # supersedes the whole table
MERGE = "merge"  # supersedes the batch of the same year and month
LOAD_ID = "load_id"  # partition column of the data folder
REWRITE = "rewrite"  # like MERGE, same rows in a different layout
EVOLVE = "evolve"  # changes the schema only
_BATCH_REPLACING = (MERGE, REWRITE)

COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("commit_version", T.IntegerType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("mode", T.StringType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("rows", T.LongType()),
        T.StructField("partition_by", T.ArrayType(T.StringType())),
        T.StructField("schema_json", T.StringType()),
    ]
)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """Commit history of a table; empty when there is no table."""
    folder = f"{path}/commits"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return spark.read.schema(COMMIT_SCHEMA).parquet(folder)


def is_committed(spark: SparkSession, path: str, load_id: str) -> bool:
    """Whether a load of this name has become part of the table."""
    return not commits(spark, path).filter(F.col(LOAD_ID) == load_id).isEmpty()


def latest_version(spark: SparkSession, path: str) -> int | None:
    """Newest version, counted from 0; None when there is no table."""
    return commits(spark, path).agg(F.max("commit_version")).first()[0]


def table_version(spark: SparkSession, path: str) -> DataFrame:
    """One row: the newest version and how many versions there have been."""
    return commits(spark, path).agg(
        F.max("commit_version").alias("version"),
        (F.coalesce(F.max("commit_version"), F.lit(-1)) + 1).cast("bigint").alias("versions"),
    )


def with_supersession(history: DataFrame) -> DataFrame:
    """Add when each batch entry was replaced: `superseded_version`, `superseded_at`.

    The windows run over commits, which are metadata.
    """
    replaces_all = F.col("mode") == OVERWRITE
    replaces_batch = F.col("mode").isin(*_BATCH_REPLACING)
    later = W.orderBy("commit_version").rangeBetween(1, W.unboundedFollowing)
    later_batch = (
        W.partitionBy("year", "month").orderBy("commit_version").rangeBetween(1, W.unboundedFollowing)
    )
    successor = F.struct("commit_version", "committed_at")
    replaced_by = F.least(
        F.min(F.when(replaces_all, successor)).over(later),
        F.min(F.when(replaces_batch, successor)).over(later_batch),
    )
    return (
        history.withColumn("_replaced_by", replaced_by)
        .filter(F.col("mode") != EVOLVE)
        .withColumn("superseded_version", F.col("_replaced_by.commit_version"))
        .withColumn("superseded_at", F.col("_replaced_by.committed_at"))
        .drop("_replaced_by")
    )


@dataclass(frozen=True)
class Snapshot:
    """A table at a version: its layout and the commit rows whose batches make it up."""

    version: int
    schema: T.StructType
    partition_by: list[str]
    entries: DataFrame


def find_snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The table at a version, the newest by default; None when there is no table."""
    history = commits(spark, path)
    upto = F.lit(True) if version is None else F.col("commit_version") <= version
    holds_rows = F.col("mode") != EVOLVE

    def at(value: str, condition: Column = upto) -> Column:
        return F.when(condition, F.col(value))

    head = history.agg(
        F.max("commit_version").alias("newest"),
        F.max(at("commit_version", upto & (F.col("mode") == OVERWRITE))).alias("base"),
        F.max_by(at("schema_json"), at("commit_version")).alias("schema_json"),
        F.max_by(
            at("partition_by", upto & holds_rows), at("commit_version", upto & holds_rows)
        ).alias("partition_by"),
    ).first()
    if head.newest is None:
        return None
    if version is not None and not 0 <= version <= head.newest:
        raise ValueError(f"The table at {path} has versions 0 to {head.newest}, not {version}")
    replaced = F.max(at("commit_version", F.col("mode").isin(*_BATCH_REPLACING))).over(
        W.partitionBy("year", "month")
    )
    entries = (
        history.filter(upto & (F.col("commit_version") >= (head.base or 0)))
        .filter(holds_rows)
        .withColumn("_replaced", replaced)
        .filter(F.col("_replaced").isNull() | (F.col("commit_version") >= F.col("_replaced")))
        .drop("_replaced")
    )
    return Snapshot(
        head.newest if version is None else version,
        T.StructType.fromJson(json.loads(head.schema_json)),
        list(head.partition_by or []),
        entries,
    )


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    """Like `find_snapshot`, but it is an error when there is no table."""
    found = find_snapshot(spark, path, version)
    if found is None:
        raise ValueError(f"No table at {path}")
    return found


def live_entries(spark: SparkSession, path: str) -> DataFrame:
    """Commit rows that make up the newest version; none when there is no table."""
    found = find_snapshot(spark, path)
    return spark.createDataFrame([], COMMIT_SCHEMA) if found is None else found.entries


def table_schema(spark: SparkSession, path: str) -> T.StructType:
    return snapshot(spark, path).schema


def entry_folder() -> Column:
    """Folder of a commit entry below `data/`."""
    parts = F.array_compact(
        F.array(
            F.concat(F.lit("load_id="), F.col("load_id")),
            F.concat(F.get("partition_by", F.lit(0)), F.lit("="), F.col("year")),
            F.concat(F.get("partition_by", F.lit(1)), F.lit("="), F.col("month")),
        )
    )
    return F.array_join(parts, "/")


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """Every data file with its folder, size and age; lists names only, opens no file."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(f"{path}/data")
        .select(
            "path",
            F.regexp_extract("path", r"/data/(load_id=.*)/[^/]+$", 1).alias("folder"),
            F.col("length").alias("bytes"),
            F.col("modificationTime").alias("modified_at"),
        )
    )


def require_folders(spark: SparkSession, path: str, entries: DataFrame) -> None:
    """Fail when a folder of the entries is gone: a scan that prunes folders would not miss it."""
    wanted = entries.filter("rows > 0").select(entry_folder().alias("folder"))
    gone = wanted.join(data_files(spark, path).select("folder"), "folder", "left_anti")
    if first := gone.agg(F.min("folder")).first()[0]:
        raise FileNotFoundError(f"[PATH_NOT_FOUND] {path}/data/{first} was deleted, by vacuum or otherwise.")


def read_entries(
    spark: SparkSession, path: str, entries: DataFrame, schema: T.StructType
) -> DataFrame:
    """Rows of the given commit entries, with the partition columns available for pruning.

    All loads are one scan with `load_id` as a partition column. A semi-join with the entries, one row per
    batch, keeps the live ones: its broadcast side prunes the folders when the query runs. To the driver comes how
    the entries are partitioned, one row for every way (a table has one unless it was overwritten).
    """
    layouts = [row.partition_by or [] for row in entries.select("partition_by").distinct().collect()]
    parts = [_read_layout(spark, path, entries, schema, layout) for layout in layouts]
    if not parts:
        return spark.createDataFrame([], schema)
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows


def _read_layout(
    spark: SparkSession, path: str, entries: DataFrame, schema: T.StructType, layout: Sequence[str]
) -> DataFrame:
    """Rows of the entries that are partitioned by these columns; folders of other layouts are not listed."""
    below = f"{quoted_in_glob(layout[0])}=*" if layout else "*.parquet"
    scanned = (
        spark.read.schema(schema)
        .option("basePath", f"{path}/data")
        .parquet(f"{path}/data/{LOAD_ID}=*/{below}")
    )
    batch = dict(zip(layout, ("year", "month"), strict=False))
    same = F.coalesce("partition_by", F.array().cast("array<string>")) == F.array(*map(F.lit, layout)).cast("array<string>")
    live = entries.filter(same).select(
        F.col("load_id").alias(LOAD_ID), *[F.col(of).alias(name) for name, of in batch.items()]
    )
    return scanned.join(F.broadcast(live.distinct()), [LOAD_ID, *layout], "left_semi").drop(
        *([] if LOAD_ID in schema.names else [LOAD_ID])
    )


def quoted_in_glob(name: str) -> str:
    """A column name as it stands in the folders of its partitions, safe in a path pattern."""
    return "".join(c if c.isalnum() or c == "_" else "?" for c in name)


def read_table(
    spark: SparkSession, path: str, version: int | None = None, batches: DataFrame | None = None
) -> DataFrame:
    """A table at a version, or only those of its (year, month) batches that `batches` lists."""
    found = snapshot(spark, path, version)
    entries = found.entries
    if version is not None:
        require_folders(spark, path, entries)  # what the newest version uses is never vacuumed
    if batches is not None:
        entries = entries.join(batches.select("year", "month"), ["year", "month"], "left_semi")
    return read_entries(spark, path, entries, found.schema).select(*quoted(found.schema.names))


def live_batches(spark: SparkSession, path: str) -> DataFrame:
    """Rows per (year, month) batch of a table, from its commits alone."""
    return batch_totals(live_entries(spark, path))


def changed_batches(spark: SparkSession, path: str) -> DataFrame:
    """Live batches with their rows and `changed_version`, the newest version that brought them other rows.

    New layouts of the same rows (compaction, clustering) do not count.
    """
    found = find_snapshot(spark, path)
    if found is None:
        return spark.createDataFrame([], "year int, month int, rows bigint, changed_version int")
    changes = (
        commits(spark, path)
        .filter((F.col("commit_version") <= found.version) & ~F.col("mode").isin(REWRITE, EVOLVE))
        .groupBy("year", "month")
        .agg(F.max("commit_version").alias("changed_version"))
    )
    return batch_totals(found.entries).join(changes, ["year", "month"])


def last_overwrite(spark: SparkSession, path: str) -> int | None:
    """The newest version that replaced a table as a whole."""
    return commits(spark, path).filter(F.col("mode") == OVERWRITE).agg(F.max("commit_version")).first()[0]


def batch_totals(entries: DataFrame) -> DataFrame:
    """Rows per (year, month) of commit entries."""
    return (
        entries.filter(F.col("year").isNotNull())
        .groupBy("year", "month")
        .agg(F.sum("rows").alias("rows"))
    )


def write_load(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    *,
    keep_layout: bool = False,
    load_id: str | None = None,
) -> str:
    """Write rows as a new load and return its id; nothing is visible until it is committed.

    Rows are first brought together by partition with a rebalancing shuffle: without it every task
    would open a file in every batch. Adaptive execution cuts a batch that is too large for one task
    into several and merges small ones. `keep_layout` skips this for rows already laid out. A given
    `load_id` replaces what an attempt that was never committed has left under it.
    """
    load_id = load_id or f"l{uuid.uuid4().hex}"
    if partition_by and not keep_layout:
        df = df.hint("rebalance", *[F.col(name) for name in partition_by])
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/data/load_id={load_id}")
    return load_id


def load_batches(
    spark: SparkSession, path: str, load_id: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Rows per batch of a load; reads partition columns only, so no data pages."""
    folder = f"{path}/data/load_id={load_id}"
    year, month = partition_by or (None, None)
    schema = T.StructType([T.StructField(name, T.IntegerType()) for name in partition_by])
    if not partition_by:
        counted = spark.read.parquet(folder).agg(F.count("*").alias("rows"))
        return counted.select(
            F.lit(None).cast("int").alias("year"), F.lit(None).cast("int").alias("month"), "rows"
        )
    return (
        spark.read.schema(schema)
        .parquet(folder)
        .groupBy(F.col(year).alias("year"), F.col(month).alias("month"))
        .agg(F.count("*").alias("rows"))
    )


def commit(
    spark: SparkSession,
    path: str,
    batches: DataFrame,
    *,
    mode: str,
    load_id: str | None,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    version_per_batch: bool = False,
    first_mode: str | None = None,
    after: Snapshot | None = None,
) -> DataFrame:
    """Record batches (`year`, `month`, `rows`) of a load.

    They share the next version, or get one each in calendar order with `version_per_batch`.
    `first_mode` replaces the mode of the first one. `after` is the newest snapshot, where the
    caller has it at hand. The rows are written as one file, so the whole
    commit becomes visible at once. Returns the recorded rows.
    """
    last = latest_version(spark, path) if after is None else after.version
    start = 0 if last is None else last + 1
    offset = F.monotonically_increasing_id() if version_per_batch else F.lit(0)
    (
        batches.coalesce(1)
        .sortWithinPartitions("year", "month")
        .withColumn("commit_version", (F.lit(start) + offset).cast("int"))
        .select(
            "commit_version",
            F.current_timestamp().alias("committed_at"),
            F.when(F.col("commit_version") == start, first_mode or mode).otherwise(mode).alias("mode"),
            F.lit(load_id).cast("string").alias("load_id"),
            "year",
            "month",
            "rows",
            F.lit(list(partition_by)).cast("array<string>").alias("partition_by"),
            F.lit(schema.json()).alias("schema_json"),
        )
        .write.mode("append")
        .parquet(f"{path}/commits")
    )
    return commits(spark, path).filter(F.col("commit_version") >= start)


def overwrite_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), *, keep_layout: bool = False
) -> DataFrame:
    """Replace the contents of a table in one version. Returns the commit rows."""
    spark = df.sparkSession
    load_id = write_load(df, path, partition_by, keep_layout=keep_layout)
    return commit(
        spark,
        path,
        load_batches(spark, path, load_id, partition_by),
        mode=OVERWRITE,
        load_id=load_id,
        schema=df.schema,
        partition_by=partition_by,
    )


def append_load(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Add rows to a table in one version. Returns the commit rows."""
    spark = df.sparkSession
    schema = df.schema
    current = find_snapshot(spark, path)
    if current is not None:
        schema = widened_schema(current.schema, schema)
        df = fit_schema(df, schema)
    load_id = write_load(df, path, partition_by)
    return commit(
        spark,
        path,
        load_batches(spark, path, load_id, partition_by),
        mode=APPEND,
        load_id=load_id,
        schema=schema,
        partition_by=partition_by,
        after=current,
    )


_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
# Types that files of a smaller type can be read as, smallest first.
_READABLE_AS = (
    _WHOLE,
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.DoubleType()),
    (T.FloatType(), T.DoubleType()),
)


def common_type(name: str, table: T.DataType, added: T.DataType) -> T.DataType:
    """The type a column has once rows of another type are added; never one that loses values.

    The table's type stays if it holds all added values (text holds everything). Otherwise it widens where the
    files it has can be read as the wider type; where they cannot, the load is refused.
    """
    if table == added or isinstance(added, T.NullType):
        return table
    if isinstance(table, T.StringType) and isinstance(added, T.AtomicType):
        return table
    for ladder in _READABLE_AS:
        if table in ladder and added in ladder:
            return max(table, added, key=ladder.index)
    if table == T.DoubleType() and added == T.FloatType():
        return table
    raise ValueError(
        f"Column {name} is {table.simpleString()} in the table and {added.simpleString()} in the rows "
        "to add; cast the rows, or load the table anew with reset."
    )


def widened_schema(current: T.StructType, added: T.StructType) -> T.StructType:
    """The table's own fields, wide enough for the added rows, and behind them the new ones."""
    new = {field.name.lower(): field for field in added}
    known = {field.name.lower() for field in current}
    fields = [
        T.StructField(
            field.name,
            common_type(field.name, field.dataType, new[field.name.lower()].dataType)
            if field.name.lower() in new
            else field.dataType,
            field.nullable,
            field.metadata,
        )
        for field in current
    ]
    return T.StructType([*fields, *[field for field in added if field.name.lower() not in known]])


def fit_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring rows to a (widened) schema: in its order, missing columns null."""
    by_lower = {name.lower(): name for name in df.columns}
    return df.select(
        *[
            F.col(f"`{by_lower[f.name.lower()]}`").cast(f.dataType).alias(f.name)
            if f.name.lower() in by_lower
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
