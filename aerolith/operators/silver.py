"""Silver: cleaned, keyed and deduplicated flights."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aerolith.functions import (
    as_double,
    as_int,
    as_text,
    as_tinyint,
    business_key,
    departure_hour,
    flight_date,
    iso_weekday,
    row_hash_key,
    season,
    upper_text,
)
from aerolith.operators.batches import only_batch
from aerolith.session import materialise, stage
from aerolith.sources import tables
from aerolith.sources.columns import match_columns
from aerolith.sources.files import INGEST_ORDER, delete_path, path_exists

# Limits of a plausible arrival delay and the delay that counts as late, in minutes.
MIN_ARR_DELAY = -120.0
MAX_ARR_DELAY = 360.0
LATE_MINUTES = 15.0
UNKNOWN = "UNK"

# Columns of Silver, and the parts of the two kinds of key in their order.
SILVER_COLUMNS = (
    "flight_key",
    "flight_date",
    "year",
    "month",
    "day_of_month",
    "hour",
    "day_of_week",
    "season",
    "carrier",
    "flight_num",
    "origin",
    "dest",
    "route",
    "dep_delay",
    "arr_delay",
    "is_delayed_15",
)
KEY_PARTS = (
    "year",
    "month",
    "day_of_month",
    "carrier",
    "flight_num",
    "origin",
    "dest",
    "dep_time_raw",
)
# Without these in the source a record is identified by a hash over values, delays included.
IDENTIFYING_COLUMNS = ("day_of_month", "carrier", "flight_num", "origin", "dest")
HASH_PARTS = (*KEY_PARTS, "dep_delay", "arr_delay")
PARTITIONS = ("year", "month")

# How each column is read, and what stands in for it when the source lacks it.
_READERS = {
    "year": (as_int, None),
    "month": (as_int, None),
    "day_of_month": (as_int, 1),
    "dep_delay": (as_double, None),
    "arr_delay": (as_double, None),
    "cancelled": (as_tinyint, 0),
    "carrier": (upper_text, UNKNOWN),
    "flight_num": (as_text, UNKNOWN),
    "origin": (upper_text, UNKNOWN),
    "dest": (upper_text, UNKNOWN),
    "dep_time_raw": (as_int, None),
}


def normalise(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Canonical columns and types from whatever names the source uses; `keep` passes through."""
    columns = []
    for name, source in match_columns(raw.columns).items():
        read, default = _READERS[name]
        value = F.col(f"`{source}`") if source is not None else F.lit(default)
        columns.append(read(value).alias(name))
    return raw.select(*columns, *keep)


def clean_rules() -> dict[str, Column]:
    """Conditions a normalised row has to meet, in the order they are applied."""
    return {
        "cancelled": F.col("cancelled") == 0,
        "required": F.col("year").isNotNull()
        & F.col("month").isNotNull()
        & F.col("arr_delay").isNotNull(),
        "calendar": F.col("month").between(1, 12) & F.col("day_of_month").between(1, 31),
        "outliers": F.col("arr_delay").between(MIN_ARR_DELAY, MAX_ARR_DELAY),
        "valid_date": _date().isNotNull(),
    }


def _date() -> Column:
    return flight_date(F.col("year"), F.col("month"), F.col("day_of_month"))


def clean(df: DataFrame, *rules: str) -> DataFrame:
    """Keep the rows that meet the named rules, all of them by default."""
    conditions = clean_rules()
    for name in rules or conditions:
        df = df.filter(conditions[name])
    return df


def clean_funnel(df: DataFrame) -> DataFrame:
    """Rows left after each cleaning rule, from one pass."""
    passed = F.lit(True)
    counts = [F.count("*").alias("raw")]
    for name, rule in clean_rules().items():
        passed = passed & F.coalesce(rule, F.lit(False))
        counts.append(F.count_if(passed).alias(f"after_{name}"))
    return df.agg(*counts)


def has_business_key(raw_columns: Sequence[str]) -> bool:
    found = match_columns(raw_columns)
    return all(found[name] is not None for name in IDENTIFYING_COLUMNS)


def with_flight_key(
    df: DataFrame, *, from_business: bool, null_safe: bool = False, absent: Sequence[str] = ()
) -> DataFrame:
    """Add `flight_key`; the business key leaves delays out, so a corrected delay is an update.

    Parts that the source does not have at all (`absent`) are left out of the business key.
    """
    if from_business:
        parts = [F.col(name) for name in KEY_PARTS if name not in absent]
        key = business_key(parts, null_safe=null_safe)
    else:
        key = row_hash_key([F.col(name) for name in HASH_PARTS])
    return df.withColumn("flight_key", key)


def derive_features(df: DataFrame) -> DataFrame:
    """Add date, hour, weekday, season, route and the late flag."""
    return df.withColumns(
        {"flight_date": _date(), "hour": departure_hour(F.col("dep_time_raw"))}
    ).withColumns(
        {
            "day_of_week": iso_weekday(F.col("flight_date")),
            "season": season(F.col("month")),
            "route": F.concat("origin", F.lit("_"), "dest"),
            "is_delayed_15": (F.col("arr_delay") > LATE_MINUTES).cast("tinyint"),
        }
    )


def dedupe_keep_last(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the last one in the order of `order_by`, which should be unique.

    Spark keeps only the best row per key within each task before the shuffle, so a key shared by a
    large part of the data (the null key, say) never gathers in one task. A hash of the key leads the
    sort: it settles most comparisons at once, where year and month would settle few.
    """
    newest_first = W.partitionBy("_key_hash", *key).orderBy(
        *[F.col(name).desc() for name in order_by]
    )
    return (
        df.withColumn("_key_hash", F.xxhash64(*key))
        .withColumn("_pick", F.row_number().over(newest_first))
        .filter("_pick = 1")
        .drop("_pick", "_key_hash")
    )


def ingest_order(columns: Sequence[str]) -> list[str]:
    """The order columns that a Bronze load adds; an error when the table has none."""
    if not set(INGEST_ORDER) <= set(columns):
        raise ValueError("Name the columns that tell which of two equal keys came last (order_by).")
    return list(INGEST_ORDER)


def silver_frame(
    raw: DataFrame,
    *,
    order_by: Sequence[str] | None = None,
    max_year: int | None = None,
    year: int | None = None,
    month: int | None = None,
    null_safe_key: bool = False,
) -> DataFrame:
    """The whole Silver transformation: normalise, clean, key, derive, deduplicate.

    By default a row with a null key part has a null key, and each (year, month) keeps one such row;
    `null_safe_key` gives these rows keys of their own.
    """
    order_by = list(order_by) if order_by is not None else ingest_order(raw.columns)
    rows = normalise(raw, keep=order_by)
    if max_year is not None:
        rows = rows.filter(F.col("year") <= int(max_year))
    rows = clean(only_batch(rows, year, month))
    absent = [name for name, found in match_columns(raw.columns).items() if found is None]
    rows = with_flight_key(
        rows,
        from_business=has_business_key(raw.columns),
        null_safe=null_safe_key,
        absent=absent,
    )
    rows = derive_features(rows).select(*SILVER_COLUMNS, *order_by)
    return dedupe_keep_last(rows, [*PARTITIONS, "flight_key"], order_by).select(*SILVER_COLUMNS)


def merge_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], *, null_matches: bool = False
) -> DataFrame:
    """Target with the source merged in: equal keys take the source row, the rest is added.

    A null key equals nothing, so such rows stay on both sides; with `null_matches` it equals a null key. Columns only
    the target has keep their value on update and are null on insert.
    """
    key_hash = F.xxhash64(*keys)  # leads the sort of the join, as in dedupe_keep_last
    t = target.withColumn("_key_hash", key_hash).alias("t")
    s = source.withColumns({"_key_hash": key_hash, "_in_source": F.lit(True)}).alias("s")
    same = F.col("t._key_hash") == F.col("s._key_hash")
    for key in keys:
        left, right = F.col(f"t.`{key}`"), F.col(f"s.`{key}`")
        same = same & (left.eqNullSafe(right) if null_matches else left == right)
    from_source = F.col("s._in_source")
    columns = [
        F.when(from_source, F.col(f"s.`{name}`")).otherwise(F.col(f"t.`{name}`")).alias(name)
        if name in source.columns
        else F.col(f"t.`{name}`")
        for name in target.columns
    ]
    return t.join(s, same, "full_outer").select(*columns)


def upsert(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str] = ("flight_key",),
    *,
    null_matches: bool = False,
    deduplicated: bool = False,
    load_id: str | None = None,
) -> DataFrame:
    """Merge rows into a table, rewriting only the (year, month) batches they fall in.

    `source` is read twice and has to be stable (a staged frame or a table). Keys are compared within
    their batch, which changes nothing as flight keys carry or hash year and month. `null_matches` merges rows with a
    null key like others (`merge_rows`). Keys that repeat inside a batch are refused; `deduplicated` says that the source
    comes from `silver_frame`, which leaves none, and saves the shuffle of all keys that looks for them. A `load_id`
    names the load. Returns the rows per batch of the source.
    """
    known_key = F.lit(True)
    for key in [] if null_matches else keys:
        known_key = known_key & F.col(key).isNotNull()
    if deduplicated:
        per_batch = source.groupBy(*PARTITIONS).agg(F.count("*").alias("rows"), F.lit(0).alias("repeated"))
    else:
        per_key = source.groupBy(*PARTITIONS, *keys).agg(F.count("*").alias("rows"))
        per_batch = per_key.groupBy(*PARTITIONS).agg(
            F.sum("rows").alias("rows"), F.count_if(known_key & (F.col("rows") > 1)).alias("repeated")
        )
    touched = materialise(per_batch)
    if touched.isEmpty():
        return touched.drop("repeated")
    if repeated := touched.agg(F.sum("repeated")).first()[0]:
        raise ValueError(f"{repeated} keys repeat inside a batch of the source; deduplicate it first.")
    touched = touched.drop("repeated")
    current = tables.snapshot(spark, path)
    schema = tables.widened_schema(current.schema, source.schema)
    entries = current.entries.join(touched.select(*PARTITIONS), list(PARTITIONS), "left_semi")
    # Files from before a new column read as null there.
    target = tables.read_entries(spark, path, entries, schema)
    merged = merge_rows(
        target.select(*schema.names), source, [*PARTITIONS, *keys], null_matches=null_matches
    )
    merged = tables.fit_schema(merged, schema)
    load_id = tables.write_load(merged, path, PARTITIONS, load_id=load_id)
    tables.commit(
        spark,
        path,
        tables.load_batches(spark, path, load_id, PARTITIONS),
        mode=tables.MERGE,
        load_id=load_id,
        schema=schema,
        partition_by=PARTITIONS,
        version_per_batch=True,
        after=current,
    )
    return touched


def append_new_batches(
    spark: SparkSession, path: str, rows: DataFrame, *, load_id: str | None = None
) -> DataFrame:
    """Add batches the table does not have: the first write creates it. Returns rows per batch."""
    current = tables.find_snapshot(spark, path)
    schema = rows.schema
    if current is not None:
        schema = tables.widened_schema(current.schema, schema)
        rows = tables.fit_schema(rows, schema)
    load_id = tables.write_load(rows, path, PARTITIONS, load_id=load_id)
    return tables.commit(
        spark,
        path,
        tables.load_batches(spark, path, load_id, PARTITIONS),
        mode=tables.APPEND,
        first_mode=tables.OVERWRITE if current is None else None,
        load_id=load_id,
        schema=schema,
        partition_by=PARTITIONS,
        version_per_batch=True,
        after=current,
    )


LINEAGE_SCHEMA = (
    "year int, month int, bronze_path string, bronze_version int, silver_version int, recipe string"
)


def silver_lineage(spark: SparkSession, silver_path: str) -> DataFrame:
    """Which Bronze version each Silver batch was built from: one row per build of a batch."""
    folder = f"{silver_path}/lineage"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], LINEAGE_SCHEMA)
    return spark.read.schema(LINEAGE_SCHEMA).parquet(folder)


def _unchanged(spark: SparkSession, bronze_path: str, silver_path: str, recipe: str) -> DataFrame:
    """Batches with the Bronze version (`bronze_version`) that the present Silver table has them from.

    Builds from another Bronze table, by another recipe, or from before Silver was overwritten do not count.
    """
    since = tables.last_overwrite(spark, silver_path)
    return (
        silver_lineage(spark, silver_path)
        .filter((F.col("bronze_path") == bronze_path) & (F.col("recipe") == recipe))
        .filter(F.lit(False) if since is None else F.col("silver_version") >= since)
        .groupBy("year", "month")
        .agg(F.max("bronze_version").alias("bronze_version"))
    )


def build_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    *,
    order_by: Sequence[str] | None = None,
    max_year: int | None = None,
    null_safe_key: bool = False,
    changed_only: bool = False,
) -> DataFrame:
    """Bring Silver up to date with Bronze: new batches are added, known ones are merged again.

    With `changed_only` a batch whose rows in Bronze have not changed since Silver was built from them is left alone,
    neither read nor written. What a batch was built from is recorded after its commit, so a run that dies in between
    builds the batch again.

    Returns one row: input_rows, output_rows, written_mode, version. The mode is the strongest one
    used (merge, append, overwrite), `skip` when no batch had a row to write.
    """
    recipe = json.dumps({"order_by": None if order_by is None else list(order_by), "null_safe_key": null_safe_key})
    source = tables.changed_batches(spark, bronze_path)
    if max_year is not None:
        source = source.filter(F.col("year") <= int(max_year))
    if changed_only:
        built = _unchanged(spark, bronze_path, silver_path, recipe)
        source = source.join(built, list(PARTITIONS), "left").filter(
            F.col("bronze_version").isNull() | (F.col("bronze_version") < F.col("changed_version"))
        )
    known = tables.live_batches(spark, silver_path).select(*PARTITIONS, F.lit(True).alias("known"))
    todo = materialise(source.join(known, list(PARTITIONS), "left"))
    planned = todo.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count_if(F.col("known").isNull()).alias("new"),
        F.count("known").alias("known"),
    ).first()
    existed = tables.latest_version(spark, silver_path) is not None

    def silver_of(batches: DataFrame) -> DataFrame:
        raw = tables.read_table(spark, bronze_path, batches=batches)
        return silver_frame(raw, order_by=order_by, null_safe_key=null_safe_key)

    def written(entries: DataFrame) -> Row:
        return entries.agg(
            F.count("*").alias("batches"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
        ).first()

    output_rows, modes = 0, set()
    if planned.new:
        added = written(
            append_new_batches(spark, silver_path, silver_of(todo.filter(F.col("known").isNull())))
        )
        output_rows += added.rows
        if added.batches and not existed:
            modes.add("overwrite")
        if added.batches > (0 if existed else 1):
            modes.add("append")
    if planned.known:
        staged, folder = stage(silver_of(todo.filter(F.col("known"))))
        try:
            merged = written(upsert(spark, silver_path, staged, deduplicated=True))
        finally:
            delete_path(spark, folder)
        output_rows += merged.rows
        if merged.batches:
            modes.add("merge")
    version = tables.latest_version(spark, silver_path)
    if not modes and version is None:
        raise ValueError("Silver output is empty; nothing was written.")
    if version is not None and planned.new + planned.known:
        todo.select(
            *PARTITIONS,
            F.lit(bronze_path).alias("bronze_path"),
            F.col("changed_version").alias("bronze_version"),
            F.lit(version).cast("int").alias("silver_version"),
            F.lit(recipe).alias("recipe"),
        ).coalesce(1).write.mode("append").parquet(f"{silver_path}/lineage")
    mode = next((m for m in ("merge", "append", "overwrite") if m in modes), "skip")
    return spark.range(1).select(
        F.lit(planned.rows).cast("bigint").alias("input_rows"),
        F.lit(output_rows).cast("bigint").alias("output_rows"),
        F.lit(mode).alias("written_mode"),
        F.lit(version).cast("int").alias("version"),
    )
