"""Gold: the analytics mart and the feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators.batches import only_batch
from aerolith.operators.silver import PARTITIONS, UNKNOWN
from aerolith.session import materialise
from aerolith.sources import tables

# The dimension behind each kind of metric.
METRIC_DIMENSIONS = {
    "airport": "origin",
    "carrier": "carrier",
    "hour": "hour",
    "season": "season",
}
# Columns of the feature table and what stands in for unknown inputs.
FEATURE_COLUMNS = (
    "flight_key",
    "flight_date",
    "year",
    "month",
    "hour",
    "day_of_week",
    "season",
    "carrier",
    "origin",
    "dest",
    "route",
    "dep_delay",
    "arr_delay",
    "is_delayed_15",
)
FEATURE_FILLS = {
    "carrier": UNKNOWN,
    "origin": UNKNOWN,
    "dest": UNKNOWN,
    "route": f"{UNKNOWN}_{UNKNOWN}",
    "dep_delay": 0.0,
}


def with_target(silver: DataFrame) -> DataFrame:
    return silver.filter(F.col("arr_delay").isNotNull())


def _delay_measures() -> list[Column]:
    return [
        F.count("*").alias("flights_cnt"),
        F.avg("arr_delay").alias("avg_arr_delay"),
        F.avg("dep_delay").alias("avg_dep_delay"),
        F.avg("is_delayed_15").alias("share_delayed_15"),
    ]


def delay_by(silver: DataFrame, metric_type: str) -> DataFrame:
    """Flights, mean delays and late share per value of one dimension."""
    dimension = F.col(METRIC_DIMENSIONS[metric_type])
    return (
        with_target(silver)
        .groupBy(dimension.alias("_dimension"))
        .agg(*_delay_measures())
        .select(
            F.lit(metric_type).alias("metric_type"),
            F.col("_dimension").cast("string").alias("metric_key"),
            "flights_cnt",
            "avg_arr_delay",
            "avg_dep_delay",
            "share_delayed_15",
        )
    )


def analytics(silver: DataFrame) -> DataFrame:
    """All four kinds of metric in one long mart.

    Grouping sets read Silver once and shuffle only partial sums, one per value and task. The sets
    are told apart with grouping(), as a dimension may hold real nulls.
    """
    dimensions = {kind: F.col(name) for kind, name in METRIC_DIMENSIONS.items()}
    grouped = (
        with_target(silver)
        .groupingSets([[d] for d in dimensions.values()], *dimensions.values())
        .agg(
            *_delay_measures(),
            *[F.grouping(d).alias(f"_not_{kind}") for kind, d in dimensions.items()],
        )
    )
    metric_type = metric_key = F.lit(None).cast("string")
    for kind, dimension in dimensions.items():
        is_kind = F.col(f"_not_{kind}") == 0
        metric_type = F.when(is_kind, F.lit(kind)).otherwise(metric_type)
        metric_key = F.when(is_kind, dimension.cast("string")).otherwise(metric_key)
    return grouped.select(
        metric_type.alias("metric_type"),
        metric_key.alias("metric_key"),
        "flights_cnt",
        "avg_arr_delay",
        "avg_dep_delay",
        "share_delayed_15",
    )


def union_relaxed(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name, widening each column to a type that holds all of them."""
    stacked = frames[0]
    for frame in frames[1:]:
        if set(frame.columns) != set(stacked.columns):
            raise ValueError(f"Columns {sorted(frame.columns)} differ from {sorted(stacked.columns)}")
        stacked = stacked.unionByName(frame)
    return stacked


def carrier_average_delay(
    silver: DataFrame, year: int, month: int | None = None, min_arr_delay: float = 15.0
) -> DataFrame:
    """Mean arrival delay per carrier over the late flights of a period."""
    return (
        only_batch(silver, year, month)
        .filter(F.col("arr_delay") > float(min_arr_delay))
        .groupBy("carrier")
        .agg(F.avg("arr_delay").alias("avg_arr_delay"))
    )


def feature_frame(
    silver: DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Feature columns with a known arrival delay, unknown inputs filled in."""
    return with_target(only_batch(silver, year, month).select(*FEATURE_COLUMNS)).fillna(
        FEATURE_FILLS
    )


def write_analytics(spark: SparkSession, silver_path: str, path: str) -> DataFrame:
    """Rebuild the analytics mart. One row: rows, version."""
    mart = analytics(tables.read_table(spark, silver_path))
    return _rows_and_version(tables.overwrite_table(mart, path))


def write_features(spark: SparkSession, silver_path: str, path: str) -> DataFrame:
    """Rebuild the feature table, by year and month. One row: rows, version."""
    features = feature_frame(tables.read_table(spark, silver_path))
    load_id = tables.write_load(features, path, PARTITIONS)
    batches = materialise(tables.load_batches(spark, path, load_id, PARTITIONS))
    if batches.isEmpty():
        raise ValueError("The feature table is empty; nothing was written.")
    written = tables.commit(
        spark,
        path,
        batches,
        mode=tables.OVERWRITE,
        load_id=load_id,
        schema=features.schema,
        partition_by=PARTITIONS,
    )
    return _rows_and_version(written)


def _rows_and_version(written: DataFrame) -> DataFrame:
    return written.agg(F.sum("rows").alias("rows"), F.max("commit_version").alias("version"))
