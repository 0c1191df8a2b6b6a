"""The log of training runs: a table with one row per fitted model."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.sources import tables

RUN_SCHEMA = (
    "run_id string, experiment string, run_name string, params map<string,string>, "
    "metrics map<string,double>, metrics_json string, importances map<string,double>, "
    "feature_table_version int, model_path string"
)


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    *,
    experiment: str,
    run_name: str,
    params: dict[str, object],
    metrics: dict[str, float],
    importances: dict[str, float],
    feature_table_version: int,
    model_path: str,
) -> None:
    """Append one run."""
    row = (
        run_id,
        experiment,
        run_name,
        {name: str(value) for name, value in params.items()},
        metrics,
        json.dumps(metrics, indent=2),
        importances,
        feature_table_version,
        model_path,
    )
    run = spark.createDataFrame([row], RUN_SCHEMA).coalesce(1)
    tables.append_load(run.withColumn("logged_at", F.current_timestamp()), path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_table(spark, path)


def feature_lineage(spark: SparkSession, runs_path: str, features_path: str) -> DataFrame:
    """Per run: the feature-table version it learned from and when that version was made."""
    made = (
        tables.commits(spark, features_path)
        .groupBy(F.col("commit_version").alias("feature_table_version"))
        .agg(F.max("committed_at").alias("features_committed_at"))
    )
    return (
        read_runs(spark, runs_path)
        .select("run_id", "experiment", "run_name", "feature_table_version", "params", "logged_at")
        .join(made, "feature_table_version", "left")
    )
