"""The stages of a full run, and their command line.

    python -m aerolith.plans.stages run --input flights.parquet --root s3a://.../lakehouse
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.ml.models import BOOSTING_ROUNDS
from aerolith.ml.training import train_classification, train_regression
from aerolith.operators.bronze import append_batches, check_load
from aerolith.operators.gold import write_analytics, write_features
from aerolith.operators.maintenance import Z_ORDER_COLUMNS, maintenance_report
from aerolith.operators.silver import build_silver
from aerolith.plans import inspect
from aerolith.session import get_spark, size_for
from aerolith.sources import tables
from aerolith.sources.files import folder_bytes, resolve_input, scan_source

# Where the tables of a run lie below its root.
BRONZE = "bronze/flights"
SILVER = "silver/flights"
GOLD_ANALYTICS = "gold/analytics"
GOLD_FEATURES = "gold/features"
RUNS = "ml/runs"


def load_bronze(
    spark: SparkSession,
    bronze_path: str,
    input_path: str | None = None,
    *,
    reset: bool = False,
    max_year: int | None = None,
) -> DataFrame:
    """Load a CSV or Parquet source into Bronze, with the source position of every row."""
    input_path = resolve_input(spark, input_path)
    size_for(spark, folder_bytes(spark, input_path))
    source = scan_source(spark, input_path, ingest_order=True)
    return append_batches(spark, source, bronze_path, max_year=max_year, reset=reset)


def run_layers(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    *,
    folders: dict[str, str] | None = None,
    order_by: Sequence[str] | None = None,
    max_year: int | None = None,
    ml_max_rows: int | None = None,
    rounds: int = BOOSTING_ROUNDS,
    with_models: bool = True,
) -> DataFrame:
    """Bronze, Silver, both Gold tables and the training runs, from a source frame.

    One row: what became of the source rows (rows without year or month are rejected), rows and versions of
    the tables and the number of training runs.
    """
    paths = {
        name: f"{root}/{folder}"
        for name, folder in (
            ("bronze", BRONZE),
            ("silver", SILVER),
            ("gold_analytics", GOLD_ANALYTICS),
            ("gold_features", GOLD_FEATURES),
        )
    } | (folders or {})
    loaded = append_batches(spark, source, paths["bronze"], max_year=max_year).first()
    build_silver(
        spark, paths["bronze"], paths["silver"], order_by=order_by, max_year=max_year
    )
    write_analytics(spark, paths["silver"], paths["gold_analytics"])
    features = write_features(spark, paths["silver"], paths["gold_features"]).first()
    runs = 0
    if with_models:
        for train in (train_regression, train_classification):
            runs += train(
                spark,
                paths["gold_features"],
                f"{root}/{RUNS}",
                feature_table_version=features.version,
                max_rows=ml_max_rows,
                rounds=rounds,
            ).count()
    columns = [
        F.lit(loaded[name]).cast("bigint").alias(name)
        for name in ("source_rows", "skipped_rows", "rejected_rows", "malformed_rows")
    ]
    for name, path in paths.items():
        live = tables.live_entries(spark, path).agg(F.sum("rows")).first()[0]
        columns += [
            F.lit(live).cast("bigint").alias(f"{name}_rows"),
            F.lit(tables.latest_version(spark, path)).cast("int").alias(f"{name}_version"),
        ]
    return spark.range(1).select(*columns, F.lit(runs).cast("bigint").alias("training_runs"))


def full_run(
    spark: SparkSession, root: str, input_path: str | None = None, **options
) -> DataFrame:
    """`run_layers` from a source file."""
    input_path = resolve_input(spark, input_path)
    size_for(spark, folder_bytes(spark, input_path))
    source = scan_source(spark, input_path, ingest_order=True)
    return run_layers(spark, source, root, **options)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description="Flight-delay lakehouse stages")
    stages = parser.add_subparsers(dest="stage", required=True)

    def stage(name: str, text: str) -> argparse.ArgumentParser:
        sub = stages.add_parser(name, help=text)
        sub.add_argument("--root", default="lakehouse", help="folder of all tables")
        return sub

    bronze = stage("bronze", "load raw files")
    bronze.add_argument("--input")
    bronze.add_argument("--output")
    bronze.add_argument("--reset", action="store_true")
    bronze.add_argument("--max-year", type=int)

    silver = stage("silver", "clean, key and deduplicate")
    silver.add_argument("--bronze")
    silver.add_argument("--silver")
    silver.add_argument("--max-year", type=int)
    silver.add_argument("--order-by", nargs="+")
    silver.add_argument("--null-safe-key", action="store_true")
    silver.add_argument("--changed-only", action="store_true", help="leave months alone that Bronze has not changed")

    for name in ("analytics", "features"):
        gold = stage(name, f"rebuild the {name} table")
        gold.add_argument("--silver")
        gold.add_argument("--output")

    for name in ("train-regression", "train-classification"):
        training = stage(name, "fit and log two models")
        training.add_argument("--feature-table")
        training.add_argument("--runs")
        training.add_argument("--experiment")
        training.add_argument("--gold-features-version", type=int, default=-1)
        training.add_argument("--max-rows", type=int)
        training.add_argument("--rounds", type=int, default=BOOSTING_ROUNDS)

    upkeep = stage("maintain", "time travel, compact, z-order, vacuum (dry), evolve")
    upkeep.add_argument("--table", required=True)
    upkeep.add_argument("--time-travel-version", type=int, default=0)
    upkeep.add_argument("--zorder-cols", nargs="+", default=list(Z_ORDER_COLUMNS))

    plan = stage("explain", "plan of the example query")
    plan.add_argument("--table")
    plan.add_argument("--year", type=int, default=inspect.EXAMPLE_YEAR)
    plan.add_argument("--month", type=int, default=inspect.EXAMPLE_MONTH)
    plan.add_argument("--min-arr-delay", type=float, default=inspect.EXAMPLE_MIN_DELAY)

    run = stage("run", "all stages in order")
    run.add_argument("--input")
    for name in ("bronze", "silver", "gold-analytics", "gold-features"):
        run.add_argument(f"--{name}", help=f"folder of the {name} table, if not below the root")
    run.add_argument("--max-year", type=int)
    run.add_argument("--ml-max-rows", type=int)
    run.add_argument("--rounds", type=int, default=BOOSTING_ROUNDS)
    return parser


def _run_stage(spark: SparkSession, args: argparse.Namespace) -> DataFrame | str:
    root = args.root.rstrip("/")
    bronze, silver = f"{root}/{BRONZE}", f"{root}/{SILVER}"
    if args.stage == "bronze":
        result = load_bronze(
            spark, args.output or bronze, args.input, reset=args.reset, max_year=args.max_year
        )
        check_load(result)
        return result
    if args.stage == "silver":
        size_for(spark, folder_bytes(spark, args.bronze or bronze))
        return build_silver(
            spark,
            args.bronze or bronze,
            args.silver or silver,
            order_by=args.order_by,
            max_year=args.max_year,
            null_safe_key=args.null_safe_key,
            changed_only=args.changed_only,
        )
    if args.stage in ("analytics", "features"):
        size_for(spark, folder_bytes(spark, args.silver or silver))
    if args.stage == "analytics":
        return write_analytics(spark, args.silver or silver, args.output or f"{root}/{GOLD_ANALYTICS}")
    if args.stage == "features":
        return write_features(spark, args.silver or silver, args.output or f"{root}/{GOLD_FEATURES}")
    if args.stage.startswith("train-"):
        train = train_regression if args.stage == "train-regression" else train_classification
        options = {"experiment": args.experiment} if args.experiment else {}
        return train(
            spark,
            args.feature_table or f"{root}/{GOLD_FEATURES}",
            args.runs or f"{root}/{RUNS}",
            feature_table_version=args.gold_features_version,
            max_rows=args.max_rows,
            rounds=args.rounds,
            **options,
        ).drop("model_path")
    if args.stage == "maintain":
        size_for(spark, folder_bytes(spark, args.table))
        return maintenance_report(
            spark, args.table, version=args.time_travel_version, columns=args.zorder_cols
        )
    if args.stage == "explain":
        return inspect.explain_carrier_average(
            spark, args.table or silver, args.year, args.month, args.min_arr_delay
        )
    return full_run(
        spark,
        root,
        args.input,
        folders={
            name: path
            for name in ("bronze", "silver", "gold_analytics", "gold_features")
            if (path := getattr(args, name))
        },
        max_year=args.max_year,
        ml_max_rows=args.ml_max_rows,
        rounds=args.rounds,
    )


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    result = _run_stage(get_spark(f"aerolith-{args.stage}"), args)
    if isinstance(result, str):
        print(result)
        return
    for row in result.collect():  # a report: one row, or one per model
        print(json.dumps(row.asDict(recursive=True), indent=2, default=str))


if __name__ == "__main__":
    main()
