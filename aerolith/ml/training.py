"""Training runs: split, encode, fit, score, log."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.ml import runs
from aerolith.ml.encoding import FeatureEncoder
from aerolith.ml.features import (
    DELAY_TARGET,
    FEATURES,
    LATE_TARGET,
    load_features,
)
from aerolith.ml.importance import permutation_importance
from aerolith.ml.metrics import classification_metrics, regression_metrics
from aerolith.ml.models import BOOSTING_ROUNDS, CLASSIFIERS, REGRESSORS, DelayModel
from aerolith.operators.ranking import row_cap, time_split
from aerolith.operators.silver import LATE_MINUTES
from aerolith.sources import tables

# Experiment names of the two kinds of training.
REGRESSION_EXPERIMENT = "flight_delays_regression"
CLASSIFICATION_EXPERIMENT = "flight_delays_classification"


def train(
    spark: SparkSession,
    features_path: str,
    runs_path: str,
    *,
    models: Sequence[str],
    experiment: str,
    feature_table_version: int | None = None,
    max_rows: int | None = None,
    rounds: int = BOOSTING_ROUNDS,
) -> DataFrame:
    """Fit the named models of one kind on the feature table and log a run for each.

    All rows take part. `max_rows` is an optional bound on the rows that classifiers learn from: the first
    ones of the training part by date and key. Regression, and the test part of either kind, stay
    whole. Returns the logged runs of this call.
    """
    version = feature_table_version
    if version is None or version < 0:
        version = tables.latest_version(spark, features_path)
    train_part, test_part = time_split(load_features(spark, features_path, version))
    bound = max_rows if max_rows and max_rows > 0 and not set(models) & set(REGRESSORS) else None
    train_part = row_cap(train_part, bound)
    columns = ["flight_key", *FEATURES, DELAY_TARGET, LATE_TARGET]
    encoder = FeatureEncoder.fit(train_part)

    # Every boosting round reads the training rows again.
    prepared = encoder.prepare(train_part.select(*columns)).persist(StorageLevel.MEMORY_AND_DISK)
    test = encoder.prepare(test_part.select(*columns)).persist(StorageLevel.MEMORY_AND_DISK)
    train_rows, test_rows = prepared.count(), test.count()
    run_ids = []
    try:
        for name in models:
            model = DelayModel.fit(name, prepared, encoder, train_rows=train_rows, rounds=rounds)
            kind = "regression" if name in REGRESSORS else "classification"
            scored = model.score_prepared(test).withColumn("actual", F.col(model.target))
            measure = regression_metrics if name in REGRESSORS else classification_metrics
            # Names under which the run log keeps these.
            params = {
                "model_name": name,
                "target": model.target,
                "gold_feature_table_version": version,
                "ml_max_rows": "all" if bound is None else bound,
                "train_rows": train_rows,
                "test_rows": test_rows,
            }
            if kind == "classification":
                params["threshold_minutes"] = int(LATE_MINUTES)
            importances = permutation_importance(
                model.score_prepared, test, model.target, terms=model.terms()
            ).collect()  # one row per feature
            run_id = uuid.uuid4().hex
            model_path = f"{runs_path}/models/{run_id}"
            model.save(model_path)
            runs.log_run(
                spark,
                runs_path,
                run_id,
                experiment=experiment,
                run_name=f"{kind}_{name}",
                params=params,
                metrics=measure(scored).first().asDict(),
                importances={row.feature: row.importance for row in importances},
                feature_table_version=version,
                model_path=model_path,
            )
            run_ids.append(run_id)
    finally:
        prepared.unpersist()
        test.unpersist()
    return runs.read_runs(spark, runs_path).filter(F.col("run_id").isin(*run_ids))


def train_regression(spark: SparkSession, features_path: str, runs_path: str, **options) -> DataFrame:
    """Linear regression and boosted trees for the arrival delay."""
    options.setdefault("experiment", REGRESSION_EXPERIMENT)
    return train(spark, features_path, runs_path, models=list(REGRESSORS), **options)


def train_classification(
    spark: SparkSession, features_path: str, runs_path: str, **options
) -> DataFrame:
    """Logistic regression and boosted trees for the late flag."""
    options.setdefault("experiment", CLASSIFICATION_EXPERIMENT)
    return train(spark, features_path, runs_path, models=list(CLASSIFIERS), **options)
