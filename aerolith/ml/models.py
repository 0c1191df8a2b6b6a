"""The models that are compared, as pipeline estimators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.ml.boosting import BoostedClassifier, BoostedRegressor
from aerolith.ml.encoding import FeatureEncoder
from aerolith.ml.features import DELAY_TARGET, FEATURES, LATE_TARGET
from aerolith.ml.trees import BoostedTerms, LinearTerms
from aerolith.session import scratch_path
from aerolith.sources.files import delete_path

# Seed and the settings that the compared models are used with.
SEED = 42
BOOSTING_ROUNDS = 100
LEARNING_RATE = 0.1
LOGISTIC_ITERATIONS = 200
HISTOGRAM_BINS = 255
MIN_LEAF_ROWS = 20
TINY_PENALTY = 1e-5
EARLY_STOP_ROWS = 10_000
EARLY_STOP_GAIN = 1e-7
WATCHING = "_watching"
TASK_ROWS = 100_000  # training rows of one task, beyond which they are dealt to more tasks


def linear_regression(train_rows: int, rounds: int):
    """Least squares. One-hot columns of a feature sum to one, which leaves the weights open; the
    tiny penalty picks the smallest ones and is too small to move predictions.
    """
    return LinearRegression(
        labelCol=DELAY_TARGET, solver="normal", regParam=TINY_PENALTY, standardization=False
    )


def boosted_regressor(train_rows: int, rounds: int):
    """Beyond EARLY_STOP_ROWS a tenth of the rows watches over the rounds and ends them when it gains no more."""
    watched = {}
    if train_rows > EARLY_STOP_ROWS:
        watched = {"validationIndicatorCol": WATCHING, "validationTol": EARLY_STOP_GAIN}
    return BoostedRegressor(
        labelCol=DELAY_TARGET,
        maxIter=rounds,
        stepSize=LEARNING_RATE,
        maxDepth=5,
        maxBins=HISTOGRAM_BINS,
        minInstancesPerNode=MIN_LEAF_ROWS,
        seed=SEED,
        **watched,
    )


def logistic_regression(train_rows: int, rounds: int):
    """L2 strength 1 on the summed loss, which is 1/rows on the mean loss used here."""
    return LogisticRegression(
        labelCol=LATE_TARGET,
        maxIter=LOGISTIC_ITERATIONS,
        standardization=False,
        regParam=1.0 / max(train_rows, 1),
    )


def boosted_classifier(train_rows: int, rounds: int):
    return BoostedClassifier(
        labelCol=LATE_TARGET, maxIter=rounds, stepSize=LEARNING_RATE, maxDepth=3, seed=SEED
    )


REGRESSORS = {"linear_regression": linear_regression, "hgb_regressor": boosted_regressor}
CLASSIFIERS = {"logistic_regression": logistic_regression, "gb_classifier": boosted_classifier}


@dataclass
class DelayModel:
    """A fitted encoder and model for one target."""

    target: str
    encoder: FeatureEncoder
    pipeline: PipelineModel

    @classmethod
    def fit(
        cls,
        name: str,
        prepared: DataFrame,
        encoder: FeatureEncoder,
        *,
        train_rows: int,
        rounds: int = BOOSTING_ROUNDS,
    ) -> DelayModel:
        """Fit a named model on rows the encoder has prepared."""
        target = DELAY_TARGET if name in REGRESSORS else LATE_TARGET
        estimator = (REGRESSORS | CLASSIFIERS)[name](train_rows, rounds)
        if isinstance(estimator, BoostedClassifier | BoostedRegressor):
            estimator.layout = encoder.layout()
        pipeline = Pipeline(stages=[*encoder.vector_stages(), estimator])
        columns = [c for c in prepared.columns if c in FEATURES or c.endswith("_slot")]
        watching = F.pmod(F.xxhash64(F.lit(SEED), *FEATURES, target), F.lit(10)) == 0
        data = prepared.select(
            *columns, F.col(target).cast("double").alias(target), watching.alias(WATCHING)
        )
        if train_rows > TASK_ROWS:
            # A scan split of well-compressed files would hold too many rows.
            parallel = prepared.sparkSession.sparkContext.defaultParallelism
            data = data.repartition(max(parallel, -(-train_rows // TASK_ROWS)))
        fitted = pipeline.fit(data)
        if name == "logistic_regression":
            # Its training summary holds the session, which cannot be sent to tasks; a loaded model has none.
            path = scratch_path(prepared.sparkSession, "fitted")
            fitted.write().save(path)
            fitted = PipelineModel.load(path)
            delete_path(prepared.sparkSession, path)
        return cls(target, encoder, fitted)

    def score_prepared(self, prepared: DataFrame) -> DataFrame:
        """Add `predicted` (a delay or a 0/1 label), and `probability` for a classifier."""
        keep = prepared.columns
        scored = self.pipeline.transform(prepared)
        if self.target == DELAY_TARGET:
            return scored.select(*keep, F.col("prediction").alias("predicted"))
        probability = vector_to_array("probability")[1]
        return scored.select(
            *keep,
            probability.alias("probability"),
            F.when(probability >= 0.5, 1).otherwise(0).cast("int").alias("predicted"),
        )

    def terms(self) -> LinearTerms | BoostedTerms | None:
        """The model for arrays of prepared rows; None for boosted trees that were loaded."""
        fitted = self.pipeline.stages[-1]
        if isinstance(fitted, LinearRegressionModel | LogisticRegressionModel):
            slope = None if self.target == DELAY_TARGET else 1.0
            return LinearTerms(self.encoder.layout(), fitted.coefficients.toArray(), fitted.intercept, slope)
        return getattr(fitted, "terms", None)

    def score(self, features: DataFrame) -> DataFrame:
        """Score rows of the feature table."""
        return self.score_prepared(self.encoder.prepare(features))

    def save(self, path: str) -> None:
        self.encoder.save(f"{path}/encoder")
        self.pipeline.write().overwrite().save(f"{path}/pipeline")

    @classmethod
    def load(cls, spark: SparkSession, path: str, target: str) -> DelayModel:
        encoder = FeatureEncoder.load(spark, f"{path}/encoder")
        return cls(target, encoder, PipelineModel.load(f"{path}/pipeline"))
