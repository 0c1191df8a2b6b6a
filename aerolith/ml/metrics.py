"""Model quality as aggregates over scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.operators.ranking import with_running_totals

THRESHOLD = 0.5


def predicted_label(probability: Column, threshold: float = THRESHOLD) -> Column:
    """1 where the positive probability reaches the threshold, else 0."""
    return F.when(probability >= threshold, 1).otherwise(0).cast("int")


def r_squared(actual: Column, predicted: Column) -> Column:
    """Share of variance explained; with a constant target 1 for perfect predictions, else 0."""
    return r_squared_of(F.avg((actual - predicted) * (actual - predicted)), F.var_pop(actual))


def r_squared_of(error: Column, variance: Column) -> Column:
    """The same from the mean squared error and the variance."""
    constant = F.when(error == 0.0, 1.0).otherwise(0.0)
    return F.when(variance == 0.0, constant).otherwise(1.0 - error / variance)


def accuracy(actual: Column, predicted: Column) -> Column:
    return F.avg((actual == predicted).cast("double"))


def regression_metrics(
    scored: DataFrame, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """One row: mae, rmse, r2."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    return scored.agg(
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        r_squared(y, p).alias("r2"),
    )


def classification_metrics(
    scored: DataFrame, actual: str = "actual", probability: str = "probability"
) -> DataFrame:
    """One row: roc_auc, f1 of the positive class at the 0.5 threshold, pr_auc.

    All three follow from the positives and negatives per distinct score. roc_auc counts, for each
    score, the negatives that score less (ties count half); pr_auc is the average precision, the sum
    of precision times gain in recall, not an area by trapezoids.
    """
    y, p = F.col(actual), F.col(probability)
    per_score = scored.groupBy(p.alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )
    running = with_running_totals(per_score, [F.col("score").desc()], ["pos", "neg"])
    pos, neg = F.sum("pos"), F.sum("neg")
    called = predicted_label(F.col("score")) == 1
    true_pos = F.sum(F.when(called, F.col("pos")).otherwise(0))
    false_pos = F.sum(F.when(called, F.col("neg")).otherwise(0))
    # Pairs a positive wins or ties, seen from the negatives: positives scoring higher, ties half.
    won = F.sum(F.col("neg") * (F.col("total_pos") - F.col("pos") / 2))
    precision_gain = F.sum(
        F.col("pos") * F.col("total_pos") / (F.col("total_pos") + F.col("total_neg"))
    )
    return running.agg(
        F.when((pos > 0) & (neg > 0), won / (pos.cast("double") * neg)).alias("roc_auc"),
        F.when(true_pos + pos + false_pos == 0, 0.0)
        .otherwise(2 * true_pos / (true_pos + false_pos + pos))
        .alias("f1"),
        F.when(pos > 0, precision_gain / pos).otherwise(0.0).alias("pr_auc"),
    )
