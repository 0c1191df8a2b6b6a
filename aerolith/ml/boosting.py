"""Boosted trees whose training rows stay small.

Spark's own boosting keeps a number per slot of every row (about 1.8 kB) and goes through all of them for every level of every
tree. Here a row is a byte per feature, a label and a prediction, and a level is counted per feature. Splits, leaves,
gradients, weights and the early end are those of Spark's `GradientBoostedTrees`, and so is the model that comes out.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.ml import encoding, trees
from aerolith.operators.ranking import with_running_totals

CHUNKED_TASK_ROWS = 1_000_000  # training rows of one task once they are chunks (some 30 MB)
HELD_ROWS = 131_072  # so few rows (4 MB) are counted sooner by the driver than a job starts; larger ones have that many a task at least
REBASE_ROUNDS = 25  # after so many rounds predictions start from the chunks again, which keeps the lineage short
PLAIN_REDUCE_TASKS = 64  # sums of more tasks are added up by tasks before they come to the driver
LEAST_WATCHED_ERROR = 0.01  # as in Spark: the gain that ends boosting is relative to an error of at least this


def number_thresholds(df: DataFrame, columns: list[str], bins: int) -> dict[str, np.ndarray]:
    """Where each numeric column may be split: between all of its values, or between `bins` stretches of about equal rows.

    They follow from counts per value. At most `bins` rows per column come to the driver.
    """
    running = with_running_totals(
        encoding.value_counts(df, columns, "double"), [F.col("column"), F.col("value")], ["rows"]
    )
    spans = running.groupBy("column").agg(
        F.sum("rows").alias("n"), F.count("*").alias("values"), F.min(F.col("total_rows") - F.col("rows")).alias("start")
    )
    middle = F.col("total_rows") - F.col("start") - F.col("rows") / 2
    stretch = F.when(F.col("values") <= bins, F.col("value")).otherwise(F.floor(middle * bins / F.col("n")).cast("double"))
    found = (
        running.join(F.broadcast(spans), "column")  # one row per column
        .groupBy("column", stretch.alias("stretch"))
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
        .collect()
    )
    thresholds = {}
    for name in columns:
        parts = sorted((row.low, row.high) for row in found if row["column"] == name)
        between = np.array([(a[1] + b[0]) / 2 for a, b in zip(parts, parts[1:])], np.float64)
        thresholds[name] = between[~np.isnan(between)]
    return thresholds


def _chunked(dataset: DataFrame, layout: trees.Layout, thresholds: list[np.ndarray], target: str, watching: str | None, loss: str) -> RDD:
    """The training rows as chunks, one Python object for up to `trees.CHUNK_ROWS` rows."""

    def pack(batches):
        for chunk in trees.chunks_of(batches, layout, thresholds, target, watching, loss):
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(chunk, 5)], pa.binary())], names=["chunk"])

    columns = [*layout.columns(), target, *([watching] if watching else [])]
    return dataset.select(*columns).mapInArrow(pack, "chunk binary").rdd.map(lambda row: pickle.loads(row.chunk))


def boost(
    dataset: DataFrame,
    layout: trees.Layout,
    *,
    target: str,
    watching: str | None,
    loss: str,
    rounds: int,
    depth: int,
    bins: int,
    least_rows: int,
    rate: float,
    least_gain: float,
) -> tuple[list[trees.Tree], list[float]]:
    """Trees and their weights."""
    context = dataset.sparkSession.sparkContext
    learning = dataset.filter(~F.col(watching)) if watching else dataset
    found = number_thresholds(learning, layout.numbers, bins)
    thresholds = [found[name] for name in layout.numbers]
    n_numbers = len(thresholds)
    sizes = [len(t) + 1 for t in thresholds] + [len(labels) + 1 for labels in layout.slots.values()]
    packed = _chunked(dataset, layout, thresholds, target, watching, loss).persist(StorageLevel.MEMORY_AND_DISK)
    fitted, weights, best_error, best_rounds = [], [], None, 0
    try:
        n_rows = packed.map(lambda chunk: len(chunk[1])).sum()
        if n_rows == 0:
            raise ValueError("Boosted trees need at least one training row.")
        tasks = max(min(context.defaultParallelism, -(-n_rows // max(HELD_ROWS, 1))), -(-n_rows // CHUNKED_TASK_ROWS))
        base = packed.collect() if n_rows <= HELD_ROWS else packed.coalesce(min(packed.getNumPartitions(), tasks))
        merging = 1 if tasks <= PLAIN_REDUCE_TASKS else 2

        def sums_of(chunks: RDD | list, tree: trees.Tree, level: int, first: bool) -> trees.Sums:
            def counted(part):
                return trees.counted(part, tree, level, sizes, n_numbers, loss, first)

            if isinstance(chunks, list):
                return next(counted(iter(chunks)))
            return chunks.mapPartitions(counted).treeReduce(trees.added, depth=merging)

        def with_trees(chunks: RDD | list, more: list) -> RDD | list:
            if isinstance(chunks, list):
                return [trees.grown(chunk, more, n_numbers) for chunk in chunks]
            return chunks.map(lambda chunk: trees.grown(chunk, more, n_numbers)).persist(StorageLevel.MEMORY_AND_DISK)

        def drop(chunks: RDD | list) -> None:
            if chunks is not base and not isinstance(chunks, list):
                chunks.unpersist()

        state = before = base
        while True:
            tree = trees.Tree.leaf(depth)
            # Counting the first level also brings the predictions up to date.
            sums = sums_of(state, tree, 0, not fitted)
            drop(before)
            if watching and fitted:
                error = sums[2][0] / max(sums[2][1], 1.0)
                if best_error is None:
                    best_error, best_rounds = error, 1
                elif best_error - error < least_gain * max(error, LEAST_WATCHED_ERROR):
                    break
                elif error < best_error:
                    best_error, best_rounds = error, len(fitted)
            if len(fitted) >= rounds:
                break
            for level in range(depth):
                if level:
                    sums = sums_of(state, tree, level, not fitted)
                if not trees.split_level(tree, level, sums, sizes, n_numbers, least_rows):
                    break
            fitted.append(tree)
            weights.append(rate if weights else 1.0)
            if len(fitted) == rounds and not watching:
                break
            before = state
            if len(fitted) % REBASE_ROUNDS == 0:
                state = with_trees(base, list(zip(fitted, weights)))
            else:
                state = with_trees(state, [(tree, weights[-1])])
        drop(state)
    finally:
        packed.unpersist()
    kept = best_rounds if watching else len(fitted)
    return [_on_values(tree, thresholds) for tree in fitted[:kept]], weights[:kept]


def _on_values(tree: trees.Tree, thresholds: list[np.ndarray]) -> trees.Tree:
    """A tree on bins as one on the numbers themselves."""
    at = tree.at.copy()
    for node in np.flatnonzero((tree.feature >= 0) & (tree.feature < len(thresholds))):
        at[node] = thresholds[tree.feature[node]][int(tree.at[node])]
    return trees.Tree(tree.feature, at, tree.value, tree.gain, tree.stats)


def _java_tree(context, tree: trees.Tree, layout: trees.Layout, uid: str):
    """A tree as Spark's model holds it. The impurity of the last leaves is not known and stands as -1."""
    ml, calculator = context._jvm.org.apache.spark.ml, context._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    slices = context._jvm.java.util.Arrays.copyOfRange
    numbers = _py2java(context, Vectors.dense(np.nan_to_num(tree.stats, nan=0.0).ravel())).toArray()
    sides = _py2java(context, Vectors.dense([0.0, 1.0])).toArray()
    other, starts = slices(sides, 0, 1), layout.starts()

    def node(i: int):
        count, total, squares = tree.stats[i]
        impurity = -1.0 if np.isnan(squares) else max(float(squares / count - (total / count) ** 2), 0.0)
        stats = calculator(slices(numbers, 3 * i, 3 * i + 3), int(count))
        value, feature = float(tree.value[i]), int(tree.feature[i])
        if feature < 0:
            return ml.tree.LeafNode(value, impurity, stats)
        if feature < len(layout.numbers):
            split = ml.tree.ContinuousSplit(feature, float(tree.at[i]))
        else:
            split = ml.tree.CategoricalSplit(starts[feature] + int(tree.at[i]), other, 2)
        return ml.tree.InternalNode(
            value, impurity, float(tree.gain[i]), node(2 * i + 1), node(2 * i + 2), split, stats
        )

    return ml.regression.DecisionTreeRegressionModel(uid, node(0), layout.width())


class _Boosted:
    """What both kinds of boosting share. `layout` tells which columns of the rows make up the vector."""

    layout: trees.Layout

    def _boost(self, dataset: DataFrame, loss: str):
        watching = self.getOrDefault("validationIndicatorCol") if self.isSet("validationIndicatorCol") else None
        fitted, weights = boost(
            dataset,
            self.layout,
            target=self.getLabelCol(),
            watching=watching,
            loss=loss,
            rounds=self.getMaxIter(),
            depth=self.getMaxDepth(),
            bins=self.getMaxBins(),
            least_rows=self.getMinInstancesPerNode(),
            rate=self.getStepSize(),
            least_gain=self.getValidationTol(),
        )
        context = dataset.sparkSession.sparkContext
        models = context._gateway.new_array(
            context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(fitted)
        )
        for i, tree in enumerate(fitted):
            models[i] = _java_tree(context, tree, self.layout, f"{self.uid}_{i}")
        weighted = _py2java(context, Vectors.dense(weights)).toArray()
        return fitted, weights, models, weighted

    def _finished(self, java_model, model_class, fitted, weights):
        self._transfer_params_to_java()
        self._java_obj.copyValues(java_model, self._java_obj.extractParamMap())
        model = self._copyValues(model_class(java_model))
        model.terms = trees.BoostedTerms(self.layout, fitted, weights, self.slope)
        return model


class BoostedClassifier(_Boosted, GBTClassifier):
    slope = 2.0  # probability is that of twice the margin

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        fitted, weights, models, weighted = self._boost(dataset, "logistic")
        java = dataset.sparkSession.sparkContext._jvm.org.apache.spark.ml.classification.GBTClassificationModel
        return self._finished(java(self.uid, models, weighted, self.layout.width(), 2), GBTClassificationModel, fitted, weights)


class BoostedRegressor(_Boosted, GBTRegressor):
    slope = None

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        fitted, weights, models, weighted = self._boost(dataset, "squared")
        java = dataset.sparkSession.sparkContext._jvm.org.apache.spark.ml.regression.GBTRegressionModel
        return self._finished(java(self.uid, models, weighted, self.layout.width()), GBTRegressionModel, fitted, weights)
