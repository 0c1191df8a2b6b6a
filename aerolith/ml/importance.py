"""Permutation importance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.ml import trees
from aerolith.ml.features import DELAY_TARGET, FEATURES
from aerolith.ml.metrics import accuracy, r_squared, r_squared_of
from aerolith.ml.trees import BoostedTerms, LinearTerms
from aerolith.session import materialise

REPEATS = 5  # fixed value: shuffles per feature
BLOCK_ROWS = 4_096  # rows that are shuffled among themselves, at most on average


def ticket(target: str) -> Column:
    """A number for each row that has nothing to do with its values: the MD5 of its text."""
    return F.md5(F.concat_ws("|", "flight_key", *[F.col(c).cast("string") for c in (*FEATURES, target)]))


def block_digits(rows: int) -> int:
    """How many leading digits of the ticket name a block."""
    digits = 0
    while rows > BLOCK_ROWS << (4 * digits):
        digits += 1
    return digits


def permutation_importance(
    score: Callable[[DataFrame], DataFrame],
    test: DataFrame,
    target: str,
    repeats: int = REPEATS,
    terms: LinearTerms | BoostedTerms | None = None,
) -> DataFrame:
    """Mean loss of quality when one feature is shuffled: `feature`, `importance`, largest first.

    `score` adds `predicted`; quality is R2 for delays and accuracy for the late flag. All rows of the test
    part are shuffled and scored, for all features in one job. A shuffle stays inside blocks of rows named by
    the first digits of their tickets, so no task holds more than a block: within a block, in order of
    tickets, each row takes the feature's value of the row a fixed number of places further on. Where `test` is
    prepared, a feature's slot moves with its value, so that `score` need not look up any again. Given the `terms` of
    a model, prepared rows are scored as arrays, with the same shuffles: what a feature has no part in is computed
    once for all of them.
    """
    trials = [("", 0)] + [(name, 1 + i * repeats + k) for i, name in enumerate(FEATURES) for k in range(repeats)]
    scores = _scored(score, test, target, trials) if terms is None else _scored_arrays(terms, test, target, trials)
    scores = materialise(scores)
    baseline = scores.filter("feature = ''").first()
    return (
        scores.filter("feature <> ''")
        .groupBy("feature")
        .agg((F.lit(baseline.score if baseline else None).cast("double") - F.avg("score")).alias("importance"))
        .orderBy(F.abs("importance").desc(), "feature")
    )


def _in_blocks(rows: DataFrame, digits: int) -> DataFrame:
    """Rows with the block of their ticket, dealt to tasks by it."""
    # Few bytes, much to score: a fixed number of tasks, else Spark would merge them by size.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.withColumn("block", F.substring("ticket", 1, digits)).repartition(tasks, "block")


def _scored_arrays(
    terms: LinearTerms | BoostedTerms, test: DataFrame, target: str, trials: list[tuple[str, int]]
) -> DataFrame:
    """`feature`, `places`, `score` of every trial, where a model's terms do the scoring."""
    numbers = [F.col(name).cast("double").alias(name) for name in terms.layout.numbers]
    slots = [f"{name}_slot" for name in terms.layout.slots]
    # Tickets follow from the values as they are; the model takes numbers.
    ordered = (
        _in_blocks(test.withColumn("ticket", ticket(target)), block_digits(test.count()))
        .sortWithinPartitions("block", "ticket", *FEATURES, target)
        .select("block", *numbers, *slots, F.col(target).cast("double").alias(target))
    )
    sums = ordered.mapInArrow(
        lambda batches: trees.block_sums(batches, terms, target, trials),
        "feature string, places int, rows bigint, score double",
    )
    share = F.sum("score") / F.sum("rows")
    totals = sums.groupBy("feature", "places")
    if target != DELAY_TARGET:
        return totals.agg(share.alias("score"))
    # The spread of the delays is the same in all trials.
    spread = test.agg(F.var_pop(F.col(target).cast("double"))).first()[0]
    return totals.agg(r_squared_of(share, F.lit(spread).cast("double")).alias("score"))


def _scored(
    score: Callable[[DataFrame], DataFrame], test: DataFrame, target: str, trials: list[tuple[str, int]]
) -> DataFrame:
    """`feature`, `places`, `score` of every trial, where a function adds `predicted` to the shuffled rows."""
    goes_with = {name: [c for c in (name, f"{name}_slot") if c in test.columns] for name in FEATURES}
    moving = [(name, c) for name, columns in goes_with.items() for c in columns]
    rows = test.select(*[c for _, c in moving], F.col(target).alias(target), ticket(target).alias("ticket"))
    member = F.struct("ticket", *FEATURES, target, *[c for name, c in moving if c != name])
    rows = _in_blocks(rows, block_digits(test.count()))
    blocks = rows.groupBy("block").agg(
        F.sort_array(F.collect_list(member)).alias("members")
    )
    listed = [F.struct(F.lit(name).alias("feature"), F.lit(n).alias("places")) for name, n in trials]
    tried = blocks.select("members", F.explode(F.array(*listed)).alias("trial"))
    # The rows of a trial beside themselves moved on by its number of places, round the end of the block.
    places = F.col("trial.places") % F.size("members")
    moved = F.concat(
        F.slice("members", places + 1, F.size("members")), F.slice("members", F.lit(1), places)
    )
    paired = tried.select("trial", F.explode(F.arrays_zip(F.col("members").alias("own"), moved.alias("other"))).alias("pair"))
    shuffled = paired.select(
        "trial.feature",
        "trial.places",
        *[
            F.when(F.col("trial.feature") == name, F.col(f"pair.other.{c}")).otherwise(F.col(f"pair.own.{c}")).alias(c)
            for name, c in moving
        ],
        F.col(f"pair.own.{target}").alias(target),
    )
    actual, predicted = F.col(target).cast("double"), F.col("predicted").cast("double")
    quality = r_squared if target == DELAY_TARGET else accuracy
    return score(shuffled).groupBy("feature", "places").agg(quality(actual, predicted).alias("score"))
