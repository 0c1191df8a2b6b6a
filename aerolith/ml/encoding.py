"""From feature columns to a model vector: imputation and capped one-hot encoding.

Everything is learned from the training part only. What has to be learned comes from counts per
(column, value), so no column is ever gathered in one task, however its values are distributed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.base import Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aerolith.ml.features import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from aerolith.ml.trees import Layout
from aerolith.operators.ranking import with_running_totals
from aerolith.session import materialise

# Output columns per categorical feature, the last one for all rare values together.
MAX_CATEGORIES = 50
RARE = "<rare>"


def value_counts(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """Rows per (column, value) for several columns cast to one type, nulls left out; one scan."""
    return (
        df.select(*[F.col(name).cast(kind).alias(name) for name in columns])
        .unpivot([], list(columns), "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("rows"))
    )


def medians(df: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    """Exact median per numeric column (mean of the middle two for an even count).

    Running totals over sorted values tell which values sit in the middle.
    """
    running = with_running_totals(
        value_counts(df, columns, "double"), [F.col("column"), F.col("value")], ["rows"]
    )
    spans = running.groupBy("column").agg(
        F.sum("rows").alias("n"), (F.min(F.col("total_rows") - F.col("rows"))).alias("start")
    )
    # One row per column.
    placed = running.join(F.broadcast(spans), "column").withColumns(
        {
            "first": F.col("total_rows") - F.col("rows") - F.col("start"),
            "last": F.col("total_rows") - F.col("start") - 1,
        }
    )

    def holds(place):
        return (F.col("first") <= place) & (place <= F.col("last"))

    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    return placed.groupBy("column").agg(
        (
            (F.max(F.when(holds(low), F.col("value"))) + F.max(F.when(holds(high), F.col("value"))))
            / 2
        ).alias("median")
    )


def ranked_categories(df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """Values per categorical column with rows, and rank up to the cap (null beyond it).

    More frequent values rank higher, ties go to the smaller value. `categories` is the number of
    values in the column.
    """
    counts = materialise(value_counts(df, columns, "string"))
    frequent = W.partitionBy("column").orderBy(F.col("rows").desc(), F.col("value"))
    # Each task drops all but its best values before the shuffle.
    top = (
        counts.withColumn("rank", F.row_number().over(frequent))
        .filter(F.col("rank") <= MAX_CATEGORIES)
        .select("column", "value", "rank")
    )
    sizes = counts.groupBy("column").agg(F.count("*").alias("categories"))
    # At most MAX_CATEGORIES rows and one row per column.
    return counts.join(F.broadcast(sizes), "column").join(
        F.broadcast(top), ["column", "value"], "left"
    )


def modes(categories: DataFrame) -> DataFrame:
    """Most frequent value per categorical column, the smallest one on a tie."""
    return categories.filter("rank = 1").select("column", F.col("value").alias("mode"))


def one_hot_slots(categories: DataFrame) -> DataFrame:
    """Output slot per known value: the value itself, or `<rare>` where the cap is exceeded."""
    rare = (F.col("categories") > MAX_CATEGORIES) & ~F.coalesce(
        F.col("rank") < MAX_CATEGORIES, F.lit(False)
    )
    return categories.withColumn("slot", F.when(rare, F.lit(RARE)).otherwise(F.col("value"))).select(
        "column", "value", "rows", "slot"
    )


@dataclass
class FeatureEncoder:
    """Learned imputation values and one-hot slots.

    `known` lists every training value of the columns that have a rare slot: it decides between
    'rare' and 'never seen' and stays a DataFrame, as such a column may have any number of values.
    """

    medians: dict[str, float]
    modes: dict[str, str]
    slots: dict[str, list[str]]
    known: DataFrame

    @classmethod
    def fit(cls, train: DataFrame) -> FeatureEncoder:
        categories = materialise(ranked_categories(train))
        slots = one_hot_slots(categories)
        # At most MAX_CATEGORIES slots per column come to the driver.
        listed = (
            slots.groupBy("column", "slot")
            .agg(F.sum("rows").alias("rows"))
            .orderBy("column", (F.col("slot") == RARE), F.col("rows").desc(), "slot")
            .collect()
        )
        return cls(
            medians={row["column"]: row["median"] for row in medians(train).collect()},
            modes={row["column"]: row["mode"] for row in modes(categories).collect()},
            slots={
                name: [row.slot for row in listed if row["column"] == name]
                for name in CATEGORICAL_FEATURES
            },
            known=materialise(slots.filter(F.col("slot") == RARE).select("column", "value")),
        )

    def impute(self, df: DataFrame) -> DataFrame:
        numbers = {
            name: F.coalesce(F.col(name).cast("double"), F.lit(self.medians.get(name)).cast("double"))
            for name in NUMERIC_FEATURES
        }
        texts = {
            name: F.coalesce(F.col(name), F.lit(self.modes.get(name)).cast("string"))
            for name in CATEGORICAL_FEATURES
        }
        return df.withColumns(numbers | texts)

    def with_slots(self, df: DataFrame) -> DataFrame:
        """Add `<column>_slot` to imputed rows; null for a value never seen in training.

        Frequent values are recognised by literals. Only the tail of a column with a rare slot is
        looked up, and no value there is frequent; rows without a tail value get a spread-out key
        that matches nothing, so that they do not meet in one task either.
        """
        for name in CATEGORICAL_FEATURES:
            own = [slot for slot in self.slots[name] if slot != RARE]
            frequent = F.col(name).isin(*own) if own else F.lit(False)
            if RARE not in self.slots[name]:
                df = df.withColumn(f"{name}_slot", F.when(frequent, F.col(name)))
                continue
            nowhere = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.lit(4096)))
            tail = self.known.filter(F.col("column") == name).select(
                F.col("value").alias("_tail"), F.lit(RARE).alias("_rare")
            )
            df = (
                df.withColumn("_tail", F.when(frequent, nowhere).otherwise(F.col(name)))
                .join(tail, "_tail", "left")
                .withColumn(f"{name}_slot", F.when(frequent, F.col(name)).otherwise(F.col("_rare")))
                .drop("_tail", "_rare")
            )
        return df

    def prepare(self, df: DataFrame) -> DataFrame:
        return self.with_slots(self.impute(df))

    def layout(self) -> Layout:
        """The features of the model vector in their order."""
        return Layout(list(NUMERIC_FEATURES), {name: self.slots[name] or [RARE] for name in CATEGORICAL_FEATURES})

    def vector_stages(self) -> list[Transformer | OneHotEncoder]:
        """Pipeline stages from imputed columns and slots to `features`.

        An unseen value takes the index after the last slot, which the encoder drops: all zeros.
        """
        slots = [f"{name}_slot" for name in CATEGORICAL_FEATURES]
        indexes = [f"{name}_index" for name in CATEGORICAL_FEATURES]
        vectors = [f"{name}_vector" for name in CATEGORICAL_FEATURES]
        indexers = [
            StringIndexerModel.from_labels(
                self.slots[name] or [RARE], inputCol=slot, outputCol=index, handleInvalid="keep"
            )
            for name, slot, index in zip(CATEGORICAL_FEATURES, slots, indexes)
        ]
        encoder = OneHotEncoder(inputCols=indexes, outputCols=vectors, dropLast=True)
        assembler = VectorAssembler(inputCols=[*NUMERIC_FEATURES, *vectors], outputCol="features")
        return [*indexers, encoder, assembler]

    def save(self, path: str) -> None:
        spark = self.known.sparkSession
        fills = [(name, value, None) for name, value in self.medians.items()]
        fills += [(name, None, value) for name, value in self.modes.items()]
        spark.createDataFrame(fills, "column string, number double, text string").coalesce(
            1
        ).write.mode("overwrite").parquet(f"{path}/fills")
        spark.createDataFrame(
            list(self.slots.items()), "column string, slots array<string>"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/slots")
        self.known.write.mode("overwrite").parquet(f"{path}/known")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureEncoder:
        fills = spark.read.parquet(f"{path}/fills").collect()
        return cls(
            medians={row["column"]: row.number for row in fills if row.number is not None},
            modes={row["column"]: row.text for row in fills if row.text is not None},
            slots={
                row["column"]: list(row.slots)
                for row in spark.read.parquet(f"{path}/slots").collect()
            },
            known=spark.read.parquet(f"{path}/known"),
        )
