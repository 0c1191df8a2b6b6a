"""(year, month) batches of a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions import as_int
from aerolith.sources.columns import require_column


def _with_batch(df: DataFrame) -> DataFrame:
    return df.select(
        as_int(F.col(require_column(df.columns, "year"))).alias("year"),
        as_int(F.col(require_column(df.columns, "month"))).alias("month"),
    )


def list_batches(df: DataFrame) -> DataFrame:
    """Distinct (year, month) pairs without nulls, in calendar order."""
    return _with_batch(df).dropna().distinct().orderBy("year", "month")


def batch_counts(df: DataFrame) -> DataFrame:
    """Rows per year (month is null in those rows) and per (year, month), from one scan."""
    year, month = F.col("year"), F.col("month")
    return (
        _with_batch(df)
        .dropna()
        .groupingSets([[year], [year, month]], year, month)
        .agg(F.count("*").alias("rows"))
    )


def up_to_year(df: DataFrame, max_year: int | None) -> DataFrame:
    """Keep rows with year <= `max_year`; a bound also drops rows without a year."""
    if max_year is None:
        return df
    return df.filter(as_int(F.col(require_column(df.columns, "year"))) <= int(max_year))


def only_batch(df: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Keep one year, one month, or one (year, month) batch of a curated table."""
    if year is not None:
        df = df.filter(F.col("year") == int(year))
    if month is not None:
        df = df.filter(F.col("month") == int(month))
    return df
