"""Looking at the plan of the example query."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame, SparkSession

from aerolith.operators.gold import carrier_average_delay
from aerolith.sources import tables

# The period and delay of the example query.
EXAMPLE_YEAR = 2018
EXAMPLE_MONTH = 1
EXAMPLE_MIN_DELAY = 15.0


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What `explain` prints."""
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        df.explain(mode)
    return printed.getvalue()


def explain_carrier_average(
    spark: SparkSession,
    silver_path: str,
    year: int = EXAMPLE_YEAR,
    month: int | None = EXAMPLE_MONTH,
    min_arr_delay: float = EXAMPLE_MIN_DELAY,
) -> str:
    """Plan of the mean delay per carrier: partition filters, pushed filters and columns read."""
    silver = tables.read_table(spark, silver_path)
    return plan_text(carrier_average_delay(silver, year, month, min_arr_delay))
