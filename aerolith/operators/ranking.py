"""Positions and running totals over a whole data set, without a window in a single task.

A window without partition keys moves all rows to one task. Here rows are sorted across tasks
instead; each task numbers or sums its own stretch and adds what lies before it. Only one total per
task is ever brought together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aerolith.session import materialise

_ROW_BITS = 33  # monotonically_increasing_id() keeps the row number of a task in its low 33 bits


def _sorted_stretches(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows in order with the stretch (task) they fell in and their place in it, materialised."""
    ranked = df.orderBy(*order) if order else df
    ranked = materialise(ranked.withColumn("_slot", F.monotonically_increasing_id()))
    return ranked.withColumn("_stretch", F.shiftright("_slot", _ROW_BITS))


def with_position(df: DataFrame, order: Sequence[Column] = ()) -> DataFrame:
    """Add `position`, counted from 0, in the given order (any fixed order when there is none)."""
    ranked = _sorted_stretches(df, order)
    before = W.orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        ranked.groupBy("_stretch")
        .agg(F.count("*").alias("_rows"))
        .select("_stretch", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.col("_slot") - F.shiftleft(F.col("_stretch"), _ROW_BITS)
    # One row per task of the sort: bounded by the number of shuffle partitions.
    return (
        ranked.join(F.broadcast(offsets), "_stretch")
        .withColumn("position", F.col("_offset") + place)
        .drop("_slot", "_stretch", "_offset")
    )


def with_running_totals(
    df: DataFrame, order: Sequence[Column], sums: Sequence[str]
) -> DataFrame:
    """Add `total_<c>` for each column: its sum over all rows up to and including this one."""
    ranked = _sorted_stretches(df, order)
    before = W.orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        ranked.groupBy("_stretch")
        .agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
        .select(
            "_stretch",
            *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in sums],
        )
    )
    within = W.partitionBy("_stretch").orderBy("_slot").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        ranked.withColumns({f"_within_{c}": F.sum(c).over(within) for c in sums})
        .join(F.broadcast(offsets), "_stretch")
        .withColumns({f"total_{c}": F.col(f"_before_{c}") + F.col(f"_within_{c}") for c in sums})
        .drop("_slot", "_stretch", *[f"_{p}_{c}" for c in sums for p in ("before", "within")])
    )


def first_rows(
    df: DataFrame, n: int, date: str = "flight_date", key: str = "flight_key"
) -> tuple[DataFrame, DataFrame]:
    """Split into the first `n` rows by (date, key, hash of the row) and the rest, nulls first.

    Rows per date tell on which date the cut falls, then rows per key of that date at which key,
    and so on; as these are counts, a value shared by very many rows is no burden. The parts are
    plain filters on the input, so nothing is sorted or moved. Only when the cut runs through copies
    of one row are these copies numbered and dealt out.
    """
    nothing = df.filter(F.lit(False))
    if n <= 0:
        return nothing, df
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
    before_cut, at_cut, wanted = F.lit(False), F.lit(True), n
    for value in (F.col(date), F.col(key), row_hash):
        counts = df.filter(at_cut).groupBy(value.alias("value")).agg(F.count("*").alias("rows"))
        running = with_running_totals(counts, [F.col("value").asc_nulls_first()], ["rows"])
        cut = running.filter(F.col("total_rows") >= wanted).orderBy("total_rows").first()
        if cut is None:
            return df, nothing
        sorts_before, is_same = _compare(value, cut.value)
        before_cut = before_cut | (at_cut & sorts_before)
        at_cut = at_cut & is_same
        wanted -= cut.total_rows - cut.rows
        if wanted == cut.rows:
            head = before_cut | at_cut
            return df.filter(head), df.filter(~head)
    copies = with_position(df.filter(at_cut))
    first = F.col("position") < wanted
    return (
        df.filter(before_cut).unionByName(copies.filter(first).drop("position")),
        df.filter(~(before_cut | at_cut)).unionByName(copies.filter(~first).drop("position")),
    )


def _compare(column: Column, value) -> tuple[Column, Column]:
    """Conditions 'sorts before the value' and 'is the value', never null, nulls first."""
    if value is None:
        return F.lit(False), column.isNull()
    return column.isNull() | (column < F.lit(value)), column.eqNullSafe(F.lit(value))


def time_split(
    df: DataFrame, test_fraction: float = 0.2, date: str = "flight_date", key: str = "flight_key"
) -> tuple[DataFrame, DataFrame]:
    """Train and test parts: the oldest rows train, the newest `test_fraction` tests."""
    return first_rows(df, int(df.count() * (1.0 - test_fraction)), date, key)


def row_cap(
    df: DataFrame, limit: int | None, date: str = "flight_date", key: str = "flight_key"
) -> DataFrame:
    """The first `limit` rows by date and key; everything without a limit."""
    return df if limit is None else first_rows(df, limit, date, key)[0]
