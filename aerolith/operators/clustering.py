"""Laying rows out so that files cover narrow ranges of several columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.operators.ranking import with_position
from aerolith.session import materialise
from aerolith.sources.columns import quoted

RANGE_BITS = 8  # values of a column fall into at most 2**RANGE_BITS ranges
MAX_Z_BITS = 62


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [name for name in columns if name in df.columns]


def sort_cluster(df: DataFrame, columns: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Range-partition and sort by the columns that exist; `within` comes first.

    A hash of the row is the last range key: rows that agree on all columns can still be divided
    over several tasks.
    """
    keys = [*within, *[c for c in _present(df, columns) if c not in within]]
    if not keys:
        return df
    ranges = [*quoted(keys), F.xxhash64(*quoted(df.columns))]
    return df.repartitionByRange(*ranges).sortWithinPartitions(*quoted(keys))


def _range_code(column: Column, bounds: Sequence) -> Column:
    """How many bounds are <= the value: a balanced tree of comparisons."""
    if not bounds:
        return F.lit(0)
    middle = len(bounds) // 2
    upper = _range_code(column, bounds[middle + 1 :]) + F.lit(middle + 1)
    return F.when(column >= F.lit(bounds[middle]), upper).otherwise(
        _range_code(column, bounds[:middle])
    )


def with_codes(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """Add `_code_<column>`, an integer in the order of its values (null is 0), and its bits.

    One rule for every size: the distinct values are cut into ranges of equal numbers of values, at most
    2**RANGE_BITS of them (fewer bits where many columns share the 62), and the code is the number of the
    range. The distinct values of all columns come from one scan; only range bounds reach the driver.
    """
    cols = [F.col(name) for name in columns]
    ranges = 1 << max(0, min(RANGE_BITS, MAX_Z_BITS // len(columns) - 1))
    values = materialise(
        df.groupingSets([[c] for c in cols], *cols).agg(
            *[F.grouping(c).alias(f"_not_{name}") for c, name in zip(cols, columns)]
        )
    )
    sizes = values.agg(
        *[F.count_if((F.col(f"_not_{n}") == 0) & F.col(n).isNotNull()).alias(n) for n in columns]
    ).first()
    bits = {}
    for name in columns:
        own = values.filter((F.col(f"_not_{name}") == 0) & F.col(name).isNotNull()).select(name)
        step = max(1, -(-sizes[name] // ranges))
        cut = with_position(own, [F.col(name)]).filter(F.col("position") % step == 0)
        bounds = sorted(row[0] for row in cut.select(name).collect())  # as many as ranges
        code = F.coalesce(_range_code(F.col(name), bounds), F.lit(0)).cast("bigint")
        df = df.withColumn(f"_code_{name}", code)
        bits[name] = max(1, len(bounds).bit_length())
    return df, bits


def with_z_value(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add `z_value`: the codes of the columns with their bits interleaved.

    Bit b of column i becomes bit b * (number of columns) + i.
    """
    order = df.columns
    coded, bits = with_codes(df, columns)
    z = F.lit(0).cast("bigint")
    for i, name in enumerate(columns):
        code = F.col(f"_code_{name}")
        for b in range(bits[name]):
            bit = F.shiftright(code, b).bitwiseAND(F.lit(1).cast("bigint"))
            z = z.bitwiseOR(F.shiftleft(bit, b * len(columns) + i))
    return coded.select(*quoted(order), z.alias("z_value"))


def z_order_rows(df: DataFrame, columns: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Rows laid out along the z curve of the columns, inside the partitions given by `within`."""
    order = df.columns
    return sort_cluster(with_z_value(df, columns), ["z_value"], within).select(*quoted(order))
