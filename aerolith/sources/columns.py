"""Recognising the columns of a flight source under the names different publishers use."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted source names per column, the first match wins, case is ignored.
COLUMN_NAMES = {
    "year": ("year",),
    "month": ("month",),
    "day_of_month": ("dayofmonth", "day_of_month", "day"),
    "dep_delay": ("dep_delay", "depdelay"),
    "arr_delay": ("arr_delay", "arrdelay"),
    "cancelled": ("cancelled", "canceled"),
    "carrier": ("carrier", "op_unique_carrier", "unique_carrier", "marketing_airline_network"),
    "flight_num": ("flight_num", "op_carrier_fl_num", "flight_number"),
    "origin": ("origin", "origin_airport", "origincityname"),
    "dest": ("dest", "destination", "dest_airport", "destcityname"),
    "dep_time_raw": ("dep_time", "deptime", "crs_dep_time", "crsdeptime"),
}
REQUIRED_COLUMNS = ("year", "month", "arr_delay")


def quoted(names: Iterable[str]) -> list[Column]:
    """Columns by name, whatever characters the names contain."""
    return [F.col(f"`{name}`") for name in names]


def find_column(columns: Iterable[str], names: Sequence[str]) -> str | None:
    """The source column that carries the first of `names` present, or None."""
    by_lower = {column.lower(): column for column in columns}
    return next((by_lower[name] for name in names if name in by_lower), None)


def require_column(columns: Sequence[str], canonical: str) -> str:
    found = find_column(columns, COLUMN_NAMES[canonical])
    if found is None:
        raise ValueError(f"No column for '{canonical}' among {list(columns)}")
    return found


def match_columns(columns: Sequence[str]) -> dict[str, str | None]:
    """Source column per canonical name; None where an optional column is absent."""
    return {
        canonical: require_column(columns, canonical)
        if canonical in REQUIRED_COLUMNS
        else find_column(columns, names)
        for canonical, names in COLUMN_NAMES.items()
    }
