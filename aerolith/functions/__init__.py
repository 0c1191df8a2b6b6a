"""Scalar expressions: casts, calendar features and record keys."""

from aerolith.functions.calendar import departure_hour, flight_date, iso_weekday, season
from aerolith.functions.casts import as_double, as_int, as_text, as_tinyint, upper_text
from aerolith.functions.keys import business_key, ordinal_key, row_hash_key

__all__ = [
    "as_double",
    "as_int",
    "as_text",
    "as_tinyint",
    "business_key",
    "departure_hour",
    "flight_date",
    "iso_weekday",
    "ordinal_key",
    "row_hash_key",
    "season",
    "upper_text",
]
