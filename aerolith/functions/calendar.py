"""Calendar features of a flight."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months of each named season; every other month (and null) is autumn.
WINTER_MONTHS = (12, 1, 2)
SPRING_MONTHS = (3, 4, 5)
SUMMER_MONTHS = (6, 7, 8)


def season(month: Column) -> Column:
    return (
        F.when(month.isin(*WINTER_MONTHS), "winter")
        .when(month.isin(*SPRING_MONTHS), "spring")
        .when(month.isin(*SUMMER_MONTHS), "summer")
        .otherwise("autumn")
    )


def departure_hour(hhmm: Column) -> Column:
    """Hour of an HHMM departure time, held within 0..23; unknown times count as hour 0."""
    hour = F.floor(F.coalesce(hhmm, F.lit(0)) / 100)
    return F.greatest(F.lit(0), F.least(F.lit(23), hour)).cast("int")


def flight_date(year: Column, month: Column, day: Column) -> Column:
    """Date of a year, month and day; null when there is no such day (30 February)."""
    possible = year.between(0, 9999) & month.between(1, 12) & day.between(1, 31)
    counted = F.when(possible, F.date_add(F.make_date(year, month, F.lit(1)), day - 1))
    return F.when(F.month(counted) == month, counted)


def iso_weekday(date: Column) -> Column:
    """Monday is 1 and Sunday is 7."""
    return (F.weekday(date) + 1).cast("tinyint")
