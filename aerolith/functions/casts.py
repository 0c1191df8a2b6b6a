"""Casts that turn a value they cannot convert into null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_int(value: Column) -> Column:
    return value.try_cast("int")


def as_tinyint(value: Column) -> Column:
    return value.try_cast("tinyint")


def as_double(value: Column) -> Column:
    return value.try_cast("double")


def as_text(value: Column) -> Column:
    return value.cast("string")


def upper_text(value: Column) -> Column:
    return F.upper(as_text(value))
