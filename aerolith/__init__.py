"""Aerolith: a lakehouse for flight-delay style records, built on PySpark DataFrames."""

__version__ = "0.1.0"
