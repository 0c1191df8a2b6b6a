"""Whole runs over the layers, and a look at query plans."""
