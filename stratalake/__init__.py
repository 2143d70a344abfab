"""Layered (bronze, silver, gold, mart) tables, data checks and table operators on Spark DataFrames."""

__version__ = "0.1.0"
