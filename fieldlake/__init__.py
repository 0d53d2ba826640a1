"""Operational data pipelines as Spark DataFrames: contracts in, tables and reports out."""

__version__ = "0.1.0"
