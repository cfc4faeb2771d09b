"""Incremental, verified export of warehouse tables to a Parquet lake, on Spark."""

__version__ = "0.1.0"
