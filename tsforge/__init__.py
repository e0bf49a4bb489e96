"""Time-series analytics operators for keyed series, written as PySpark DataFrame transformations."""

__version__ = "0.1.0"
