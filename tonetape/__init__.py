"""Event studies over price series and filing text, as Spark DataFrames."""

__version__ = "0.1.0"
