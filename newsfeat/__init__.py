"""News article features and models on Spark DataFrames."""

__version__ = "0.1.0"
