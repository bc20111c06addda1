"""Security-event analytics on Spark DataFrames, in batch and as streams."""

__version__ = "0.1.0"
