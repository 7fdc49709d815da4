"""Market-snapshot analytics on Spark: typed, versioned DataFrames over captured pages."""

__version__ = "0.1.0"
