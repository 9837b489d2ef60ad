"""kiln: table and text preparation, statistics and model jobs on Spark DataFrames."""

__version__ = "0.1.0"
