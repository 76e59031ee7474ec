"""shelfwise: retail sales and stock analytics on Spark DataFrames."""

__version__ = "0.1.0"
