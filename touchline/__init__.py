"""touchline: tracking-data analytics (batch and streaming) on Spark DataFrames."""

__version__ = "0.1.0"
