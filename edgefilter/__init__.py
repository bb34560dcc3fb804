"""edgefilter: similarity search and stream bot-filtering as Spark DataFrame jobs."""

__version__ = "0.1.0"
