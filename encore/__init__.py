"""encore: listening analytics on Spark.

Event messages are validated and split (bronze), enriched with user and song
dimensions (silver), standardised into a typed, month-partitioned table (gold),
and queried by dashboard, recommendation and trend plans. Every operator is a
DataFrame -> DataFrame function, so batch jobs and Structured Streaming queries
share the same code.
"""

__version__ = "0.1.0"
