"""vitrine: daily marketplace listing analytics on Spark.

Landing file -> bronze -> silver -> gold star schema, data-quality checks,
period metrics and question routing, all written with DataFrames, Spark SQL
and Structured Streaming.
"""

__version__ = "0.1.0"
