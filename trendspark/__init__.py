"""trendspark — social-trend analytics on Spark.

Ranked serving views, a date-partitioned raw archive and an incrementally
loaded star-schema warehouse, all expressed with DataFrames, Spark SQL and
Structured Streaming. Every operator is a ``DataFrame -> DataFrame`` function
so the batch form (checked against SQL oracles) and the streaming form
(``foreachBatch`` / stateful aggregation) share one code path.
"""

__version__ = "0.1.0"
