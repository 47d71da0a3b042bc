"""Tideline: a real-time warehouse and user-label toolkit built on Spark.

Every operator is a function from DataFrames to a DataFrame; callers decide
whether the plan runs as a batch, inside ``foreachBatch`` or as a stream.
Building a batch plan starts no job.
"""

__version__ = "0.1.0"
