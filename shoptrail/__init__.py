"""shoptrail: e-commerce clickstream analytics on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` (or a small set of
DataFrames) built from ``pyspark.sql.functions``; nothing collects to the
driver. See README.md for the operator map.
"""

__version__ = "0.1.0"
