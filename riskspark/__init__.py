"""riskspark: incident analytics on Spark.

Validation, cleaning, exploration queries, K-Means risk profiles and a
random-forest resolution-time model, all as DataFrame / Spark SQL /
``pyspark.ml`` / Structured Streaming operations.
"""

__version__ = "0.1.0"
