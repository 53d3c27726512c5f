"""facetspark: profile wide tables by category on Spark.

Ingest CSV or Parquet, clean, derive buckets / flags / decades, and compare
groups and overlapping segments with lazy DataFrame operators; write
Parquet or dashboard CSV. See ``facetspark.operators`` and
``facetspark.plans``.
"""

__version__ = "0.1.0"
