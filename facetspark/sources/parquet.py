"""Parquet scans, including folders partitioned as ``column=value``.

Reading a partitioned folder turns the directory names back into columns
(placed last). Without a schema their type is guessed from the names, so a
``bigint`` written column comes back as ``int`` and an empty folder cannot
be read at all; passing the schema fixes both. Filters on partition
columns prune whole folders, and filters on other columns are pushed into
the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str | list[str],
                 schema: StructType | str | None = None, base_path: str | None = None) -> DataFrame:
    """Scan Parquet files or a partitioned folder."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.parquet(*paths)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables stored as ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
