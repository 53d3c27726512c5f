"""SQL surface: register DataFrames as views and run SQL text.

``run_sql`` passes DataFrames as query parameters (``{name}`` in the text),
which avoids session-wide view names; ``register`` keeps the classic
named-view style for callers who want it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register(views: Mapping[str, DataFrame]) -> None:
    """Create or replace one temporary view per ``{name: DataFrame}``."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, views: Mapping[str, DataFrame] | None = None,
            **frames: DataFrame) -> DataFrame:
    """Run SQL text. ``views`` are registered by name first; ``frames`` are
    substituted for ``{name}`` placeholders in the text."""
    if views:
        register(views)
    return spark.sql(text, **frames) if frames else spark.sql(text)


def bucket_average(df: DataFrame, bucket_column: str, measure: str, alias: str | None = None) -> DataFrame:
    """``SELECT bucket, AVG(measure) ... GROUP BY bucket ORDER BY bucket`` as SQL text."""
    name = alias or f"avg_{measure.lower()}"
    text = (f"SELECT `{bucket_column}`, AVG(`{measure}`) AS `{name}` "
            f"FROM {{rows}} GROUP BY `{bucket_column}` ORDER BY `{bucket_column}`")
    return df.sparkSession.sql(text, rows=df)
