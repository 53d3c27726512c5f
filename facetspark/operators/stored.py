"""Materialise a DataFrame as a Parquet table in the shared checkpoint folder.

Used where a result is read more than once (so it is computed once) or its
contents must not change between jobs, and where its size must be known
before choosing a join strategy. The table is written under the session's
``spark.checkpoint.dir`` (a shared file system on a cluster), so a lost
executor cannot lose it; lineage is cut at the read-back.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from facetspark.session import scratch_dir


_scope: ContextVar[list[str] | None] = ContextVar("stored_tables", default=None)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system its path names."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside this block are deleted at its end.

    Frames that read them must be used up (written or collected) before.
    Threads take part when they run in a copy of this thread's context.
    """
    mine: list[str] = []
    token = _scope.set(mine)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in mine:
            delete(spark, path)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def row_width(columns: Sequence[str]) -> Column:
    """Upper estimate of a row's size: text length of each value plus 8 bytes."""
    return sum((F.coalesce(F.octet_length(_q(c).cast("string")), F.lit(0)) + F.lit(8) for c in columns),
               F.lit(0))


def materialise(df: DataFrame, name: str, measure: bool = False) -> tuple[DataFrame, tuple[int, int] | None]:
    """Write ``df`` under the shared checkpoint folder and read it back.

    With ``measure`` the same write also yields ``(rows, estimated bytes)``
    through ``observe`` (no second pass).
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    if (mine := _scope.get()) is not None:
        mine.append(path)
    obs = None
    if measure:
        obs = Observation(f"fs_{uuid.uuid4().hex}")
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                        F.coalesce(F.sum(row_width(df.columns)), F.lit(0)).alias("bytes"))
    df.write.mode("overwrite").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    if obs is None:
        return back, None
    m = obs.get
    return back, (int(m["rows"]), int(m["bytes"]))
