"""File sinks: Parquet (optionally partitioned) and CSV for dashboards.

These are the only functions here that run a job. Every write is a full
overwrite of the target folder, like the original jobs.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from facetspark.operators.stored import delete, row_width
from facetspark.sources.csv import CSV_OPTIONS

# The CSV writer trims values by default; keep text exactly as it is.
CSV_WRITE_OPTIONS = {
    **CSV_OPTIONS,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _rebalanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Group rows of one partition value into few, evenly sized write tasks.

    Without this, every task writes one file per partition value it holds
    (tasks x values files). Hashing on the partition columns alone would
    send all rows of one value -- possibly a third of the data for a 0/1
    flag -- to a single task. The ``REBALANCE`` hint hashes on the partition
    columns and lets adaptive execution split any partition larger than
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` into several tasks
    and merge small ones, so a hot value is written by as many tasks as its
    size needs and a cold one by one. The split follows the measured map
    output, so a retried task reads the same blocks again.
    """
    return df.hint("rebalance", *partition_by)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  codec: str = "snappy", mode: str = "overwrite",
                  rebalance: bool = False, max_records_per_file: int | None = None) -> None:
    """Write Parquet, optionally partitioned into ``column=value`` folders.

    ``rebalance`` shuffles once so each partition value is written by a few
    tasks of about the advisory size (see ``_rebalanced``); without it there
    is no shuffle and each input task writes one file per value it holds.
    """
    out = _rebalanced(df, list(partition_by)) if (rebalance and partition_by) else df
    writer = out.write.mode(mode).option("compression", codec)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


# What one task may write for a single file: a million rows, 256 MiB of text.
SINGLE_FILE_ROWS = 1_000_000
SINGLE_FILE_BYTES = 256 << 20


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite",
              max_rows: int = SINGLE_FILE_ROWS, max_bytes: int = SINGLE_FILE_BYTES, on_large: str = "parts",
              **options: str) -> bool:
    """Write CSV with a header row, quoting and escaping as the reader expects.

    Values keep their leading and trailing spaces. A null is written as an
    empty field and an empty text as ``""``; ``read_csv(empty_as_null=False)``
    tells the two apart again.

    ``single_file`` merges everything into one part file for a dashboard
    tool. It uses ``coalesce(1)``, which keeps the order of a sorted result
    but also runs everything since the last shuffle in that one task, so it is
    for aggregated (or sorted) results, and bounded: the task stops one row
    beyond ``max_rows``, and rows and bytes are measured in that write. A
    result beyond either bound is written again as part files by all tasks
    (``on_large="parts"``), or removed and refused (``"error"``). Only
    ``overwrite`` can be bounded; other modes take the bound as an error up
    front, from a count.

    Returns whether there is one file.
    """
    if on_large not in ("parts", "error"):
        raise ValueError("on_large is 'parts' or 'error'")
    write = lambda d, m: d.write.mode(m).options(**CSV_WRITE_OPTIONS).options(**options).csv(path)
    if not single_file:
        write(df, mode)
        return False
    if mode != "overwrite":  # what is there must not be written over twice
        rows = df.limit(max_rows + 1).count()
        if rows > max_rows and on_large == "error":
            raise ValueError(f"more than {max_rows} rows for a single file")
        write(df.coalesce(1) if rows <= max_rows else df, mode)
        return rows <= max_rows
    seen = Observation(f"fs_{uuid.uuid4().hex}")
    one = df.coalesce(1).limit(max_rows + 1).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.sum(row_width(df.columns)).alias("bytes"))
    write(one, mode)
    got = seen.get
    if got["rows"] <= max_rows and (got["bytes"] or 0) <= max_bytes:
        return True
    if on_large == "error":
        delete(df.sparkSession, path)
        raise ValueError(f"more than {max_rows} rows or {max_bytes} bytes for a single file")
    write(df, mode)
    return False


def preview(df: DataFrame, n: int = 20, order_by: Sequence | None = None) -> DataFrame:
    """First ``n`` rows, optionally in an order (planned as a top-n, not a full sort)."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)


def partition_sizes(df: DataFrame) -> DataFrame:
    """Row count per physical partition of ``df`` (``partition``, ``n_rows``)."""
    return (df.select(F.spark_partition_id().alias("partition"))
              .groupBy("partition").agg(F.count(F.lit(1)).alias("n_rows")))
