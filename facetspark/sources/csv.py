"""CSV ingest.

Read options match the song export: a header row, quoted fields that may
span lines, and ``"`` escaped by doubling it. The same option set is used
by the CSV sink so a written file reads back unchanged.

Scale notes: a multi-line CSV file cannot be split, so each file is read by
exactly one task. Feed many files (or convert once to Parquet with
``sinks.write_parquet``) rather than one huge file; ``partitions`` spreads
rows over more tasks right after the scan when the file count is low.
Schema inference costs one extra full pass, so the default is to read text
and convert the needed columns with ``operators.clean.typed`` in the same
pass that uses them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from facetspark.session import spread_target

CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
}


# Null marker for ``empty_as_null=False``: a value no text field holds, so
# only an empty unquoted field (how the writer stores a null) reads as null.
_NO_TEXT = "\u0000"


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None,
             infer_schema: bool = False, sampling_ratio: float = 1.0,
             partitions: int | str | None = None, empty_as_null: bool = True, **options: str) -> DataFrame:
    """Read one or more CSV files (or folders) into a DataFrame.

    ``schema`` (StructType or DDL string) fixes the column types; without it
    every column is a string unless ``infer_schema`` is set, in which case
    Spark samples ``sampling_ratio`` of the rows to guess types.

    By default an empty field -- quoted ``""`` or not -- reads as null, as
    in Spark's CSV reader (so a complete-row filter drops it). With
    ``empty_as_null=False`` a quoted ``""`` stays an empty text and only an
    unquoted empty field is null, which round-trips ``sinks.write_csv``.

    ``partitions``: an int spreads the rows over that many partitions right
    after the scan (round robin). ``"auto"`` does so only when the scan has
    fewer tasks than the cluster's default parallelism -- a few large
    multi-line files, which cannot be split -- so that typing and writing
    run on every core; with many files the scan is left as it is (no shuffle).
    Spark packs small files into one task, so many small files can also be
    spread; that shuffle is small, as the files are.
    """
    reader = spark.read.options(**CSV_OPTIONS)
    if not empty_as_null:
        reader = reader.option("nullValue", _NO_TEXT)
    reader = reader.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", "true").option("samplingRatio", str(sampling_ratio))
    df = reader.csv(path)
    if partitions == "auto":
        want = spread_target(df)
        return df.repartition(want) if want else df
    if partitions:
        df = df.repartition(partitions)
    return df
