"""Cleaning: keep complete rows of chosen columns, fix types, normalise text.

All lazy; each returns a new DataFrame. Selecting the needed columns first
lets the Parquet scan read only those columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from facetspark.functions.expressions import as_column


def project_complete(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """Select ``columns`` and drop every row with a null (or NaN) in any of them.

    The null check covers only the selected columns, never the whole table.
    """
    projected = df.select(*columns)
    return projected.na.drop(how="any")


def drop_null(df: DataFrame, column: str | Column) -> DataFrame:
    """Keep rows where ``column`` is not null."""
    return df.where(as_column(column).isNotNull())


def typed(df: DataFrame, types: Mapping[str, DataType | str],
          strip_pattern: str | Mapping[str, str] | None = None) -> DataFrame:
    """Convert columns to the given types; values that do not convert become null.

    ``strip_pattern`` (a regex) is removed from text first, e.g. a unit
    suffix such as ``" dB"``; a mapping gives the pattern of single columns
    and leaves the others as they are. Under ANSI mode a plain cast of bad text
    fails the whole job; ``try_cast`` keeps the job alive and the row.
    """
    return df.withColumns(_conversions(types, strip_pattern))


def _conversions(types: Mapping[str, DataType | str], strip_pattern: str | Mapping[str, str] | None) -> dict[str, Column]:
    out = {}
    for name, dtype in types.items():
        c = F.col(f"`{name}`")
        pattern = strip_pattern.get(name) if isinstance(strip_pattern, Mapping) else strip_pattern
        if pattern is not None:
            c = F.regexp_replace(F.trim(c.cast("string")), pattern, "")
        out[name] = c.try_cast(dtype)
    return out


class Conversions:
    """Per typed column, how many values there were and how many typing made
    null. The numbers are there once the counted frame has been written (or
    otherwise run to its end) for the first time; they come with that pass."""

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)
        self.observation = Observation(f"fs_{uuid.uuid4().hex}")

    def counts(self) -> list[tuple[str, int, int, int]]:
        """(column, rows, values, values made null); waits for the pass."""
        got = self.observation.get
        return [(c, int(got["rows"]), int(got[f"v{i}"] or 0), int(got[f"x{i}"] or 0)) for i, c in enumerate(self.columns)]

    def report(self, spark) -> DataFrame:
        """``counts`` as a table: (column_name, n_rows, n_values, n_lost), one row a typed column."""
        return spark.createDataFrame(self.counts(), "column_name string, n_rows long, n_values long, n_lost long")


def typed_counted(df: DataFrame, types: Mapping[str, DataType | str],
                  strip_pattern: str | Mapping[str, str] | None = None) -> tuple[DataFrame, Conversions]:
    """``typed``, and the account of what it made null.

    The counts are observed in whatever pass uses the frame: no second scan.
    An empty field (null) is no value; text such as ``"n/a"`` that is no
    number is a value that is lost. A frame used twice counts its first pass.
    """
    found = Conversions(types)
    source = {f"_fs_source{i}": F.col(f"`{name}`").isNotNull() for i, name in enumerate(types)}
    out = df.withColumns(source).withColumns(_conversions(types, strip_pattern))
    metrics = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(types):
        had = F.col(f"_fs_source{i}")
        metrics += [F.count_if(had).alias(f"v{i}"), F.count_if(had & F.col(f"`{name}`").isNull()).alias(f"x{i}")]
    return out.observe(found.observation, *metrics).drop(*source), found


def lower_case(df: DataFrame, *columns: str) -> DataFrame:
    """Lower-case text columns in place."""
    return df.withColumns({c: F.lower(F.col(f"`{c}`")) for c in columns})


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns (names resolve case-insensitively, as in Spark SQL)."""
    return df.withColumnsRenamed(dict(mapping))
