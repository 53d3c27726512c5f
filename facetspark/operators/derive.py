"""Derived columns: score buckets, 0/1 flags, decades."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetspark.functions import expressions as X
from facetspark.functions import presets


def with_bucket(df: DataFrame, source: str, bounds: Sequence[float], labels: Sequence[str],
                target: str = "bucket", null_label: str | None = None) -> DataFrame:
    """Add ``target``: the label of the fixed range ``source`` falls in."""
    return df.withColumn(target, X.bucket(F.col(f"`{source}`"), bounds, labels, null_label))


def with_popularity_bucket(df: DataFrame, source: str = "Popularity", fine: bool = False,
                           target: str = "popularity_bucket") -> DataFrame:
    """The study's popularity buckets: 4 labels, or 10 with ``fine``."""
    if fine:
        return with_bucket(df, source, presets.POPULARITY_BOUNDS_10, presets.POPULARITY_LABELS_10, target)
    return with_bucket(df, source, presets.POPULARITY_BOUNDS_4, presets.POPULARITY_LABELS_4, target)


def with_flags(df: DataFrame, mapping: Mapping[str, str], truthy: object = 1,
               drop_sources: bool = False) -> DataFrame:
    """Add a 0/1 column per ``{source: target}``: 1 where source equals ``truthy``.

    A null source gives 0. With ``drop_sources`` the source columns are
    removed afterwards (a target may reuse a source's name).
    """
    out = df.withColumns({t: X.flag(F.col(f"`{s}`"), truthy) for s, t in mapping.items()})
    if drop_sources:
        targets = {t.lower() for t in mapping.values()}
        drop = [s for s in mapping if s.lower() not in targets]
        out = out.drop(*drop)
    return out


def with_decade(df: DataFrame, date_column: str, target: str = "decade") -> DataFrame:
    """Add ``target`` = first year of the decade of ``date_column`` (bigint).

    Text that is not a date, and missing dates, give a null decade.
    """
    return df.withColumn(target, X.decade(F.col(f"`{date_column}`")))
