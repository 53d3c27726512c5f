"""Column expressions used by the operators.

Everything here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage codegen: no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket(value: str | Column, bounds: Sequence[float], labels: Sequence[str],
           null_label: str | None = None) -> Column:
    """Fixed-boundary bucketing: first label whose bound is greater than the value.

    ``labels`` has one more entry than ``bounds``; the last label takes every
    value at or above the last bound. A null value gives ``null_label``
    (null by default) instead of falling through to the last label.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("need exactly one more label than bounds")
    if list(bounds) != sorted(bounds):
        raise ValueError("bounds must be ascending")
    v = as_column(value)
    expr = F.when(v.isNull(), F.lit(null_label).cast(StringType()))
    for bound, label in zip(bounds, labels):
        expr = expr.when(v < F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def flag(value: str | Column, truthy: object = 1) -> Column:
    """0/1 flag: 1 where the value equals ``truthy``, else 0 (null counts as 0)."""
    v = as_column(value)
    return F.when(v == F.lit(truthy), F.lit(1)).otherwise(F.lit(0))


def try_date(value: str | Column) -> Column:
    """``try_cast(value AS DATE)``: text that is not a date gives null instead of
    an ANSI cast error; dates and timestamps convert as a plain cast would."""
    return as_column(value).try_cast(DateType())


def decade(value: str | Column) -> Column:
    """``floor(year(date) / 10) * 10`` as bigint; null when there is no valid date."""
    return (F.floor(F.year(try_date(value)) / F.lit(10)) * F.lit(10)).cast("bigint")


def percentage(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    """``round(part / whole * 100, digits)``; null when ``whole`` is 0 or null."""
    return F.round(F.try_divide(as_column(part).cast("double"), as_column(whole)) * F.lit(100), digits)


def safe_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation over rows where both sides are non-null.

    Same value as ``corr``, but a column without variance gives null rather
    than a divide-by-zero error under ANSI mode. Each side is masked by the
    other's nullness so the standard deviations use the same row pairs as
    the covariance.
    """
    cx, cy = as_column(x), as_column(y)
    both = cx.isNotNull() & cy.isNotNull()
    mx, my = F.when(both, cx), F.when(both, cy)
    return F.try_divide(F.covar_pop(mx, my), F.stddev_pop(mx) * F.stddev_pop(my))
