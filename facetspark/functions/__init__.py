"""Scalar column expressions and the fixed values of the song study."""

from facetspark.functions.expressions import (
    as_column,
    bucket,
    decade,
    flag,
    percentage,
    safe_corr,
    try_date,
)

__all__ = ["as_column", "bucket", "decade", "flag", "percentage", "safe_corr", "try_date"]
