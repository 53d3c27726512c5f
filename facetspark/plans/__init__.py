"""Composed plans: the SQL surface and the four song studies."""

from facetspark.plans.sql import bucket_average, register, run_sql
from facetspark.plans.studies import (
    category_index,
    category_measure,
    decade_trends,
    flag_profile,
    flag_table,
    score_buckets,
    tag_comparison,
    tag_table,
)

__all__ = [
    "bucket_average", "category_index", "category_measure", "decade_trends", "flag_profile", "flag_table",
    "register", "run_sql", "score_buckets", "tag_comparison", "tag_table",
]
