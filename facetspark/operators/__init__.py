"""Lazy DataFrame operators: each takes a DataFrame and returns a new one.

Only ``keys.min_support``, ``keys.row_id``, ``keys.index_table``,
``keys.dense_index`` and ``stored.materialise`` run a job while building
their result: they write a small key table, numbered rows or a summary to
the shared checkpoint folder so its size can be checked, its contents
cannot change on a re-run, or it is computed once for several results.
"""

from facetspark.operators.clean import drop_null, lower_case, project_complete, rename, typed
from facetspark.operators.derive import with_bucket, with_decade, with_flags, with_popularity_bucket
from facetspark.operators.keys import (
    dense_index,
    distinct_keys,
    index_table,
    min_support,
    row_id,
    sorted_for_ids,
    supported_keys,
)
from facetspark.operators.profile import (
    correlations,
    counts,
    decade_profile,
    group_stats,
    grouped_summary,
    mean_profile,
    pivot_counts,
    share_of_group,
)
from facetspark.operators.stored import materialise
from facetspark.operators.segments import (
    all_of,
    labelled_profile,
    segment_profile,
    segment_size,
    union_profiles,
)

__all__ = [
    "all_of", "correlations", "counts", "decade_profile", "dense_index", "distinct_keys",
    "drop_null", "group_stats", "grouped_summary", "index_table", "labelled_profile", "lower_case",
    "materialise", "mean_profile", "min_support", "pivot_counts", "project_complete", "rename", "row_id",
    "segment_profile", "segment_size", "share_of_group", "sorted_for_ids", "supported_keys", "typed",
    "union_profiles", "with_bucket",
    "with_decade", "with_flags", "with_popularity_bucket",
]
