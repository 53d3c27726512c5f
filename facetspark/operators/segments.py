"""Segment comparison: profiles of several, possibly overlapping, row subsets.

A segment is a named boolean condition ("study", "study and relax and
yoga", ...). One row may belong to several segments, so the segments are
not a grouping of the table. ``segment_profile`` answers all of them in a
single pass: rows in no segment are filtered out (folders pruned when the
table is partitioned by the segment flags), then

* few accumulators (segments x measures): one global aggregation whose
  inputs are masked per segment (``avg(when(in_segment, measure))``), whose
  one wide row is unfolded into one row per segment;
* more: each row's segments become the bits of a number, sums and counts are
  taken per distinct number, and only those few rows are unfolded into their
  segments and added up. The row-level aggregation has one sum and count a
  measure however many segments there are, so it stays in generated code.

In both, a task contributes a few partial rows whatever the data size or skew.
"""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from facetspark.operators.profile import measure_columns, mean_profile

# Accumulators (segments x (measures + 1)) up to which one masked aggregation
# is still compiled with room to spare; and the bits used of a long.
WIDE_MAX = 24
MASK_BITS = 62


def all_of(*flags: str, value: object = 1) -> Column:
    """Condition: every flag column equals ``value``."""
    cond = F.lit(True)
    for f in flags:
        cond = cond & (F.col(f"`{f}`") == F.lit(value))
    return cond


def segment_profile(df: DataFrame, segments: Mapping[str, Column],
                    measures: Mapping[str, str | Column] | Sequence[str],
                    label: str = "tagged_as", count_name: str | None = None,
                    keep_empty: bool = False) -> DataFrame:
    """One row per segment: its label, the average of each measure, optionally its size.

    A row is in a segment where the condition is true (null counts as
    false). Empty segments are left out unless ``keep_empty``; then their
    averages are null and their count 0. Averages that are not double
    (decimal or interval measures) always take the masked form, which keeps
    Spark's own rounding of them.
    """
    ms = measure_columns(measures)
    # A row in no segment adds nothing to any average or count, so keep only
    # rows in at least one: on a table partitioned by the segment flags this
    # prunes every folder where none is set, and elsewhere it is pushed into
    # the scan.
    conds = list(segments.values())
    if conds:
        df = df.where(reduce(operator.or_, conds))
    wide = len(conds) * (len(ms) + 1) <= WIDE_MAX or any(
        not isinstance(f.dataType, DoubleType) for f in df.select(*[F.avg(c) for c in ms.values()]).schema)
    out = (_masked if wide else _by_mask)(df, segments, ms, label)
    if not keep_empty:
        out = out.where(F.col("_n") > 0)
    out_cols = [F.col(f"`{label}`"), *[F.col(f"`{a}`") for a in ms]]
    if count_name:
        out_cols.append(F.col("_n").alias(count_name))
    return out.select(*out_cols)


def _masked(df: DataFrame, segments: Mapping[str, Column], ms: Mapping[str, Column], label: str) -> DataFrame:
    """Every segment (label, averages, _n) from one aggregation of masked measures."""
    aggs = []
    for i, cond in enumerate(segments.values()):
        inside = F.coalesce(cond, F.lit(False))
        aggs.append(F.count(F.when(inside, F.lit(1))).alias(f"_n{i}"))
        aggs.extend(F.avg(F.when(inside, c)).alias(f"_m{i}_{j}") for j, c in enumerate(ms.values()))
    wide = df.agg(*aggs)
    per_segment = [
        F.struct(
            F.lit(name).alias(label),
            *[F.col(f"_m{i}_{j}").alias(alias) for j, alias in enumerate(ms)],
            F.col(f"_n{i}").alias("_n"),
        )
        for i, name in enumerate(segments)
    ]
    return wide.select(F.inline(F.array(*per_segment)))


def _by_mask(df: DataFrame, segments: Mapping[str, Column], ms: Mapping[str, Column], label: str) -> DataFrame:
    """The same rows from sums and counts per set of segments, in segment order."""
    names = list(segments)
    bits = [F.when(cond, F.lit(1 << i % MASK_BITS)).otherwise(F.lit(0)).cast("long")
            for i, cond in enumerate(segments.values())]
    masks = {f"_k{w}": reduce(Column.bitwiseOR, bits[w:w + MASK_BITS]) for w in range(0, len(bits), MASK_BITS)}
    sums, counts = [f"_s{j}" for j in range(len(ms))], [f"_c{j}" for j in range(len(ms))]
    rows = df.select(*[m.alias(k) for k, m in masks.items()],
                     *[c.cast("double").alias(s) for s, c in zip(sums, ms.values())])
    per_set = rows.groupBy(*masks).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(s).alias(s) for s in sums],
                                       *[F.count(s).alias(c) for s, c in zip(sums, counts)])
    member = F.array(*[
        F.when(F.col(f"_k{i - i % MASK_BITS}").bitwiseAND(F.lit(1 << i % MASK_BITS).cast("long")) != 0, F.lit(i))
        for i in range(len(names))])
    parts = per_set.select(F.explode(F.array_compact(member)).alias("_seg"), "_n", *sums, *counts)
    # a segment without rows still has a row: size 0, no average
    none = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(i) for i in range(len(names))])).alias("_seg"), F.lit(0).cast("long").alias("_n"),
        *[F.lit(None).cast("double").alias(s) for s in sums], *[F.lit(0).cast("long").alias(c) for c in counts])
    total = parts.unionByName(none).groupBy("_seg").agg(*[F.sum(c).alias(c) for c in ("_n", *sums, *counts)])
    return total.orderBy("_seg").select(
        F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_seg") + 1).alias(label),
        *[F.when(F.col(c) > 0, F.col(s) / F.col(c)).alias(a) for a, s, c in zip(ms, sums, counts)], "_n")


@dataclass(frozen=True)
class _Profile:
    """What a labelled profile was asked for."""

    table: DataFrame
    condition: Column
    name: str
    measures: Mapping[str, Column]
    label: str
    count_name: str | None

    def shape(self) -> tuple:
        return (id(self.table), self.label, self.count_name, tuple((a, str(c)) for a, c in self.measures.items()))


# Lives as long as the profile's DataFrame does.
_asked: WeakKeyDictionary[DataFrame, _Profile] = WeakKeyDictionary()


def labelled_profile(df: DataFrame, condition: Column, name: str,
                     measures: Mapping[str, str | Column] | Sequence[str],
                     label: str = "tagged_as", count_name: str | None = None) -> DataFrame:
    """Profile of one segment: filter, tag with a constant label, average.

    Filters on partition columns prune folders and the rest are pushed into
    the Parquet scan.
    """
    tagged = df.where(condition).withColumn(label, F.lit(name))
    out = mean_profile(tagged, label, measures, count_name=count_name)
    _asked[out] = _Profile(df, condition, name, measure_columns(measures), label, count_name)
    return out


def union_profiles(profiles: Sequence[DataFrame], share_scan: bool = True) -> DataFrame:
    """UNION ALL of profiles by column name; differing columns raise an error.

    Labelled profiles of one and the same table, with the same measures and
    different labels, are answered together by ``segment_profile``: one masked
    pass over the table instead of a scan each, with the same rows. Neighbours
    in the list that belong together so share a pass; all others (frames that
    ``labelled_profile`` did not make, repeated labels, another table object)
    are united as they are, and ``share_scan=False`` unites all of them so.
    """
    if not profiles:
        raise ValueError("no profile to unite")
    columns = sorted(c.lower() for c in profiles[0].columns)
    for p in profiles[1:]:
        if sorted(c.lower() for c in p.columns) != columns:
            raise ValueError(f"profiles differ in their columns: {profiles[0].columns} and {p.columns}")
    parts: list[DataFrame] = []
    for run in _neighbours(profiles) if share_scan else [[p] for p in profiles]:
        asked = [_asked.get(p) for p in run]
        if len(run) == 1:
            parts += run
            continue
        first = asked[0]
        parts.append(segment_profile(first.table, {a.name: a.condition for a in asked}, first.measures, label=first.label,
                                     count_name=first.count_name))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _neighbours(profiles: Sequence[DataFrame]) -> list[list[DataFrame]]:
    """The profiles in runs that one pass can answer."""
    runs: list[list[DataFrame]] = []
    for p in profiles:
        mine = _asked.get(p)
        last = [_asked.get(q) for q in runs[-1]] if runs else []
        if mine and last and last[0] and last[0].shape() == mine.shape() and mine.name not in {a.name for a in last}:
            runs[-1].append(p)
        else:
            runs.append([p])
    return runs


def segment_size(df: DataFrame, condition: Column, name: str = "n_rows") -> DataFrame:
    """Number of rows in one segment, as a one-row DataFrame."""
    return df.where(condition).agg(F.count(F.lit(1)).alias(name))
