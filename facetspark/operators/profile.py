"""Group profiles: statistics, mean profiles, counts, shares, correlations.

Every operator here is one hash aggregation (partial aggregate in each
task, then a shuffle of one row per group and task), so a hot group costs
no more than a cold one and nothing is gathered per group. Sorting is
applied last, on the aggregated rows, with the remaining keys as a
tie-break so the output order is fully defined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from facetspark.functions.expressions import percentage, safe_corr
from facetspark.operators.stored import materialise


def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _all(names: Sequence[str]) -> list[Column]:
    return [_quoted(n) for n in names]


def _measures(measures: Mapping[str, str | Column] | Sequence[str]) -> dict[str, Column]:
    """``{alias: column or expression}``; a plain list becomes ``avg_<lower name>``."""
    if isinstance(measures, Mapping):
        return {alias: _quoted(c) if isinstance(c, str) else c for alias, c in measures.items()}
    return {f"avg_{m.lower()}": _quoted(m) for m in measures}


def group_stats(df: DataFrame, key: str | Sequence[str], measure: str, min_count: int | None = None,
                label: str | None = None, count_name: str = "n", order: bool = True) -> DataFrame:
    """avg, min, max, sample stddev and row count of ``measure`` per key.

    Columns: keys, ``avg_<label>``, ``min_<label>``, ``max_<label>``,
    ``stddev_<label>``, ``count_name``. ``min_count`` keeps groups with at
    least that many rows (inclusive). A one-row group has a null stddev.
    Sorted by the average, then the keys.
    """
    keys = _cols(key)
    lab = label or measure.lower()
    m = _quoted(measure)
    out = df.groupBy(*_all(keys)).agg(
        F.avg(m).alias(f"avg_{lab}"),
        F.min(m).alias(f"min_{lab}"),
        F.max(m).alias(f"max_{lab}"),
        F.stddev_samp(m).alias(f"stddev_{lab}"),
        F.count(F.lit(1)).alias(count_name),
    )
    if min_count is not None:
        out = out.where(F.col(count_name) >= F.lit(min_count))
    if order:
        out = out.orderBy(_quoted(f"avg_{lab}"), *_all(keys))
    return out


def mean_profile(df: DataFrame, by: str | Sequence[str], measures: Mapping[str, str | Column] | Sequence[str],
                 count_name: str | None = None, order: bool = False) -> DataFrame:
    """Average of each measure per group, in one aggregation.

    ``measures`` is either a list of column names (giving ``avg_<name>``) or
    ``{alias: column or expression}``, e.g. ``{"avg_tempo": col("Tempo") * 100}``.
    ``count_name`` adds the group's row count.
    """
    keys = _cols(by)
    aggs = [F.avg(c).alias(a) for a, c in _measures(measures).items()]
    if count_name:
        aggs.append(F.count(F.lit(1)).alias(count_name))
    out = df.groupBy(*_all(keys)).agg(*aggs)
    return out.orderBy(*_all(keys)) if order else out


def decade_profile(df: DataFrame, decade_column: str, measures: Mapping[str, str | Column] | Sequence[str],
                   count_name: str = "n_rows") -> DataFrame:
    """Mean profile per decade, rows without a decade left out, oldest first.

    When the input is a folder partitioned by decade, the not-null filter
    prunes the ``decade=__HIVE_DEFAULT_PARTITION__`` folder unread.
    """
    kept = df.where(_quoted(decade_column).isNotNull())
    return mean_profile(kept, decade_column, measures, count_name=count_name).orderBy(_quoted(decade_column))


def counts(df: DataFrame, keys: str | Sequence[str], count_name: str = "count", order: bool = True) -> DataFrame:
    """Row count per key combination.

    Sorted by the first key ascending, then count descending, then the
    other keys -- with one key, by count descending, then the key.
    """
    ks = _cols(keys)
    out = df.groupBy(*_all(ks)).agg(F.count(F.lit(1)).alias(count_name))
    if not order:
        return out
    if len(ks) == 1:
        return out.orderBy(_quoted(count_name).desc(), _quoted(ks[0]).asc())
    return out.orderBy(_quoted(ks[0]).asc(), _quoted(count_name).desc(), *[k.asc() for k in _all(ks[1:])])


def share_of_group(df: DataFrame, outer: str, inner: str, count_name: str = "count",
                   pct_name: str = "percentage", digits: int = 2, order: bool = True) -> DataFrame:
    """Count of each ``inner`` value within each ``outer`` group, and its share in %.

    ``percentage = round(count / rows of the outer group * 100, digits)``.
    Rows with a null ``outer`` are left out (they have no group to be a
    share of). The group totals are summed from the per-pair counts, so the
    input is scanned once; the totals table has one row per outer value and
    adaptive execution broadcasts it when its measured size is small.
    """
    pair_counts = (df.where(_quoted(outer).isNotNull())
                     .groupBy(*_all([outer, inner])).agg(F.count(F.lit(1)).alias(count_name)))
    totals = pair_counts.groupBy(_quoted(outer)).agg(F.sum(_quoted(count_name)).alias("_group_rows"))
    out = (pair_counts.join(totals, outer)
           .select(*_all([outer, inner, count_name]),
                   percentage(_quoted(count_name), F.col("_group_rows"), digits).alias(pct_name)))
    if order:
        out = out.orderBy(_quoted(outer).asc(), _quoted(pct_name).desc(), _quoted(inner).asc())
    return out


def correlations(df: DataFrame, pairs: Mapping[str, tuple[str, str]], by: str | Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of several column pairs in one pass.

    ``pairs`` maps an output name to ``(x, y)``. Rows where x or y is null
    are ignored for that pair; a pair without variance gives null. Without
    ``by`` the result is one row.
    """
    aggs = [safe_corr(_quoted(x), _quoted(y)).alias(name) for name, (x, y) in pairs.items()]
    if by is None:
        return df.agg(*aggs)
    return df.groupBy(*_all(_cols(by))).agg(*aggs)


PIVOT_VALUES = 2_000


def pivot_counts(df: DataFrame, row_key: str, pivot_column: str, values: Sequence | None = None,
                 names: Sequence[str] | None = None, max_values: int = PIVOT_VALUES) -> DataFrame:
    """Counts per ``row_key`` with one column per value of ``pivot_column``.

    With ``values`` given this is one conditional aggregation (no extra pass
    to find the values). Without it the values are found and counted in the
    same aggregation, as long rows that are stored once; up to ``max_values``
    of them become columns, in ascending order, a null value as ``null``. More
    are an error, raised before anything is widened; ``counts`` gives the same
    figures as rows. Missing combinations count 0 in both forms.
    """
    if values is None:
        cells = df.groupBy(_quoted(row_key).alias("_fs_row"), _quoted(pivot_column).alias("_fs_value")).agg(
            F.count(F.lit(1)).alias("_fs_n"))
        cells, _ = materialise(cells, "pivot-cells")
        text = F.col("_fs_value").cast("string").alias("text")
        found = cells.select("_fs_value", text).distinct().limit(max_values + 1).collect()
        if len(found) > max_values:
            raise ValueError(f"{pivot_column} has more than {max_values} values to make columns of; "
                             "name the values, raise max_values, or take counts() as rows")
        found.sort(key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0))
        sums = [F.coalesce(F.sum(F.when(F.col("_fs_value").eqNullSafe(F.lit(r[0])), F.col("_fs_n"))), F.lit(0)).alias(
            "null" if r[0] is None else r[1]) for r in found]
        row = F.col("_fs_row").alias(row_key)
        return cells.groupBy(row).agg(*sums) if sums else cells.select(row).distinct()
    labels = list(names) if names is not None else [str(v) for v in values]
    p = _quoted(pivot_column)
    aggs = [F.count(F.when(p == F.lit(v), F.lit(1))).alias(n) for v, n in zip(values, labels)]
    return df.groupBy(_quoted(row_key)).agg(*aggs)


def grouped_summary(df: DataFrame, sets: Sequence[Sequence[str]],
                    measures: Mapping[str, str | Column] | Sequence[str] = (),
                    count_name: str = "count", set_name: str = "_set",
                    aggregates: Mapping[str, Column] | None = None) -> tuple[DataFrame, dict[tuple, int]]:
    """Counts (and averages) for several groupings in one scan.

    ``sets`` lists the groupings, e.g. ``[["flag"], ["flag", "key"], ["key"]]``.
    The result has one row per group of every set, with every column used
    by any set (null where the set does not group by it), the averages, the
    row count and ``set_name``, which tells the sets apart (a null key value
    stays distinguishable from "not grouped by"). ``aggregates`` adds other
    aggregate columns by name (e.g. correlations); an empty set ``[]`` is
    the grand total. Returns the DataFrame and ``{tuple(set): set id}``.

    Physically each row is expanded once per set and partially aggregated
    in the same task, so the shuffle carries one row per group, set and
    task, and the table is read once however many sets there are.
    """
    columns: list[str] = []
    for grouping in sets:
        for c in grouping:
            if c not in columns:
                columns.append(c)
    n = len(columns)
    # grouping_id(): bit (n - 1 - i) is set when column i is not grouped by
    ids = {tuple(g): sum(1 << (n - 1 - i) for i, c in enumerate(columns) if c not in g) for g in sets}
    aggs = [F.avg(c).alias(a) for a, c in _measures(measures).items()] if measures else []
    aggs += [c.alias(a) for a, c in (aggregates or {}).items()]
    aggs += [F.count(F.lit(1)).alias(count_name), F.grouping_id().alias(set_name)]
    out = df.groupingSets([[_quoted(c) for c in g] for g in sets], *[_quoted(c) for c in columns]).agg(*aggs)
    return out, ids


FINEST_ROWS = "_fs_rows"

# A finest summary pays if it has at most this share of the table's rows, and
# no more groups than a few thousand tasks aggregate in memory.
FINEST_SHARE = 0.2
FINEST_GROUPS = 500_000_000


def finest_pays(df: DataFrame, keys: Sequence[str], max_share: float = FINEST_SHARE,
                max_groups: int = FINEST_GROUPS) -> bool:
    """Whether one aggregation on all ``keys`` leaves few enough groups to roll
    further results up from.

    Measured in one pass over the key columns, with a sketch (5 % standard
    error) instead of a shuffle: the combinations that occur, and the rows. A
    table with few rows (a thousand groups or fewer) always goes.
    """
    row = df.agg(F.approx_count_distinct(F.xxhash64(*_all(list(keys))), 0.05).alias("groups"),
                 F.count(F.lit(1)).alias("rows")).first()
    return row["groups"] <= max(1000 if max_share > 0 else 0, min(max_groups, max_share * row["rows"]))


def finest_summary(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str | Column] | Sequence[str] = (),
                   ) -> tuple[DataFrame, list[Column] | None]:
    """Row counts (``FINEST_ROWS``), sums and non-null counts per combination of ``keys``.

    Any grouping by some of the keys rolls up from it: rows by summing
    ``FINEST_ROWS``, averages by aggregating with the returned columns. Those
    are None, and no sums are taken, when an average is not a double: sums
    alone do not give Spark's rounding of a decimal average.
    """
    ms = _measures(measures) if measures else {}
    rows = F.count(F.lit(1)).alias(FINEST_ROWS)
    by = _all(list({k.lower(): k for k in keys}.values()))
    if any(not isinstance(f.dataType, DoubleType) for f in df.select(*[F.avg(c) for c in ms.values()]).schema):
        return df.groupBy(*by).agg(rows), None
    aggs, averages = [], []
    for i, (alias, c) in enumerate(ms.items()):
        total, n = f"_fs_sum{i}", f"_fs_n{i}"
        aggs += [F.sum(c.cast("double")).alias(total), F.count(c).alias(n)]
        averages.append(F.when(F.sum(n) > 0, F.sum(total) / F.sum(n)).alias(alias))
    return df.groupBy(*by).agg(rows, *aggs), averages


def measure_columns(measures: Mapping[str, str | Column] | Sequence[str]) -> dict[str, Column]:
    """Public form of the measure spec used by ``mean_profile``."""
    return _measures(measures)


__all__ = [
    "correlations", "counts", "decade_profile", "finest_pays", "finest_summary", "group_stats", "grouped_summary", "mean_profile",
    "measure_columns", "pivot_counts", "share_of_group",
]
