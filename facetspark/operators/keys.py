"""Key operators: distinct keys, minimum support, dense indexes, row ids.

Scale notes
-----------
* ``min_support`` counts rows per key with a partial aggregation (a hot key
  costs one row per task), writes the qualifying keys as a Parquet table in
  the shared checkpoint folder -- measuring their rows and bytes with
  ``observe`` in that same write -- and broadcasts them into a semi-join only
  when both are under the given bounds; otherwise it uses a shuffle-hash
  semi-join, where adaptive execution splits skewed partitions. The big side
  is never grouped.
* ``row_id`` gives contiguous ids without sending rows to one task. After the
  (range-partitioned) sort, every row records its partition number and its
  position inside the partition; that table is written to the shared folder,
  so a lost executor cannot make a re-run see different partitions. Ids are
  the position plus the number of rows in all earlier partitions (for a file
  scan: in all earlier files and file blocks); the counts read only these
  columns (files as a number, not a path). They are summed in levels, so no
  window holds them all, and their table, one row per partition or file
  block, is stored, measured and broadcast only under the same bounds.
* ``dense_index`` numbers the distinct keys with ``row_id`` (never a global
  window over rows) and joins the index back, broadcast only under the same
  measured bound.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, LongType, MapType, StructField, StructType

from facetspark.operators.stored import materialise as _store
from facetspark.session import spread_target

# Default bounds for broadcasting a key table: 2 million keys and 256 MiB.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 << 20

_PID = "_fs_partition"
_POS = "_fs_position"
_FILE = "_fs_file"
_BLOCK = "_fs_block"
_NUMBER = "_fs_file_number"

# Runs of rows that the driver adds up itself, and first keys (files, partitions)
# whose runs one window of row-id offsets holds beyond that.
DRIVER_RUNS = 20_000
GROUP = 4096


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _join_keys(df: DataFrame, keys_df: DataFrame, on: list[str], how: str, size: tuple[int, int],
               max_rows: int, max_bytes: int) -> DataFrame:
    small = size[0] <= max_rows and size[1] <= max_bytes
    # Over the bound: both sides are shuffled on the key and the key side is
    # hashed per partition; adaptive execution splits skewed partitions.
    right = F.broadcast(keys_df) if small else keys_df.hint("shuffle_hash")
    return df.join(right, on, how)


def _has_map(t: DataType) -> bool:
    if isinstance(t, MapType):
        return True
    if isinstance(t, ArrayType):
        return _has_map(t.elementType)
    if isinstance(t, StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return False


def distinct_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Distinct values (combinations) of the key columns."""
    return df.select(*[_q(k) for k in _keys(key)]).distinct()


def supported_keys(df: DataFrame, key: str | Sequence[str], min_count: int,
                   count_name: str = "count") -> DataFrame:
    """Keys with at least ``min_count`` rows, with their row count."""
    ks = _keys(key)
    return (df.groupBy(*ks).agg(F.count(F.lit(1)).alias(count_name))
              .where(F.col(count_name) >= F.lit(min_count)))


def min_support(df: DataFrame, key: str | Sequence[str], min_count: int,
                max_broadcast_rows: int = BROADCAST_MAX_ROWS,
                max_broadcast_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Rows of ``df`` whose key occurs in at least ``min_count`` rows (inclusive).

    Rows with a null key are dropped. Runs one job to write and measure the
    qualifying keys; the returned DataFrame is lazy.
    """
    ks = _keys(key)
    keys_df, size = _store(supported_keys(df, ks, min_count).select(*ks), "support-keys", measure=True)
    kept = _join_keys(df, keys_df, ks, "left_semi", size, max_broadcast_rows, max_broadcast_bytes)
    return kept.select(*[_q(c) for c in df.columns])


def sorted_for_ids(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """``df`` sorted by ``order_by`` with ties broken so that no tie group has
    to stay in one range partition.

    The tie-break is a hash of the whole row, then the number of the input
    partition the row comes from. Both are fixed for a given row whatever
    order a task reads its input in (routing by hash or range, and file
    splits, decide partition membership, not row order), so the sampling
    pass and a retried task route every row the same way. Rows sharing a
    hot key spread by hash; exact copies of one row spread by input
    partition, so one sort group holds at most the copies of one input
    partition.
    """
    # maps cannot be hashed; any other column takes part in the tie-break
    hashable = [_q(f.name) for f in df.schema.fields if not _has_map(f.dataType)]
    tie = [F.xxhash64(*hashable)] if hashable else []
    return df.orderBy(*order_by, *tie, F.spark_partition_id())


def row_id(df: DataFrame, order_by: Sequence[str | Column] | None = None, id_col: str = "id",
           start: int = 1, materialise: bool = True, spread: int | str | None = None,
           max_broadcast_rows: int = BROADCAST_MAX_ROWS,
           max_broadcast_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Prepend a contiguous, non-null long id: ``start, start+1, ...``.

    With ``order_by`` ids follow that order (ties in any order; see
    ``sorted_for_ids`` for how hot keys and copies are spread). Without it
    they follow the current row order, and for a file scan the order of the
    files' paths, then the rows' order in the file, however Spark packs files
    into tasks. A frame whose rows have left their files' order (a shuffle)
    is numbered by partition and position.

    The numbered rows are written once to the shared checkpoint folder
    before the per-partition offsets are computed, so both read the same
    partitions. ``materialise=False`` skips that write when there is no
    ``order_by`` and ``df`` re-reads the same rows in the same partitions
    every time (a plain file scan or an already written table); with
    ``order_by`` the write always happens, because adaptive execution may
    group sort partitions differently in two separate plans. The output
    rows are not sorted; order by ``id_col`` when the order matters.

    The runs of rows (one a partition, or a file block in a partition) are
    counted. Up to ``DRIVER_RUNS`` of them, the driver adds them up and
    broadcasts the offsets. More go to a stored table, measured as it is
    written; their offsets are prefix sums in levels (``_offsets``), and meet
    the rows in a broadcast join up to ``max_broadcast_rows`` runs and
    ``max_broadcast_bytes``, in a shuffled join beyond.

    ``spread`` redistributes the numbered rows over that many partitions
    (``"auto"``: the default parallelism, when there are fewer partitions;
    with ``order_by`` it does nothing, the sort already spreads the rows)
    before they are written: a row's id depends only on the partition and
    position it was numbered with, which travel with it, so a few large
    unsplittable inputs (multi-line CSV files) are written by every core.
    """
    return _row_id(df, order_by, id_col, start, materialise, spread,
                   bounds=(max_broadcast_rows, max_broadcast_bytes))[0]


def _row_id(df: DataFrame, order_by: Sequence[str | Column] | None, id_col: str, start: int,
            materialise: bool, spread: int | str | None = None, measure: bool = False,
            bounds: tuple[int, int] = (BROADCAST_MAX_ROWS, BROADCAST_MAX_BYTES),
            ) -> tuple[DataFrame, tuple[int, int] | None]:
    """``row_id`` and, with ``measure``, the (rows, bytes) of the numbered rows
    taken in the same write (used for small key tables; a full table is not
    measured, which would cost a text conversion of every value)."""
    cols = [_q(c) for c in df.columns]
    base = sorted_for_ids(df, order_by) if order_by else df
    pid = F.spark_partition_id()
    source = [] if order_by else _file_columns(base)
    # monotonically_increasing_id = partition index << 33 | position in partition
    numbered = base.select(pid.alias(_PID),
                           (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias(_POS),
                           *source, *cols)
    if spread == "auto":
        # Sorted rows are already spread over the sort's range partitions, and
        # counting the partitions of a sorted frame would run its shuffle first.
        spread = None if order_by else spread_target(numbered)
    if spread:
        numbered = numbered.repartition(int(spread))
    size = None
    if materialise or order_by or spread or measure:
        numbered, size = _store(numbered, "row-id", measure=measure)
    run = [_PID, _FILE, _BLOCK] if source else [_PID]
    runs = _runs(numbered, run, _file_numbers(df) if source else None)
    offsets = _few_offsets(runs, run, min(DRIVER_RUNS, bounds[0]))
    if offsets is None:
        runs, (n_runs, n_bytes) = _store(runs, "row-runs", measure=True)
        small = n_runs <= bounds[0] and n_bytes <= bounds[1]
        offsets = _offsets(runs, run)
        offsets = F.broadcast(offsets) if small else offsets.hint("shuffle_hash")
    ident = (F.col("_offset") + F.col(_POS) + F.lit(start)).cast("long")
    # every term is present for every row; coalesce only declares it non-null
    ident = F.coalesce(ident, F.lit(start).cast("long")).alias(id_col)
    return numbered.join(offsets, run).select(ident, *cols), size


def _runs(numbered: DataFrame, run: Sequence[str], files: DataFrame | None) -> DataFrame:
    """Runs of rows: their keys, ``_n`` rows from position ``_first`` on, and
    (``_k1``, ``_k2``), the order the runs are numbered in.

    With ``files`` that is the number of the run's file, then its block, as long
    as the rows of each block follow each other in one task and every file is
    known; a run for which that fails has the flag ``_loose``.
    """
    runs = numbered.groupBy(*run).agg(F.count(F.lit(1)).alias("_n"), F.min(_POS).alias("_first"),
                                      F.max(_POS).alias("_last"))
    if files is None:
        return runs.select(*run, "_n", F.lit(0).cast("long").alias("_first"), F.col(_PID).cast("long").alias("_k1"),
                           F.lit(0).cast("long").alias("_k2"), F.lit(False).alias("_loose"))
    loose = (F.col("_last") - F.col("_first") + 1 != F.col("_n")) | F.col(_NUMBER).isNull()
    return runs.join(files, _FILE, "left").select(
        *run, "_n", "_first", F.coalesce(F.col(_NUMBER), F.lit(0).cast("long")).alias("_k1"), F.col(_BLOCK).alias("_k2"),
        loose.alias("_loose"))


def _few_offsets(runs: DataFrame, run: Sequence[str], most: int) -> DataFrame | None:
    """(run keys, _offset) for at most ``most`` runs, added up by the driver;
    None if there are more."""
    rows = runs.limit(most + 1).collect()
    if len(rows) > most:
        return None
    if any(r["_loose"] for r in rows):
        per: dict[int, int] = {}
        for r in rows:
            per[r[_PID]] = per.get(r[_PID], 0) + r["_n"]
        starts = dict(zip(sorted(per), accumulate([0, *(per[k] for k in sorted(per))])))
        found = [(*(r[k] for k in run), starts[r[_PID]]) for r in rows]
    else:
        rows.sort(key=lambda r: (r["_k1"], r["_k2"], r[_PID]))
        before = accumulate([0, *(r["_n"] for r in rows)])
        found = [(*(r[k] for k in run), b - r["_first"]) for r, b in zip(rows, before)]
    schema = StructType([*(runs.schema[k] for k in run), StructField("_offset", LongType())])
    return F.broadcast(runs.sparkSession.createDataFrame(found, schema))


def _offsets(runs: DataFrame, run: Sequence[str]) -> DataFrame:
    """(run keys, _offset): rows of all runs that come before, less the run's
    first position.

    A prefix sum in levels: runs are summed inside groups of ``GROUP`` values
    of their first key, groups inside groups of groups, and those (one for 16
    million files or partitions) by a join with the earlier ones.
    """
    if runs.where("_loose").limit(1).count():
        # the rows have left their files' order: by partition and position, whole partitions as runs
        per = runs.groupBy(_PID).agg(F.sum("_n").alias("_n"))
        per = per.select(_PID, "_n", F.lit(0).cast("long").alias("_first"), F.col(_PID).cast("long").alias("_k1"),
                         F.lit(0).cast("long").alias("_k2"))
        return runs.select(*run).join(_levels(per, [_PID]), _PID).select(*run, "_offset")
    return _levels(runs, run)


def _levels(runs: DataFrame, run: Sequence[str]) -> DataFrame:
    group = lambda k: F.floor(F.col("_k1") / F.lit(GROUP ** k)).cast("long")
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.withColumns({"_g1": group(1), "_g2": group(2)})
    inside = runs.withColumn("_in", before(Window.partitionBy("_g1").orderBy("_k1", "_k2", _PID)))
    groups = runs.groupBy("_g1", "_g2").agg(F.sum("_n").alias("_n"))
    groups = groups.withColumn("_mid", before(Window.partitionBy("_g2").orderBy("_g1")))
    # GROUP * GROUP files or partitions a row: one row but for huge inputs
    tops = groups.groupBy("_g2").agg(F.sum("_n").alias("_n"))
    upper = tops.select(F.col("_g2").alias("_over"), F.col("_n").alias("_more"))
    bases = (tops.join(F.broadcast(upper), F.col("_over") < F.col("_g2"), "left")
             .groupBy("_g2").agg(F.coalesce(F.sum("_more"), F.lit(0)).alias("_top")))
    groups = groups.join(bases, "_g2").select("_g1", (F.col("_mid") + F.col("_top")).alias("_base"))
    return inside.join(groups, "_g1").select(
        *run, (F.col("_base") + F.col("_in") - F.col("_first")).alias("_offset"))


def _file_columns(df: DataFrame) -> list[Column]:
    """A hash of the file's path and the block start of every row of a file
    scan; [] for other frames."""
    try:
        meta = df.metadataColumn("_metadata")
        found = [F.xxhash64(_plain_path(meta.getField("file_path"))).alias(_FILE),
                 F.coalesce(meta.getField("file_block_start"), F.lit(0)).alias(_BLOCK)]
        df.select(*found).schema
    except AnalysisException:
        return []
    return found


def _file_numbers(df: DataFrame) -> DataFrame:
    """(_FILE, _NUMBER): the files of a scan numbered by path. The list is the
    one the driver holds to plan the scan."""
    paths = sorted(set(df.inputFiles()), key=lambda p: p.encode("utf-8"))
    named = df.sparkSession.createDataFrame(list(enumerate(paths)), "number long, path string")
    numbers = named.select(F.xxhash64(_plain_path(F.col("path"))).alias(_FILE), F.col("number").alias(_NUMBER))
    return F.broadcast(numbers) if len(paths) <= DRIVER_RUNS else numbers


def _plain_path(path: Column) -> Column:
    """Local paths come with one slash after the scheme or with three."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def _index(df: DataFrame, key: str, index_col: str, start: int) -> tuple[DataFrame, tuple[int, int]]:
    """Sorted distinct keys numbered from ``start``; the size is measured while
    the numbered keys are written (one row per key plus two int/long columns,
    an upper bound of the index table)."""
    sorted_keys = df.select(_q(key)).where(_q(key).isNotNull()).distinct().orderBy(_q(key))
    numbered, size = _row_id(sorted_keys, None, index_col, start, True, measure=True)
    return numbered.select(_q(key), F.col(index_col)), size


def index_table(df: DataFrame, key: str, index_col: str | None = None, start: int = 0) -> DataFrame:
    """Distinct non-null keys numbered ``start, start+1, ...`` in key order."""
    return _index(df, key, index_col or f"{key}_index", start)[0]


def dense_index(df: DataFrame, key: str, index_col: str | None = None, start: int = 0,
                keys: DataFrame | None = None,
                max_broadcast_rows: int = BROADCAST_MAX_ROWS,
                max_broadcast_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Attach to every row the 0-based rank of its key among the distinct keys.

    Output columns: the key, the other columns of ``df``, then the index.
    Rows with a null key are dropped (a null has no index). ``keys`` gives
    the key values to number instead of all keys of ``df`` (e.g. only the
    supported ones); rows whose key is not among them are dropped, so one
    join both filters and labels.
    """
    idx, size = _index(keys if keys is not None else df, key, index_col or f"{key}_index", start)
    return _join_keys(df, idx, [key], "inner", size, max_broadcast_rows, max_broadcast_bytes)
