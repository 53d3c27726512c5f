"""Helpers shared by the operators of this package."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetspark.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_BYTES = "4m"


# for tables between steps: a writer holds one row group in memory
LEAN_PARQUET = {"compression": "zstd", "parquet.block.size": str(16 << 20)}


def small_batches(df: DataFrame) -> DataFrame:
    """Have whole texts go to Python in batches of a few MB. The session's
    default of 64 MB a batch, held by the JVM and by Python for every running
    task, would be a large part of an executor. Plans are made lazily, so the
    size stays set in the session. Results do not depend on it; a size that the
    user has set stays."""
    name, spark = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession
    if name not in spark.conf.getAll:
        spark.conf.set(name, BATCH_BYTES)
    return df


def col(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_key(df: DataFrame) -> list[Column]:
    """__k1, __k2: 128 bits of all columns of a row. Rows that share them are
    copies of each other, so that any of them may stand for the others."""
    parts = []
    for f in df.schema:
        c = col(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            c = F.to_json(F.struct(c), {"ignoreNullFields": "false"})
        parts += [c, c.isNull()]  # a hash passes over nulls
    return [F.xxhash64(F.lit(1), *parts).alias("__k1"), F.xxhash64(F.lit(2), *parts).alias("__k2")]


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once, written to the shared checkpoint folder, lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def delete_path(spark, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def with_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """``df`` plus result columns; an input column of the same name gives way."""
    taken = {n.lower() for n in new}
    return df.select(*[col(c) for c in df.columns if c.lower() not in taken],
                     *[c.alias(n) for n, c in new.items()])


def whole_runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Re-cut a stream sorted by ``keys`` so that no run of equal keys is split.

    Memory: one batch plus the longest run, which the callers bound.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        same = np.ones(batch.num_rows, dtype=bool)
        for k in keys:
            c = batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
            same &= c == c[-1]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        # rows before ``cut`` are complete, but what is held may only belong to them
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        elif held and any(
                held[-1].column(batch.schema.get_field_index(k))[-1] != batch.column(
                    batch.schema.get_field_index(k))[0] for k in keys):
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def min_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes joined by the links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


HUB_ROWS = 500


def join_hubs(rows: DataFrame, per_key: DataFrame, on: Sequence[str], spread: Sequence[str], most: int,
              hub_rows: int = HUB_ROWS) -> DataFrame:
    """Inner join of ``rows`` with ``per_key``, which has one row per key, when a
    key has up to ``most`` rows (as measured by the caller).

    Above ``hub_rows`` the join takes two steps: rows are salted by a hash of
    the columns ``spread``, the pairs of key and salt that occur (combined
    map-side) get the key's values, and the rows meet these. With the root of
    ``most`` as the number of salts no step has more rows a key than that root,
    as far as ``spread`` tells the rows apart.
    """
    on = list(on)
    if most <= hub_rows:
        return rows.join(per_key, on)
    salt = F.pmod(F.xxhash64(*spread), F.lit(math.isqrt(most) + 1))
    rows = rows.withColumn("__salt", salt)
    salted = rows.select(*on, "__salt").distinct().join(per_key, on)
    return rows.join(salted, [*on, "__salt"]).drop("__salt")


def connected_components(links: DataFrame, rounds: int = 60, hub_rows: int = HUB_ROWS) -> DataFrame:
    """(node, root) of every node of ``links`` (columns a, b: long); root is the
    smallest node reachable.

    Alternates large-star and small-star steps. Each step is one grouped
    minimum (combined map-side, so a hub costs one row per task) and one join,
    in two salted steps if the largest degree measured in the round is above
    ``hub_rows`` (``join_hubs``). Links and minima are written to the
    checkpoint folder in every round; only the largest degree, the count and a
    checksum reach the driver.
    """
    def star(e: DataFrame) -> DataFrame:
        return e.where("u <> v").distinct()

    edges = stored(star(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))))
    seen = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        per = stored(both.groupBy("u").agg(F.min("v").alias("m"), F.count("v").alias("n"),
                                           F.bit_xor(F.xxhash64("v")).alias("x")))
        *sig, most = per.agg(F.sum("n"), F.bit_xor(F.xxhash64("u", "n", "x")), F.max("n")).first()
        if sig == seen or most is None:
            break
        seen = sig
        low = per.select("u", F.least("u", "m").alias("m"))
        # a node meets no more distinct minima than it has neighbours, so ``most`` holds for both joins
        large = star(join_hubs(both, low, ["u"], ["v"], most, hub_rows).where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = join_hubs(large, low, ["u"], ["v"], most, hub_rows).where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(star(small.unionByName(low.select("u", F.col("m").alias("v")))))
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


FAN = 1024


def running_start(df: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[Column],
                  value: str, into: str, levels: int = 2) -> DataFrame:
    """Adds ``into``: the sum of ``value`` over the rows of the same keys that
    come before, ordered by chunk, then ``order``.

    In levels, so that no task holds a whole key: sums per (key, chunk) are
    combined map-side and accumulated over that small table, then rows are
    accumulated inside their chunk. Each level above two accumulates the sums
    themselves in groups of ``FAN`` chunks.
    """
    keys, c, part, base = list(keys), f"__chunk{levels}", f"__sum{levels}", f"__base{levels}"
    d = df.withColumn(c, chunk)
    sums = d.groupBy(*keys, c).agg(F.sum(value).alias(part))
    if levels > 2:
        sums = running_start(sums, keys, F.floor(F.col(c) / FAN), [F.col(c)], part, base, levels - 1).drop(part)
    else:
        before = Window.partitionBy(*keys).orderBy(c).rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn(base, F.coalesce(F.sum(part).over(before), F.lit(0))).drop(part)
    inside = Window.partitionBy(*keys, c).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("__in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    on = [d[k].eqNullSafe(sums[k]) for k in [*keys, c]]
    out = d.join(sums, on)
    return out.select(*[d[c] for c in df.columns], (F.col(base) + F.col("__in")).cast("long").alias(into))


def on_arrow(fn: Callable[[pa.Table], pa.Table], keys: Sequence[str]):
    """A mapInArrow function that applies ``fn`` to whole runs of ``keys``."""
    def run(batches):
        for t in whole_runs(batches, keys):
            yield from fn(t).to_batches()
    return run


IDLE_SECONDS = 2.0


def worker_state(key, make: Callable[[], object]):
    """An object kept by a Python worker between batches and tasks (tables,
    word caches). A worker that asks for nothing for a while lets go of all of
    them, so that idle workers of other stages leave the memory to the rest."""
    import sys
    import threading
    import time
    import types

    state = sys.modules.get("_facetspark_worker")
    if state is None:
        state = sys.modules["_facetspark_worker"] = types.ModuleType("_facetspark_worker")
        state.kept, state.used, state.lock = {}, time.monotonic(), threading.Lock()

        def watch():
            while True:
                time.sleep(IDLE_SECONDS / 2)
                with state.lock:
                    if not state.kept or time.monotonic() - state.used < IDLE_SECONDS:
                        continue
                    state.kept = {}
                give_back()

        threading.Thread(target=watch, daemon=True).start()
    with state.lock:
        state.used = time.monotonic()
        if key not in state.kept:
            state.kept[key] = make()
        return state.kept[key]


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
