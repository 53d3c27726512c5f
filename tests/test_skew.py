"""A key holding a third of all rows: results stay whole and exact, and the
shuffle path splits the hot partition instead of giving it to one task."""

import contextlib

import pytest
from pyspark.sql import functions as F

from facetspark.operators import keys, profile, segments
from facetspark.sinks import partition_sizes

N = 120_000


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
         .otherwise(F.concat(F.lit("k"), (F.col("id") % 1000).cast("string"))).alias("k"),
        (F.col("id") % 2).cast("int").alias("g"),
        (F.col("id") % 97).cast("double").alias("v"))


@contextlib.contextmanager
def small_skew_thresholds(spark):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_min_support_shuffle_path_splits_hot_key(spark, skewed):
    with small_skew_thresholds(spark):
        out = keys.min_support(skewed, "k", 100, max_broadcast_rows=0)
        rows = out.collect()
        final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(rows) == N // 3  # every "hot" row, and no key with ~80 rows
    assert "skew=true" in final


def test_min_support_broadcast_path_same_rows(spark, skewed):
    a = keys.min_support(skewed, "k", 100)
    b = keys.min_support(skewed, "k", 100, max_broadcast_rows=0)
    assert a.count() == b.count() == N // 3


def test_dense_index_with_hot_key(spark, skewed):
    idx = keys.dense_index(skewed, "k", "i", max_broadcast_rows=0)
    got = idx.groupBy("i").count().orderBy("i").collect()
    assert len(got) == 1001 and sum(r["count"] for r in got) == N
    names = sorted({f"k{i}" for i in range(1000)} | {"hot"})
    assert idx.where("k = 'hot'").select("i").distinct().first().i == names.index("hot")


def test_profiles_with_hot_key(spark, skewed):
    stats = {r.k: r for r in profile.group_stats(skewed, "k", "v").collect()}
    assert stats["hot"].n == N // 3
    share = {(r.g, r.k): r.percentage for r in profile.share_of_group(skewed, "g", "k").collect()}
    assert share[(0, "hot")] == share[(1, "hot")] == round(100 / 3, 2)
    seg = segments.segment_profile(skewed, {"hot": F.col("k") == "hot", "all": F.lit(True)}, ["v"],
                                   count_name="n").collect()
    assert {r.tagged_as: r.n for r in seg} == {"hot": N // 3, "all": N}


def test_row_id_with_hot_key_order(spark, skewed):
    out = keys.row_id(skewed, order_by=["k", "v"]).select("id").collect()
    assert sorted(r.id for r in out) == list(range(1, N + 1))


def test_row_id_spreads_a_hot_sort_key(spark, skewed):
    """Ordering by the hot key alone: its rows span several sort partitions,
    ids stay contiguous and follow the key order."""
    with small_skew_thresholds(spark):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            sorted_rows = keys.sorted_for_ids(skewed, ["k"])
            sizes = [r.n_rows for r in partition_sizes(sorted_rows).collect()]
            out = keys.row_id(skewed, order_by=["k"]).collect()
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < N // 3  # no partition holds the whole hot key
    assert sorted(r.id for r in out) == list(range(1, N + 1))
    by_id = sorted(out, key=lambda r: r.id)
    assert [r.k for r in by_id] == sorted(r.k for r in by_id)


def test_row_id_spreads_exact_copies(spark):
    """A third of the rows are one identical row (same key, same values):
    the copies are split by input partition, ids stay exact."""
    n = 60_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(1.0)).otherwise(F.col("id").cast("double")).alias("v")).repartition(8)
    with small_skew_thresholds(spark):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            sizes = [r.n_rows for r in partition_sizes(keys.sorted_for_ids(rows, ["k"])).collect()]
            out = keys.row_id(rows, order_by=["k"]).collect()
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < n // 3
    assert sorted(r.id for r in out) == list(range(1, n + 1))
    by_id = sorted(out, key=lambda r: r.id)
    assert [r.k for r in by_id] == sorted(r.k for r in by_id)
    assert sum(1 for r in out if r.k == "hot" and r.v == 1.0) == n // 3
