import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from facetspark.operators import derive
from facetspark.sinks import partition_sizes, preview, write_csv, write_parquet
from facetspark.sources import read_csv, read_parquet, read_table

from .conftest import SF01


def test_csv_multiline_and_doubled_quotes(spark, songs_csv, song_rows):
    raw = read_csv(spark, songs_csv)
    assert raw.count() == len(song_rows)
    titles = {r.song for r in raw.select("song").collect()}
    assert 'Line one\nline "two" of the title' in titles
    assert 'He said "hi"' in titles
    # multi-line CSV is not splittable: one task per file
    assert raw.rdd.getNumPartitions() == 2
    assert read_csv(spark, songs_csv, partitions=6).rdd.getNumPartitions() == 6


def test_csv_infer_schema_option(spark, songs_csv):
    raw = read_csv(spark, songs_csv, infer_schema=True)
    assert dict(raw.dtypes)["Popularity"] in ("int", "string")  # a null-only column in turn still infers


def test_csv_header_only_file(spark, scratch):
    p = os.path.join(scratch, "empty.csv")
    with open(p, "w") as fh:
        fh.write("a,b\n")
    assert read_csv(spark, p, schema="a string, b int").count() == 0


def test_csv_round_trip_keeps_quotes(spark, scratch):
    df = spark.createDataFrame([(1, 'say "x"'), (2, "two\nlines"), (3, None)], "id int, t string")
    write_csv(df, scratch + "/out")
    back = read_csv(spark, scratch + "/out", schema=df.schema)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == sorted(map(tuple, df.collect()),
                                                                           key=lambda r: r[0])


def test_single_file_csv(spark, scratch):
    counts = read_table(spark, SF01, "part").groupBy("p_brand").count()
    write_csv(counts, scratch + "/one", single_file=True)
    assert len(glob.glob(scratch + "/one/part-*.csv")) == 1


def test_parquet_partitioned_types_and_null_partition(spark, scratch):
    df = spark.createDataFrame([("2003-05-01", 1.0), ("junk", 2.0), ("1999-01-01", 3.0)], "d string, v double")
    rows = derive.with_decade(df, "d")
    write_parquet(rows, scratch + "/dec", partition_by=["decade"])
    assert os.path.isdir(scratch + "/dec/decade=__HIVE_DEFAULT_PARTITION__")
    guessed = read_parquet(spark, scratch + "/dec")
    assert dict(guessed.dtypes)["decade"] == "int"  # type drift without a schema
    typed = read_parquet(spark, scratch + "/dec", schema=rows.schema)
    assert dict(typed.dtypes)["decade"] == "bigint"
    kept = typed.where(F.col("decade").isNotNull())
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(decade" in plan
    assert sorted(r.decade for r in kept.collect()) == [1990, 2000]


def test_parquet_empty_partitioned_folder_needs_schema(spark, scratch):
    schema = StructType([StructField("v", LongType()), StructField("k", LongType())])
    empty = spark.createDataFrame([], schema)
    write_parquet(empty, scratch + "/empty", partition_by=["k"])
    assert read_parquet(spark, scratch + "/empty", schema=schema).count() == 0


def test_two_level_partitions_prune_and_push(spark, scratch):
    li = read_table(spark, SF01, "lineitem").select("l_returnflag", "l_linestatus", "l_discount")
    write_parquet(li, scratch + "/two", partition_by=["l_returnflag", "l_linestatus"], rebalance=True)
    back = read_parquet(spark, scratch + "/two", schema=li.schema)
    q = back.where((F.col("l_returnflag") == "R") & (F.col("l_discount") < 0.05))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(l_returnflag" in plan
    assert "LessThan(l_discount,0.05)" in plan
    assert q.count() == li.where("l_returnflag = 'R' AND l_discount < 0.05").count()


def test_rebalanced_write_splits_a_hot_value(spark, scratch):
    """A value holding most rows is written by several tasks, each task
    writing a single value (no task x value file explosion)."""
    src = scratch + "/src"
    rows = spark.range(0, 40_000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise(F.concat(F.lit("v"), (F.col("id") % 10).cast("string")))
        .alias("k"), F.col("id"), (F.col("id") * 7 % 1000).cast("double").alias("x"))
    rows.repartition(6).write.parquet(src)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        write_parquet(spark.read.parquet(src), scratch + "/out", partition_by=["k"], rebalance=True)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    hot_files = glob.glob(scratch + "/out/k=hot/*.parquet")
    assert len(hot_files) > 1
    back = read_parquet(spark, scratch + "/out", schema="id long, x double, k string")
    assert back.count() == 40_000
    assert back.where("k = 'hot'").count() == 32_000


def test_csv_round_trip_keeps_spaces_and_empty_text(spark, scratch):
    vals = [(1, "  lead"), (2, "trail  "), (3, 'back\\slash "q" \\"'), (4, ""), (5, None), (6, "cr\r\nlf"),
            (7, "a,b"), (8, '"'), (9, "\\")]
    df = spark.createDataFrame(vals, "id int, s string")
    write_csv(df, scratch + "/edge")
    exact = dict(map(tuple, read_csv(spark, scratch + "/edge", schema=df.schema, empty_as_null=False).collect()))
    assert exact == dict(vals)
    # default: an empty field reads as null, as Spark's reader does
    default = dict(map(tuple, read_csv(spark, scratch + "/edge", schema=df.schema).collect()))
    assert default[4] is None and default[1] == "  lead" and default[2] == "trail  "


def test_codec_and_preview_and_partition_sizes(spark, scratch):
    part = read_table(spark, SF01, "part")
    write_parquet(part, scratch + "/p", codec="zstd")
    assert any(f.endswith(".zstd.parquet") for f in os.listdir(scratch + "/p"))
    top = preview(part, 5, [F.desc("p_retailprice"), "p_partkey"])
    assert top.count() == 5
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    sizes = partition_sizes(part.repartition(3))
    assert sizes.agg(F.sum("n_rows")).first()[0] == 2000


def test_scratch_dir_is_under_checkpoint_dir(spark):
    from facetspark.session import ensure_checkpoint_dir, scratch_dir

    root = ensure_checkpoint_dir(spark)
    assert scratch_dir(spark, "x").startswith(root.rstrip("/"))


@pytest.mark.parametrize("name", ["nation", "region"])
def test_read_table(spark, name):
    assert read_table(spark, SF01, name).count() in (25, 5)


def test_apply_defaults_keeps_explicit_settings(spark):
    from facetspark.session import apply_defaults

    key, other = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.openCostInBytes"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "17")
    try:
        apply_defaults(spark, {key: "8192", other: str(8 << 20)})
        assert spark.conf.get(key) == "17"  # the cluster's value wins
        assert spark.conf.get(other) == str(8 << 20)  # unset: filled in
    finally:
        spark.conf.unset(other)
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def test_csv_auto_spreads_only_when_files_are_few(spark, songs_csv, scratch):
    want = spark.sparkContext.defaultParallelism
    assert read_csv(spark, songs_csv).rdd.getNumPartitions() == 2  # two multi-line files
    assert read_csv(spark, songs_csv, partitions="auto").rdd.getNumPartitions() == max(want, 2)
    # many files, one task each (a high open cost stops Spark packing small
    # files together): already one task per core, so no shuffle is added
    many = scratch + "/many"
    spark.range(want * 2).selectExpr("id", "cast(id as string) AS t").repartition(want * 2).write.option(
        "header", "true").csv(many)
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))
    try:
        scan = read_csv(spark, many, partitions="auto")
        assert scan.rdd.getNumPartitions() >= want
        assert "Exchange" not in scan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_shuffle_partitions_follow_the_input(spark, scratch):
    from facetspark import session

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert [session.cluster_conf(b)[key] for b in (0, 1 << 40, 100 << 40)] == ["200", "4096", "65536"]
    spark.range(1000).write.parquet(scratch + "/n")
    assert session.stored_bytes(spark, scratch + "/n") > 1000
    assert session.stored_bytes(spark, scratch + "/missing*") == 0
