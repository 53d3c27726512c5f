import glob

import pytest
from pyspark.sql import functions as F

from facetspark.operators import clean, profile, segments
from facetspark.plans import studies
from facetspark.sinks import write_csv, write_parquet
from facetspark.sources import read_csv


def test_typing_counts_what_it_makes_null(spark, scratch):
    rows = [("1", "-5.2 dB", "x"), ("2.5", "n/a", None), (None, None, "y"), ("", "3", "z"), ("abc", " 4 DB ", "w")]
    raw = spark.createDataFrame(rows, "a string, b string, c string").repartition(3)
    out, found = clean.typed_counted(raw, {"a": "double", "b": "double"}, {"b": r"(?i)\s*db$"})
    assert out.columns == ["a", "b", "c"]
    want = clean.typed(raw, {"a": "double", "b": "double"}, {"b": r"(?i)\s*db$"})
    write_parquet(out, f"{scratch}/typed")
    back = spark.read.parquet(f"{scratch}/typed")
    assert sorted(map(str, back.collect())) == sorted(map(str, want.collect()))
    assert found.counts() == [("a", 5, 4, 2), ("b", 5, 4, 1)]  # "" and "abc", "n/a"
    assert [tuple(r) for r in found.report(spark).orderBy("column_name").collect()] == found.counts()


def test_typing_counts_of_no_rows(spark):
    raw = spark.createDataFrame([], "a string")
    out, found = clean.typed_counted(raw, {"a": "int"})
    assert out.collect() == [] and found.counts() == [("a", 0, 0, 0)]


def test_songs_are_counted_in_the_pass_that_writes_them(spark, songs_csv, scratch):
    songs, found = studies.read_songs_counted(spark, songs_csv)
    write_parquet(songs, f"{scratch}/songs")
    plain = studies.read_songs(spark, songs_csv)
    assert sorted(map(str, spark.read.parquet(f"{scratch}/songs").collect())) == sorted(map(str, plain.collect()))
    raw = read_csv(spark, songs_csv)
    for column, rows, values, lost in found.counts():
        q = f"`{column}`"
        assert rows == raw.count() and values == raw.where(F.col(q).isNotNull()).count()
        assert values - lost == plain.where(F.col(q).isNotNull()).count()


def test_single_file_is_bounded(spark, scratch):
    rows = spark.range(0, 1000, 1, 4).select("id", F.lit("some text").alias("t"))
    at = f"{scratch}/out"
    files = lambda: len(glob.glob(f"{at}/part-*.csv"))
    read = lambda: sorted(int(r.id) for r in read_csv(spark, at).collect())
    assert write_csv(rows, at, single_file=True, max_rows=1000) and files() == 1 and read() == list(range(1000))
    assert not write_csv(rows, at, single_file=True, max_rows=999) and files() == 4 and read() == list(range(1000))
    assert not write_csv(rows, at, single_file=True, max_bytes=5000) and files() == 4 and read() == list(range(1000))
    for bound in ({"max_rows": 10}, {"max_bytes": 10}):
        with pytest.raises(ValueError):
            write_csv(rows, at, single_file=True, on_large="error", **bound)
        assert files() == 0  # nothing is left that looks like a whole result
    assert write_csv(rows.limit(0), at, single_file=True) and read() == []
    ordered = rows.orderBy(F.desc("id")).repartition(1).sortWithinPartitions(F.desc("id"))
    write_csv(ordered, at, single_file=True)
    assert [int(r.id) for r in read_csv(spark, at).collect()] == list(range(999, -1, -1))
    assert write_csv(rows.limit(3), at, single_file=True, mode="append") and files() == 2
    assert not write_csv(rows, at, single_file=True, mode="append", max_rows=5) and len(read()) == 2003
    with pytest.raises(ValueError):
        write_csv(rows, at, single_file=True, mode="append", max_rows=5, on_large="error")


def scans(df):  # before adaptive execution prints its plans twice
    return df._jdf.queryExecution().sparkPlan().toString().count("FileScan")


def test_union_of_labelled_profiles_scans_once(spark, scratch):
    spark.createDataFrame([(i % 3, i % 2, float(i)) for i in range(60)] + [(None, 1, 5.0)], "a int, b int, x double"
                          ).write.parquet(f"{scratch}/t")
    t = spark.read.parquet(f"{scratch}/t")
    measures = {"m": "x", "twice": F.col("x") * 2}
    conds = {"zero": F.col("a") == 0, "odd": F.col("b") == 1, "none": F.col("a") > 9, "zero odd": (F.col("a") == 0) & (F.col("b") == 1)}
    parts = [segments.labelled_profile(t, c, n, measures, count_name="n") for n, c in conds.items()]
    one, many = segments.union_profiles(parts), segments.union_profiles(parts, share_scan=False)
    rows = lambda d: sorted(map(tuple, d.collect()))
    assert one.columns == many.columns and rows(one) == rows(many) and len(rows(one)) == 3
    assert scans(one) == 1 and scans(many) == 4
    # a repeated label, another table and a frame of one's own are united as they are
    again = segments.labelled_profile(t, conds["odd"], "zero", measures, count_name="n")
    other = segments.labelled_profile(t.where("x > 3"), conds["odd"], "other", measures, count_name="n")
    own = many.limit(1)
    mixed = segments.union_profiles([*parts, again, other, own])
    assert scans(mixed) == 1 + 1 + 1 + scans(own)
    assert rows(mixed) == sorted([*rows(many), *rows(again), *rows(other), *rows(own)])
    with pytest.raises(ValueError):
        segments.union_profiles([parts[0], segments.labelled_profile(t, conds["odd"], "x", {"m": "x"}, count_name="n")])
    with pytest.raises(ValueError):
        segments.union_profiles([])


def test_found_pivot_scans_once_and_is_bounded(spark, scratch):
    spark.createDataFrame([("r", "b"), ("r", "a"), ("r", "b"), ("s", None), (None, "a"), ("t t", "a b.c")],
                          "k string, `p x` string").write.parquet(f"{scratch}/t")
    t = spark.read.parquet(f"{scratch}/t")
    out = profile.pivot_counts(t, "k", "p x")
    assert out.columns == ["k", "null", "a", "a b.c", "b"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [("r", 0, 1, 0, 2), ("s", 1, 0, 0, 0), (None, 0, 1, 0, 0), ("t t", 0, 0, 1, 0)], key=str)
    with pytest.raises(ValueError, match="more than 3"):
        profile.pivot_counts(t, "k", "p x", max_values=3)
    assert profile.pivot_counts(t.limit(0), "k", "p x").columns == ["k"]
    numbers = spark.createDataFrame([(1, 10), (1, 9), (2, 10)], "k int, v int")
    assert profile.pivot_counts(numbers, "k", "v").columns == ["k", "9", "10"]
