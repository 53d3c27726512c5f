import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from facetspark.functions import bucket, decade, flag, percentage, presets, safe_corr
from facetspark.operators import clean, derive


def test_bucket_edges_4(spark):
    edges = [0, 10, 11, 25, 26, 50, 51, 75, 76, 90, 91, 100, None]
    df = spark.createDataFrame([(e,) for e in edges], "p int")
    got = dict(derive.with_popularity_bucket(df, "p").collect())
    assert got[0] == got[25] == "0-25"
    assert got[26] == got[50] == "26-50"
    assert got[51] == got[75] == "51-75"
    assert got[76] == got[100] == "75-100"
    assert got[None] is None


def test_bucket_edges_10(spark):
    edges = [0, 10, 11, 20, 21, 81, 90, 91, 100]
    df = spark.createDataFrame([(e,) for e in edges], "p int")
    got = dict(derive.with_popularity_bucket(df, "p", fine=True).collect())
    assert got[0] == got[10] == "0-10"
    assert got[11] == got[20] == "11-20"
    assert got[21] == "21-30"
    assert got[81] == got[90] == "81-90"
    assert got[91] == got[100] == "91-100"


def test_bucket_null_label_and_validation(spark):
    df = spark.createDataFrame([(None,), (5,)], "p int")
    got = df.select(bucket("p", [3], ["low", "high"], null_label="none").alias("b")).collect()
    assert [r.b for r in got] == ["none", "high"]
    with pytest.raises(ValueError):
        bucket("p", [1, 2], ["a", "b"])
    with pytest.raises(ValueError):
        bucket("p", [2, 1], ["a", "b", "c"])


def test_bucket_labels_are_fixed():
    assert presets.POPULARITY_LABELS_4[-1] == "75-100"
    assert len(presets.POPULARITY_LABELS_10) == len(presets.POPULARITY_BOUNDS_10) + 1


def test_flag_null_is_zero(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (2,)], "g int")
    assert [r[0] for r in df.select(flag("g")).collect()] == [1, 0, 0, 0]
    out = derive.with_flags(df, {"g": "g_flag"}, drop_sources=True)
    assert out.columns == ["g_flag"]


def test_decade_bad_text_is_null(spark):
    df = spark.createDataFrame([("2003-05-01",), ("2013",), ("29th April 2013",), ("",), (None,), ("1999-12-31",)],
                               "d string")
    got = [r[0] for r in df.select(decade("d")).collect()]
    assert got == [2000, 2010, None, None, None, 1990]
    assert df.select(decade("d").alias("x")).schema["x"].dataType.simpleString() == "bigint"


def test_decade_from_timestamp(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'1995-03-04 10:00:00' AS t")
    assert df.select(decade("t")).first()[0] == 1990


def test_percentage_rounds_half_up_and_zero_total(spark):
    df = spark.createDataFrame([(1, 8), (3, 0), (1, 3)], "a int, b int")
    got = [r[0] for r in df.select(percentage("a", "b")).collect()]
    assert got == [12.5, None, 33.33]


def test_safe_corr_matches_corr_and_handles_zero_variance(spark):
    rows = [(1.0, 2.0), (2.0, 4.5), (3.0, 5.0), (None, 1.0), (4.0, None), (5.0, 9.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    mine, builtin = df.select(safe_corr("x", "y"), F.corr("x", "y")).first()
    assert math.isclose(mine, builtin, rel_tol=1e-12)
    flat = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0)], "x double, y double")
    assert flat.select(safe_corr("x", "y")).first()[0] is None


def test_project_complete_drops_null_and_nan_only_in_subset(spark):
    schema = StructType([StructField("a", StringType()), StructField("b", DoubleType()),
                         StructField("c", IntegerType())])
    df = spark.createDataFrame([("x", 1.0, None), ("y", float("nan"), 1), (None, 2.0, 1), ("z", 3.0, None)], schema)
    out = clean.project_complete(df, ["a", "b"]).collect()
    assert sorted(r.a for r in out) == ["x", "z"]


def test_typed_strips_suffix_and_tolerates_junk(spark):
    df = spark.createDataFrame([("-5.5 dB",), ("-3.25",), ("loud",), (None,), ("NaN",)], "v string")
    got = [r[0] for r in clean.typed(df, {"v": "double"}, strip_pattern=r"(?i)\s*db$").collect()]
    assert got[:4] == [-5.5, -3.25, None, None]
    assert math.isnan(got[4])


def test_rename_and_lower_are_case_insensitive(spark):
    df = spark.createDataFrame([("Joy", 1)], "Emotion string, Key int")
    out = clean.lower_case(clean.rename(df, {"key": "musical_key"}), "emotion")
    assert out.columns == ["emotion", "musical_key"]  # replaced column takes the name as typed
    assert out.first()[0] == "joy"
