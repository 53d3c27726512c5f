import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from facetspark.operators import profile, segments
from facetspark.sources import read_table

from .conftest import SF01


def _cat_rows(spark, sizes):
    rows = []
    for cat, n in sizes.items():
        rows += [(cat, float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "cat string, v double")


def test_group_stats_min_support_is_inclusive(spark):
    df = _cat_rows(spark, {"a": 19, "b": 20, "c": 21, "d": 1})
    out = profile.group_stats(df, "cat", "v", min_count=20, label="v", count_name="song_count").collect()
    assert [r.cat for r in out] == ["b", "c"]  # sorted by average
    assert out[1].song_count == 21
    assert out[0].min_v == 0.0 and out[0].max_v == 19.0
    assert math.isclose(out[0].stddev_v, 5.916079783099616)


def test_group_stats_one_row_group_has_null_stddev(spark):
    df = _cat_rows(spark, {"solo": 1})
    r = profile.group_stats(df, "cat", "v").first()
    assert r.stddev_v is None and r.n == 1


def test_counts_order_and_tie_break(spark):
    df = spark.createDataFrame([(0, "x"), (0, "y"), (0, "y"), (1, "x"), (1, "z")], "g int, k string")
    out = [tuple(r) for r in profile.counts(df, ["g", "k"]).collect()]
    assert out == [(0, "y", 2), (0, "x", 1), (1, "x", 1), (1, "z", 1)]
    one = [tuple(r) for r in profile.counts(df, "k").collect()]
    assert one == [("x", 2), ("y", 2), ("z", 1)]


def test_share_of_group_sums_to_100_and_drops_null_outer(spark):
    df = spark.createDataFrame(
        [(0, "4/4")] * 7 + [(0, "3/4")] * 2 + [(0, None)] + [(1, "4/4")] * 3 + [(None, "4/4")] * 5,
        "g int, ts string")
    out = profile.share_of_group(df, "g", "ts").collect()
    assert {r.g for r in out} == {0, 1}
    by_g = {}
    for r in out:
        by_g.setdefault(r.g, []).append(r)
    assert [r.ts for r in by_g[0]] == ["4/4", "3/4", None]
    assert [r.percentage for r in by_g[0]] == [70.0, 20.0, 10.0]
    assert by_g[1][0].percentage == 100.0
    # join form of the original equals this
    totals = df.groupBy("g").count().withColumnRenamed("count", "total")
    joined = (df.groupBy("g", "ts").count().join(totals, "g")
              .select("g", "ts", "count", F.round(F.col("count").cast("double") / F.col("total") * 100, 2)
                      .alias("percentage")))
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, out), key=str)


def test_share_of_group_scans_once(spark):
    part = read_table(spark, SF01, "part")
    df = profile.share_of_group(part, "p_brand", "p_type")
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1  # the totals reuse the pair-count shuffle
    assert "ReusedExchange" in final


def test_correlations_one_pass_matches_builtin(spark):
    li = read_table(spark, SF01, "lineitem")
    mine = profile.correlations(li, {"a": ("l_quantity", "l_extendedprice"), "b": ("l_discount", "l_tax")}).first()
    ref = li.agg(F.corr("l_quantity", "l_extendedprice"), F.corr("l_discount", "l_tax")).first()
    assert math.isclose(mine.a, ref[0], rel_tol=1e-9) and math.isclose(mine.b, ref[1], rel_tol=1e-9)


def test_pivot_counts_fills_zero(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("b", 1)], "k string, g int")
    out = {r.k: (r["0"], r["1"]) for r in profile.pivot_counts(df, "k", "g", [0, 1]).collect()}
    assert out == {"a": (1, 1), "b": (0, 1)}
    auto = {r.k: r["1"] for r in profile.pivot_counts(df, "k", "g").collect()}
    assert auto == {"a": 1, "b": 1}


def test_decade_profile_leaves_out_null_decade(spark):
    df = spark.createDataFrame([(1990, 1.0), (1990, 3.0), (None, 100.0), (2000, 5.0)], "decade bigint, v double")
    out = [tuple(r) for r in profile.decade_profile(df, "decade", {"avg_v": "v"}).collect()]
    assert out == [(1990, 2.0, 2), (2000, 5.0, 1)]


def _segs():
    return {
        "returned": F.col("l_returnflag") == "R",
        "returned open": (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"),
        "nothing": F.col("l_quantity") < 0,
        "finished": F.col("l_linestatus") == "F",
    }


def test_segment_profile_equals_union_form(spark):
    li = read_table(spark, SF01, "lineitem")
    ms = {"avg_q": "l_quantity", "avg_p": "l_extendedprice"}
    one_pass = segments.segment_profile(li, _segs(), ms, count_name="n").collect()
    union = segments.union_profiles(
        [segments.labelled_profile(li, c, name, ms, count_name="n") for name, c in _segs().items()],
        share_scan=False).collect()
    a = {r.tagged_as: r for r in one_pass}
    b = {r.tagged_as: r for r in union}
    assert set(a) == set(b) == {"returned", "returned open", "finished"}  # empty segment: no row
    for k in a:
        assert a[k].n == b[k].n
        assert math.isclose(a[k].avg_q, b[k].avg_q, rel_tol=1e-12)
        assert math.isclose(a[k].avg_p, b[k].avg_p, rel_tol=1e-12)


def test_segment_profile_keep_empty_and_null_condition(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 4.0)], "f int, v double")
    out = segments.segment_profile(df, {"one": F.col("f") == 1, "none": F.col("f") == 7}, ["v"],
                                   count_name="n", keep_empty=True).collect()
    got = {r.tagged_as: (r.avg_v, r.n) for r in out}
    assert got == {"one": (2.0, 1), "none": (None, 0)}


def test_segment_profile_single_scan_no_shuffle_by_key(spark):
    li = read_table(spark, SF01, "lineitem")
    plan = segments.segment_profile(li, _segs(), ["l_quantity"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1
    assert "hashpartitioning" not in plan.lower()


def test_many_segments_equal_masked_form(spark):
    li = read_table(spark, SF01, "lineitem").withColumn("half", F.when(F.col("l_linenumber") > 2, F.col("l_tax")))
    segs = {f"s{i}": F.col("l_orderkey") % (i + 2) == 0 for i in range(70)}  # more than one long of bits
    segs |= {"none": F.col("l_quantity") < 0, "null": F.lit(None).cast("boolean")}
    ms = {"avg_q": F.col("l_quantity"), "avg_half": F.col("half"), "avg_line": F.col("l_linenumber")}
    got = segments.segment_profile(li, segs, ms, count_name="n", keep_empty=True).collect()
    want = {r.tagged_as: r for r in segments._masked(li, segs, ms, "tagged_as").collect()}
    assert [r.tagged_as for r in got] == list(segs)
    for r in got:
        w = want[r.tagged_as]
        assert r.n == w["_n"]
        for a in ms:
            assert (r[a] is None) == (w[a] is None)
            assert r[a] is None or math.isclose(r[a], w[a], rel_tol=1e-9)
    left = segments.segment_profile(li, segs, ms, count_name="n").collect()
    assert {r.tagged_as for r in left} == {k for k, w in want.items() if w["_n"]}
    assert {"none", "null"}.isdisjoint(r.tagged_as for r in left)


def test_many_segments_row_level_aggregate_is_compiled(spark):
    from facetspark.plans.catalogue import QUERIES

    df = QUERIES["segment_many"](spark, SF01)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    first = next(line for line in plan.splitlines() if "HashAggregate" in line and "partial_sum" in line and "_k0" in line)
    assert "*(" in first and plan.count("FileScan") == 1


def test_segments_of_decimals_keep_sparks_average(spark):
    df = spark.sql("SELECT id, CAST(id AS DECIMAL(12,2)) / 3 AS d FROM range(100)")
    segs = {f"s{i}": F.col("id") > i for i in range(30)}
    got = segments.segment_profile(df, segs, {"a": "d"})
    want = df.agg(F.avg("d").alias("a"))
    assert got.schema["a"].dataType == want.schema["a"].dataType
    assert got.where("tagged_as = 's9'").first().a == df.where("id > 9").agg(F.avg("d")).first()[0]


def test_all_of_and_segment_size(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1)], "a int, b int")
    assert segments.segment_size(df, segments.all_of("a", "b")).first().n_rows == 1


def test_mean_profile_expression_measures(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 2.0)], "k string, t double")
    r = profile.mean_profile(df, "k", {"avg_t100": F.col("t") * 100}, count_name="n").first()
    assert r.avg_t100 == 150.0 and r.n == 2


def test_group_stats_matches_window_brute_force(spark):
    part = read_table(spark, SF01, "part")
    w = Window.partitionBy("p_brand")
    brute = (part.withColumn("n", F.count(F.lit(1)).over(w)).where("n >= 80")
             .groupBy("p_brand").agg(F.avg("p_retailprice").alias("a")))
    mine = profile.group_stats(part, "p_brand", "p_retailprice", min_count=80)
    assert {r.p_brand: round(r.a, 6) for r in brute.collect()} == \
        {r.p_brand: round(r.avg_p_retailprice, 6) for r in mine.collect()}
