"""The four song studies on a generated song export, checked against pandas."""

import math

import numpy as np
import pandas as pd

from pyspark.sql import functions as F

from facetspark.functions import presets
from facetspark.plans import studies


def _close(a, b, tol=1e-9):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return math.isclose(a, b, rel_tol=tol, abs_tol=tol)


def _complete(pdf, cols):
    return pdf[cols].dropna()


def test_category_measure(spark, songs, songs_pd):
    res = studies.category_measure(songs)
    stats = res["stats"].collect()
    brute = _complete(songs_pd, ["emotion", "Tempo"])
    g = brute.groupby("emotion")["Tempo"].agg(["mean", "min", "max", "std", "count"])
    g = g[g["count"] >= presets.MIN_SONGS_PER_EMOTION].sort_values("mean")
    assert [r.emotion for r in stats] == list(g.index)
    for r in stats:
        row = g.loc[r.emotion]
        assert _close(r.avg_tempo, row["mean"]) and _close(r.stddev_tempo, row["std"])
        assert r.min_tempo == row["min"] and r.max_tempo == row["max"] and r.song_count == row["count"]
    # case variants are different categories in this study (no lower-casing)
    assert "Joy" not in {r.emotion for r in stats}
    indexed = studies.category_index(songs)
    assert dict(indexed.dtypes) == {"emotion_index": "int", "Tempo": "double"}
    kept = sorted(g.index)
    want = sorted((kept.index(e), t) for e, t in brute[brute["emotion"].isin(kept)].itertuples(index=False))
    assert sorted(map(tuple, indexed.collect())) == want


def test_score_buckets(spark, songs, songs_pd):
    res = studies.score_buckets(songs)
    cols = ["Artist(s)", "song", "Popularity", "Danceability", "Tempo"]
    brute = _complete(songs_pd, cols)
    c = res["correlations"].first()
    assert _close(c.corr_popularity_danceability, brute["Popularity"].corr(brute["Danceability"]))
    assert _close(c.corr_tempo_danceability, brute["Tempo"].corr(brute["Danceability"]))
    labels = np.select([brute["Popularity"] < b for b in presets.POPULARITY_BOUNDS_4],
                       presets.POPULARITY_LABELS_4[:-1], presets.POPULARITY_LABELS_4[-1])
    want = brute.assign(b=labels).groupby("b")["Danceability"].mean()
    got = res["coarse"].collect()
    assert [r.popularity_bucket for r in got] == sorted(want.index)
    for r in got:
        assert _close(r.avg_danceability, want[r.popularity_bucket])
    fine = res["fine"].collect()
    labels10 = np.select([brute["Popularity"] < b for b in presets.POPULARITY_BOUNDS_10],
                         presets.POPULARITY_LABELS_10[:-1], presets.POPULARITY_LABELS_10[-1])
    want10 = brute.assign(b=labels10).groupby("b")["Danceability"].mean()
    assert {r.popularity_bucket: round(r.avg_danceability, 9) for r in fine} == \
        {k: round(v, 9) for k, v in want10.items()}
    assert res["coarse_rows"].count() == len(brute)


def test_decade_trends(spark, songs, songs_pd):
    res = studies.decade_trends(songs)
    got = res["profile"].collect()
    d = pd.to_datetime(songs_pd["Release Date"], format="%Y-%m-%d", errors="coerce")
    # year-only text is a valid date in Spark (2013 -> 2013-01-01)
    year_only = songs_pd["Release Date"].fillna("").str.fullmatch(r"\d{4}")
    d = d.where(~year_only, pd.to_datetime(songs_pd["Release Date"].where(year_only), format="%Y", errors="coerce"))
    dec = (d.dt.year // 10 * 10)
    b = songs_pd.assign(decade=dec).dropna(subset=["decade"])
    want = b.groupby("decade").agg(p=("Positiveness", "mean"), t=("Tempo", lambda s: (s * 100).mean()),
                                   e=("Energy", "mean"), n=("Energy", "size"))
    assert [r.decade for r in got] == [int(x) for x in want.index]
    for r in got:
        w = want.loc[r.decade]
        assert r.n_songs == w["n"]
        assert _close(r.avg_positiveness, w["p"]) and _close(r.avg_energy, w["e"])
    assert dict(res["profile"].dtypes)["decade"] == "bigint"


def test_flag_profile(spark, songs, songs_pd):
    table = studies.flag_table(songs)
    res = studies.flag_profile(table)
    cols = ["Good for Work/Study", *presets.SONG_MEASURES, "Time signature", "emotion", "Key"]
    brute = _complete(songs_pd, cols).copy()
    brute["good_for_study"] = (brute["Good for Work/Study"] == 1).astype(int)
    brute["emotion"] = brute["emotion"].str.lower()
    assert table.count() == len(brute)
    prof = {r.good_for_study: r for r in res["profile"].collect()}
    for g, grp in brute.groupby("good_for_study"):
        for src, alias in presets.SONG_MEASURES.items():
            assert _close(prof[g][alias], grp[src].mean())
    share = res["share_time_signature"].collect()
    for g, grp in brute.groupby("good_for_study"):
        vc = grp["Time signature"].value_counts()
        rows = [r for r in share if r.good_for_study == g]
        assert sum(r["count"] for r in rows) == len(grp)
        assert abs(sum(r.percentage for r in rows) - 100) < 0.05
        for r in rows:
            assert r["count"] == vc[r["Time signature"]]
            assert r.percentage == round(vc[r["Time signature"]] / len(grp) * 100 + 1e-12, 2)
    keys = res["share_key"]
    assert "key" in keys.columns  # name as typed, resolved case-insensitively
    emo = res["counts_emotion"].collect()
    assert {(r.good_for_study, r.emotion): r["count"] for r in emo} == \
        brute.groupby(["good_for_study", "emotion"]).size().to_dict()
    assert "joy" in {r.emotion for r in emo} and "Joy" not in {r.emotion for r in emo}
    totals = res["totals_time_signature"].collect()
    assert [r["count"] for r in totals] == sorted((r["count"] for r in totals), reverse=True)


def test_tag_comparison(spark, songs, songs_pd):
    table = studies.tag_table(songs)
    assert set(presets.USE_CASE_FLAGS.values()) <= set(table.columns)
    assert not set(presets.USE_CASE_FLAGS) & set(table.columns)
    got = {r.tagged_as: r for r in studies.tag_comparison(table, count_name="n").collect()}
    brute = _complete(songs_pd, [*presets.USE_CASE_FLAGS, *presets.SONG_MEASURES]).copy()
    for src, flag in presets.USE_CASE_FLAGS.items():
        brute[flag] = (brute[src] == 1).astype(int)
    for name, flags in presets.TAG_SEGMENTS.items():
        seg = brute[np.logical_and.reduce([brute[f] == 1 for f in flags])]
        if len(seg) == 0:
            assert name not in got
            continue
        assert got[name].n == len(seg)
        for src, alias in presets.SONG_MEASURES.items():
            assert _close(got[name][alias], seg[src].mean())


def test_partitioned_tables_round_trip(spark, songs, scratch):
    from facetspark.sinks import write_parquet
    from facetspark.sources import read_parquet

    table = studies.tag_table(songs)
    write_parquet(table, scratch + "/tags", partition_by=["good_for_study", "good_for_party"])
    back = read_parquet(spark, scratch + "/tags", schema=table.schema)
    a = studies.tag_comparison(back, count_name="n").orderBy("tagged_as").collect()
    b = studies.tag_comparison(table, count_name="n").orderBy("tagged_as").collect()
    assert [(r.tagged_as, r.n) for r in a] == [(r.tagged_as, r.n) for r in b]


def test_flag_profile_one_pass_equals_per_result_form(spark, songs):
    table = studies.flag_table(songs)
    one, each = studies.flag_profile(table), studies.flag_profile(table, one_pass=False)
    assert one.keys() == each.keys()

    def rows(df):
        return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()]

    for name in each:
        assert one[name].columns == each[name].columns, name
        assert rows(one[name]) == rows(each[name]), name  # same rows in the same order


def test_grouped_summary_scans_once(spark, songs):
    from facetspark.operators import profile

    table = studies.flag_table(songs)
    summary, ids = profile.grouped_summary(
        table, [["good_for_study"], ["good_for_study", "Key"], ["Key"]], {"avg_tempo": "Tempo"})
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "Expand" in plan
    assert len(set(ids.values())) == 3
    per_set = {r["_set"]: r["n"] for r in summary.groupBy("_set").agg(F.sum("count").alias("n")).collect()}
    assert per_set == {i: table.count() for i in ids.values()}  # every set covers every row


def test_category_index_with_known_supported_keys(spark, songs):
    stats = studies.category_measure(songs)["stats"]
    a = studies.category_index(songs)
    b = studies.category_index(songs, supported=stats)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_tag_comparison_prunes_folders_without_any_segment_flag(spark, songs):
    import tempfile

    from facetspark.sinks import write_parquet
    from facetspark.sources import read_parquet

    table = studies.tag_table(songs)
    path = tempfile.mkdtemp(prefix="facetspark-test-") + "/tags"
    write_parquet(table, path, partition_by=["good_for_study", "good_for_party"])
    back = read_parquet(spark, path, schema=table.schema)
    out = studies.tag_comparison(back, count_name="n")
    plan = out._jdf.queryExecution().executedPlan().toString()
    part = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "good_for_study" in part and "good_for_party" in part and "OR" in part
    want = {r.tagged_as: r.n for r in studies.tag_comparison(table, count_name="n").collect()}
    assert {r.tagged_as: r.n for r in out.collect()} == want


def test_typing_keeps_decimals_and_float_flags(spark, scratch):
    """Text such as "45.5", "85.0" and "1.0" is a value, not junk."""
    from facetspark.functions import presets
    from facetspark.plans import studies
    from facetspark.sinks import write_csv

    measures = [m for m in presets.SONG_MEASURES if m != "Popularity"]
    names = [*measures, "Popularity", *presets.USE_CASE_FLAGS, "Artist(s)", "song"]
    rows = [[*["5"] * len(measures), score, *[flag] * len(presets.USE_CASE_FLAGS), "a", "s"]
            for score, flag in (("85", "1"), ("85.0", "1.0"), ("45.5", "0"), ("20", "0.0"), ("junk", "1"))]
    path = f"{scratch}/songs"
    write_csv(spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names)), path)
    songs = studies.read_songs(spark, path)
    assert studies.score_buckets(songs)["coarse_rows"].count() == 4
    flags = studies.tag_table(songs).groupBy("good_for_study").count().collect()
    assert {r.good_for_study: r["count"] for r in flags} == {1: 2, 0: 2}


def test_flag_profile_leaves_out_null_flags_either_way(spark):
    from facetspark.plans import studies

    t = spark.createDataFrame([(1, "a", 1.0), (0, "a", 2.0), (None, "a", 9.0), (1, "b", 3.0)], "f int, c string, m double")
    for one_pass in (True, False):
        got = studies.flag_profile(t, "f", {"avg_m": "m"}, share_of=("c",), count_of=("C",), one_pass=one_pass)
        assert [(r.f, r.avg_m) for r in got["profile"].collect()] == [(0, 2.0), (1, 2.0)]
        assert {r.c: r["count"] for r in got["totals_c"].collect()} == {"a": 2, "b": 1}
        assert got["share_c"].count() == got["counts_c"].count() == 3


def test_carry_columns_resolve_in_any_case(spark):
    from facetspark.plans import studies

    t = spark.createDataFrame([("a", None, 5, 1.0, 2.0), ("b", "s", 6, 2.0, 3.0)],
                              "`artist(s)` string, SONG string, popularity int, danceability double, TEMPO double")
    assert studies.score_buckets(t)["coarse_rows"].count() == 1


def test_profiles_of_dotted_names_and_zero_cells(spark):
    from facetspark.operators import profile

    t = spark.createDataFrame([("x", "p", 1.0), ("y", "q", 3.0)], "`a.b` string, `c.d` string, `m.n` double")
    assert profile.counts(t, ["a.b", "c.d"]).count() == 2
    assert profile.mean_profile(t, "a.b", {"avg": "m.n"}, order=True).count() == 2
    assert profile.share_of_group(t, "a.b", "c.d").count() == 2
    plain = t.toDF("k", "v", "m")
    loose = sorted(tuple(r) for r in profile.pivot_counts(plain, "k", "v").collect())
    assert loose == sorted(tuple(r) for r in profile.pivot_counts(plain, "k", "v", ["p", "q"]).collect())


def test_flag_summary_is_one_aggregation_without_expand(spark, songs):
    table = studies.flag_table(songs)
    for name, df in studies.flag_profile(table, store=False).items():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan, name


def test_flag_profile_of_decimals_keeps_sparks_average(spark):
    t = spark.sql("SELECT id % 2 AS f, id % 3 AS c, CAST(id AS DECIMAL(12,2)) / 7 AS d FROM range(50)")
    kwargs = {"flag": "f", "measures": {"a": "d"}, "share_of": ("c",), "count_of": ()}
    one, each = studies.flag_profile(t, **kwargs), studies.flag_profile(t, one_pass=False, **kwargs)
    assert one.keys() == each.keys()
    for name in one:
        assert one[name].collect() == each[name].collect(), name


def test_flag_profile_measures_whether_one_pass_pays(spark, monkeypatch):
    """Categories with nearly as many values as rows are aggregated one by one; both sides give the same rows."""
    rows = spark.range(4000).selectExpr("cast(id % 2 as int) as f", "id as c", "id % 5 as d", "cast(id as double) as m")
    taken = []
    finest = studies.profile.finest_summary
    monkeypatch.setattr(studies.profile, "finest_summary", lambda *a: taken.append(1) or finest(*a))
    call = lambda **kw: studies.flag_profile(rows, "f", {"avg_m": "m"}, share_of=("c", "d"), count_of=(), **kw)
    apart = call()
    assert not taken
    together = call(max_share=1.1)
    assert taken == [1]
    assert not studies.profile.finest_pays(rows, ["d"], max_groups=3, max_share=0) and studies.profile.finest_pays(rows, ["f", "d"])
    studies.flag_profile(rows, "f", {"avg_m": "m"}, share_of=("d",), count_of=())
    assert taken == [1, 1]
    assert set(apart) == set(together)
    for name in apart:
        assert sorted(map(tuple, apart[name].collect())) == sorted(map(tuple, together[name].collect()))
