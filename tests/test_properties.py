"""Property tests on random small tables (few examples: each one runs Spark jobs)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from facetspark.functions import presets
from facetspark.operators import derive, keys, profile, segments

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 100)),          # score
        st.sampled_from(["a", "b", "c", None]),              # outer
        st.sampled_from(["x", "y", "z", "w", None]),         # inner
        st.integers(0, 1), st.integers(0, 1),                # flags
        st.floats(-1e3, 1e3, allow_nan=False),               # measure
    ),
    min_size=1, max_size=60)

SCHEMA = "score int, outer string, inner string, f1 int, f2 int, m double"


def _label(score):
    if score is None:
        return None
    for b, lab in zip(presets.POPULARITY_BOUNDS_4, presets.POPULARITY_LABELS_4):
        if score < b:
            return lab
    return presets.POPULARITY_LABELS_4[-1]


@SETTINGS
@given(rows_st)
def test_bucket_counts_sum_to_input(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = dict(derive.with_popularity_bucket(df, "score").groupBy("popularity_bucket").count().collect())
    want = {}
    for r in rows:
        want[_label(r[0])] = want.get(_label(r[0]), 0) + 1
    assert got == want


@SETTINGS
@given(rows_st)
def test_shares_sum_to_100_per_group(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = profile.share_of_group(df, "outer", "inner").collect()
    groups = {}
    for r in out:
        groups.setdefault(r.outer, []).append(r)
    sizes = {}
    for r in rows:
        if r[1] is not None:
            sizes[r[1]] = sizes.get(r[1], 0) + 1
    assert set(groups) == set(sizes)
    for g, rs in groups.items():
        assert sum(r["count"] for r in rs) == sizes[g]
        assert abs(sum(r.percentage for r in rs) - 100) <= 0.005 * len(rs) + 1e-9


@SETTINGS
@given(rows_st)
def test_one_pass_segments_equal_union_form(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    segs = {"one": F.col("f1") == 1, "both": (F.col("f1") == 1) & (F.col("f2") == 1), "two": F.col("f2") == 1}
    a = {r.tagged_as: (r.n, r.avg_m) for r in segments.segment_profile(df, segs, ["m"], count_name="n").collect()}
    b = {r.tagged_as: (r.n, r.avg_m) for r in segments.union_profiles(
        [segments.labelled_profile(df, c, name, ["m"], count_name="n") for name, c in segs.items()],
        share_scan=False).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == b[k][0]
        assert abs(a[k][1] - b[k][1]) <= 1e-9 * max(1.0, abs(b[k][1]))


@SETTINGS
@given(rows_st, st.integers(1, 5))
def test_row_ids_are_one_to_n_in_order(spark, rows, parts):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "pos int, " + SCHEMA).repartition(parts)
    out = keys.row_id(df, order_by=["m", "pos"]).select("id", "pos").collect()
    want = [p for _, p in sorted((r[-1], i) for i, r in enumerate(rows))]
    assert [r.pos for r in sorted(out, key=lambda r: r.id)] == want
    assert sorted(r.id for r in out) == list(range(1, len(rows) + 1))


@SETTINGS
@given(rows_st)
def test_dense_index_is_rank_of_sorted_keys(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = keys.dense_index(df, "inner", "i").select("inner", "i").distinct().collect()
    names = sorted({r[2] for r in rows if r[2] is not None})
    assert {r.inner: r.i for r in out} == {n: i for i, n in enumerate(names)}


@SETTINGS
@given(rows_st)
def test_grouped_summary_equals_one_group_by_per_set(spark, rows):
    """One grouping-sets scan gives, per set, the counts and averages of a
    plain GROUP BY -- null category values included and kept apart from
    "not grouped by this column"."""
    df = spark.createDataFrame(rows, SCHEMA)
    sets = [["f1"], ["f1", "outer"], ["f1", "inner"], ["outer"]]
    summary, ids = profile.grouped_summary(df, sets, {"avg_m": "m"})
    got_rows = summary.collect()
    for s in sets:
        want = {tuple(r[c] for c in s): (r["count"], r["avg_m"])
                for r in df.groupBy(*s).agg(F.count(F.lit(1)).alias("count"), F.avg("m").alias("avg_m")).collect()}
        got = {tuple(r[c] for c in s): (r["count"], r["avg_m"]) for r in got_rows if r["_set"] == ids[tuple(s)]}
        assert got.keys() == want.keys()
        for k in want:
            assert got[k][0] == want[k][0]
            assert abs(got[k][1] - want[k][1]) <= 1e-9 * max(1.0, abs(want[k][1]))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 2)), min_size=1, max_size=80),
       st.integers(1, 5), st.sampled_from([None, 3, "auto"]))
def test_row_ids_with_copies_and_spread(spark, rows, parts, spread):
    """Mostly identical rows: ids are exactly 1..n and follow the key order
    (nulls first), whether or not the numbered rows are spread."""
    df = spark.createDataFrame(rows, "k string, v int").repartition(parts)
    out = keys.row_id(df, order_by=["k"], spread=spread).collect()
    assert sorted(r.id for r in out) == list(range(1, len(rows) + 1))
    ks = [r.k for r in sorted(out, key=lambda r: r.id)]
    assert ks == sorted(ks, key=lambda k: (k is not None, k or ""))
    assert sorted(map(tuple, ((r.k, r.v) for r in out)), key=repr) == sorted(rows, key=repr)


TEXT = st.one_of(
    st.none(),
    st.text(alphabet=st.one_of(st.sampled_from(list(' ,"\\\n\r\t;é€ab')),
                               st.characters(blacklist_categories=("Cs", "Cc"))), max_size=24),
)


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=25))
def test_csv_round_trip_of_any_text(spark, texts):
    """Whatever the text (quotes, commas, line breaks, edge spaces, empty),
    write_csv + read_csv(empty_as_null=False) gives it back; null stays null.
    (The NUL character is the reader's null marker in this mode.)"""
    import tempfile

    from facetspark.sinks import write_csv
    from facetspark.sources import read_csv

    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "id int, t string")
    path = tempfile.mkdtemp(prefix="facetspark-prop-") + "/csv"
    write_csv(df, path)
    back = dict(map(tuple, read_csv(spark, path, schema=df.schema, empty_as_null=False).collect()))
    assert back == dict(rows)


@SETTINGS
@given(rows_st)
def test_flag_profile_one_pass_equals_per_result_form(spark, rows):
    """Random flags, null categories included: the grouping-sets summary gives
    the same tables, in the same order, as one aggregation per result."""
    from facetspark.plans import studies

    df = spark.createDataFrame(rows, SCHEMA)
    kwargs = dict(flag="f1", measures={"avg_m": "m"}, share_of=("outer",), count_of=("inner",))
    one = studies.flag_profile(df, one_pass=True, **kwargs)
    each = studies.flag_profile(df, one_pass=False, **kwargs)

    def rows_of(d):
        return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in d.collect()]

    assert one.keys() == each.keys()
    for name in each:
        assert one[name].columns == each[name].columns, name
        assert rows_of(one[name]) == rows_of(each[name]), name
