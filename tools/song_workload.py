"""The song study as a workload over the test tables, for timing.

``song_export`` derives a song-shaped export from ``lineitem`` (one song per
line item, every column computed by Spark from the line's values), with the
awkward parts of the real export: multi-line quoted titles with doubled
quotes, mixed-case emotions, dates that are missing or not dates, and a unit
suffix on some loudness values. Written once as CSV, it feeds:

* ``run_ours``: ``facetspark.plans.jobs.run_all`` -- the CSV converted once to
  typed Parquet, each study reading only its columns, one pass per question.
* ``run_unshared``: the same result files from the same studies with nothing
  shared: every result parses the CSV again and is its own action.

Usage: python tools/song_workload.py [sf_dir] [--check]   (prints one JSON line;
--check compares the result files of both instead of timing them)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from facetspark.functions import presets  # noqa: E402
from facetspark.operators import keys, segments  # noqa: E402
from facetspark.plans import studies  # noqa: E402
from facetspark.sinks import write_csv, write_parquet  # noqa: E402
from facetspark.sources import read_csv, read_table  # noqa: E402


def _pick(values: list[str], key) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def song_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One song per line item; all values text, as in a CSV export."""
    li = read_table(spark, sf_dir, "lineitem")
    h = F.xxhash64("l_orderkey", "l_linenumber")
    title = F.concat(F.lit("Song "), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    title = F.when(F.col("l_linenumber") == 7, F.concat(title, F.lit(' "live"\nsecond line'))).otherwise(title)
    shifted = F.add_months(F.col("l_shipdate").cast("date"), -12 * F.pmod(F.col("l_partkey"), F.lit(60)).cast("int"))
    release = (F.when(F.col("l_linenumber") == 4, F.lit(None).cast("string"))
                .when(F.pmod(F.col("l_orderkey"), F.lit(13)) == 0, F.lit("29th April 2013"))
                .otherwise(F.date_format(shifted, "yyyy-MM-dd")))
    loud = F.format_string("%.2f", -F.col("l_discount") * 200)
    loud = F.when(F.pmod(F.col("l_partkey"), F.lit(11)) == 0, F.concat(loud, F.lit(" dB"))).otherwise(loud)
    flags = [F.shiftright(h, i).bitwiseAND(1).cast("string") for i in range(6)]
    cols = {
        "Artist(s)": F.concat(F.lit("Artist "), F.col("l_suppkey").cast("string")),
        "song": title,
        "emotion": _pick(["joy", "sadness", "anger", "love", "fear", "surprise", "Joy", "calm"], F.col("l_partkey")),
        "Release Date": release,
        "Key": _pick(["C Maj", "D min", "E Maj", "F Maj", "G Maj", "A min", "B min", "C# min"], F.col("l_suppkey")),
        "Time signature": _pick(["4/4", "4/4", "4/4", "3/4", "5/4", "1/4"], F.col("l_orderkey")),
        "Tempo": F.format_string("%.3f", F.lit(60.0) + F.col("l_extendedprice") % 140),
        "Loudness (db)": loud,
        "Energy": (F.col("l_quantity") * 2).cast("int").cast("string"),
        "Positiveness": F.round(F.col("l_tax") * 1000).cast("int").cast("string"),
        "Speechiness": (F.col("l_linenumber") * 10).cast("string"),
        "Instrumentalness": F.pmod(F.col("l_partkey"), F.lit(101)).cast("string"),
        "Danceability": F.pmod(F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.lit(101)).cast("string"),
        "Acousticness": F.pmod(F.col("l_suppkey"), F.lit(101)).cast("string"),
        "Popularity": (F.col("l_quantity") * 2).cast("int").cast("string"),
    }
    for (source, _), bit in zip(presets.USE_CASE_FLAGS.items(), flags):
        cols[source] = bit
    return li.select(*[c.alias(n) for n, c in cols.items()])


def _p(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def run_ours(spark: SparkSession, csv_path: str, out_root: str) -> None:
    from facetspark.plans.jobs import run_all

    run_all(spark, csv_path, out_root)


RESULTS = [
    "processed/tempo_by_emotion.parquet", "processed/emotion_index_csv",
    "results/danceability_by_popularity4_csv", "results/danceability_by_popularity10_csv",
    "results/decade_profile.parquet", "results/good_for_study_profile.parquet",
    "results/good_for_study_time_signature_csv", "results/good_for_study_keys_csv",
    "results/good_for_study_emotion_csv", "results/tag_comparison_csv",
]


def run_unshared(spark: SparkSession, csv_path: str, out_root: str) -> None:
    """The same result files with nothing shared: every result parses the CSV
    again and aggregates on its own, segments are filtered and profiled one
    by one and then put together, and one task numbers the categories."""
    def songs() -> DataFrame:
        return studies.read_songs(spark, csv_path)

    def table() -> DataFrame:
        return studies.flag_table(songs())

    def index() -> DataFrame:
        rows = studies.category_measure(songs())["cleaned"]
        supported = keys.supported_keys(rows, presets.EMOTION, presets.MIN_SONGS_PER_EMOTION).select(presets.EMOTION)
        numbered = supported.withColumn("emotion_index", F.row_number().over(Window.orderBy(presets.EMOTION)) - 1)
        return rows.join(numbered, presets.EMOTION).select("emotion_index", "Tempo")

    def tags() -> DataFrame:
        return segments.union_profiles([
            segments.segment_profile(studies.tag_table(songs()), {name: segments.all_of(*flags)},
                                     presets.SONG_MEASURES_BY_ALIAS, label="tagged_as")
            for name, flags in presets.TAG_SEGMENTS.items()])

    def alone(name: str):
        return lambda: studies.flag_profile(table(), one_pass=False)[name]

    makers = [
        lambda: studies.category_measure(songs())["stats"], index,
        lambda: studies.score_buckets(songs())["coarse"], lambda: studies.score_buckets(songs())["fine"],
        lambda: studies.decade_trends(songs())["profile"], alone("profile"), alone("share_time_signature"),
        alone("share_key"), alone("counts_emotion"), tags,
    ]
    for rel, make in zip(RESULTS, makers):
        write = write_parquet if rel.endswith(".parquet") else write_csv
        write(make(), _p(out_root, rel))


# (ours, unshared, format) of the result files that must hold the same rows
PAIRS = [(rel, rel, "parquet" if rel.endswith(".parquet") else "csv") for rel in RESULTS]


def read_result(spark: SparkSession, root: str, rel: str, kind: str) -> DataFrame:
    path = f"{root}/{rel}"
    return spark.read.parquet(path) if kind == "parquet" else read_csv(spark, path, infer_schema=True)


def result_rows(df: DataFrame, cols: list[str]) -> list[tuple]:
    """Rows of ``cols``, doubles rounded to 6 digits, in a fixed order."""
    def norm(v):
        return round(float(v), 6) if isinstance(v, float) else v
    return sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)


def same_results(spark: SparkSession, ours: str, shape: str) -> dict[str, bool]:
    """For each pair: equal rows over the shared columns."""
    out = {}
    for ours_rel, shape_rel, kind in PAIRS:
        a, b = read_result(spark, ours, ours_rel, kind), read_result(spark, shape, shape_rel, kind)
        lower_b = {c.lower(): c for c in b.columns}
        common = [c for c in a.columns if c.lower() in lower_b]
        other = b.select(*[lower_b[c.lower()] for c in common]).toDF(*common)
        out[ours_rel] = len(common) >= 2 and result_rows(a, common) == result_rows(other, common)
    return out


def export_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the song export of ``sf_dir`` once as CSV; returns its folder."""
    from facetspark.session import scratch_dir

    path = scratch_dir(spark, "song-export")
    write_csv(song_export(spark, sf_dir), path)
    return path


def compare(spark: SparkSession, sf_dir: str, warm_dir: str | None = None, repeat: int = 1) -> dict:
    """Seconds for ours and for the unshared form on the export of ``sf_dir``
    (export not timed; best of ``repeat`` runs each, alternating).
    ``warm_dir``: run both once on its export first."""
    from facetspark.session import scratch_dir

    if warm_dir and os.path.isdir(warm_dir):
        small = export_csv(spark, warm_dir)
        run_ours(spark, small, scratch_dir(spark, "warm-ours"))
        run_unshared(spark, small, scratch_dir(spark, "warm-unshared"))
    csv_path = export_csv(spark, sf_dir)
    out: dict[str, float] = {}
    for _ in range(repeat):
        for name, fn in (("song_pipeline", run_ours), ("unshared", run_unshared)):
            t0 = time.perf_counter()
            fn(spark, csv_path, scratch_dir(spark, name))
            dt = round(time.perf_counter() - t0, 3)
            out[name] = min(out.get(name, dt), dt)
    return out


def main() -> None:
    from facetspark.session import local_session

    args = [a for a in sys.argv[1:] if a != "--check"]
    sf_dir = args[0] if args else os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("song-workload", cores=os.environ.get("BENCH_CPUS", "8"))
    if "--check" in sys.argv:
        from facetspark.session import scratch_dir

        csv_path = export_csv(spark, sf_dir)
        ours, shape = scratch_dir(spark, "ours"), scratch_dir(spark, "shape")
        run_ours(spark, csv_path, ours)
        run_unshared(spark, csv_path, shape)
        res = same_results(spark, ours, shape)
        print(json.dumps({"sf_dir": sf_dir, "same": all(res.values()), "pairs": res}))
        spark.stop()
        return
    res = compare(spark, sf_dir, os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001"),
                  repeat=int(os.environ.get("BENCH_REPEAT", "2")))
    print(json.dumps({"sf_dir": sf_dir, **res}))
    spark.stop()


if __name__ == "__main__":
    main()
