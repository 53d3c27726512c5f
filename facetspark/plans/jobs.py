"""Batch jobs: the song study end to end, with its files on disk.

Each job reads its input, writes the intermediate Parquet tables (partitioned
like the study's), reads them back with their schema, and writes the results
as Parquet and/or header CSV under ``out_root``. They return the result
DataFrames (already written) so a caller can inspect them.

Layout under ``out_root``::

    processed/songs.parquet                     the CSV export, typed, written once
    processed/ingest_losses_csv/                per typed column: rows, values, values that typing made null
    processed/songs_with_id.parquet             with --with-ids, in its place: id (file order) + the typed export
    processed/cleaned_emotion_tempo.parquet     emotion, Tempo
    processed/tempo_by_emotion.parquet          group statistics (snappy)
    processed/emotion_index_csv/                CSV part files: emotion_index, Tempo
    processed/popularity.parquet/               partitioned by popularity_bucket (4)
    processed/popularity_fine.parquet/          partitioned by popularity_bucket (10)
    processed/decades.parquet/                  partitioned by decade
    processed/good_for_study.parquet/           partitioned by good_for_study
    processed/good_for_study_tags.parquet/      partitioned by good_for_study, good_for_party
    results/...                                 one folder per result

Run: ``python -m facetspark.plans.jobs <songs.csv or folder> <out_root> [partitions] [--with-ids]
[--few-decade-columns]`` (on a cluster through ``spark-submit``, with ``spark.checkpoint.dir`` set).
"""

from __future__ import annotations

import sys
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetspark.functions import presets
from facetspark.functions.expressions import safe_corr
from facetspark.operators import keys, profile
from facetspark.operators.stored import materialise, temporary_tables
from facetspark.plans import studies
from facetspark.plans.sql import bucket_average
from facetspark.session import SCALE_CONF, apply_defaults, cluster_conf, ensure_checkpoint_dir, stored_bytes
from facetspark.sinks import write_csv, write_parquet
from facetspark.sources import read_parquet


def _side_by_side(fns, songs: DataFrame, out_root: str, concurrent: bool) -> list:
    """``[fn(songs, out_root) for fn in fns]``, submitted from separate driver
    threads when ``concurrent`` (Spark schedules their jobs side by side)."""
    if not concurrent:
        return [fn(songs, out_root) for fn in fns]
    with ThreadPoolExecutor(max_workers=len(fns), thread_name_prefix="facetspark-job") as pool:
        futures = [pool.submit(copy_context().run, fn, songs, out_root) for fn in fns]
        return [f.result() for f in futures]


def _p(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def _through_parquet(df: DataFrame, path: str, partition_by=(), codec: str = "snappy") -> DataFrame:
    """Write ``df`` and read it back with its own schema (types kept, empty ok).

    Partitioned tables are rebalanced before the write, so the number of files
    follows the size of each partition value, not tasks x values.
    """
    write_parquet(df, path, partition_by=partition_by, codec=codec, rebalance=bool(partition_by))
    return read_parquet(df.sparkSession, path, schema=df.schema)


def tempo_by_emotion_job(songs: DataFrame, out_root: str) -> dict[str, DataFrame]:
    cleaned = studies.category_measure(songs)["cleaned"]
    stored = _through_parquet(cleaned, _p(out_root, "processed", "cleaned_emotion_tempo.parquet"))
    stats = studies.category_measure(stored)["stats"]
    stats_path = _p(out_root, "processed", "tempo_by_emotion.parquet")
    write_parquet(stats, stats_path, codec="snappy")
    # the written stats hold exactly the supported emotions: no second count
    supported = read_parquet(songs.sparkSession, stats_path, schema=stats.schema)
    indexed = studies.category_index(stored, supported=supported)
    # one row per song: written by many tasks (a dashboard reads the folder);
    # a single file would send every row through one task
    write_csv(indexed, _p(out_root, "processed", "emotion_index_csv"))
    return {"stats": stats, "indexed": indexed}


def _coarse_branch(songs: DataFrame, out_root: str) -> dict[str, DataFrame]:
    """4-bucket table partitioned by bucket; correlations (grand total) and
    averages per bucket from one scan of it, stored once."""
    coarse = _through_parquet(studies.score_buckets(songs)["coarse_rows"],
                              _p(out_root, "processed", "popularity.parquet"), partition_by=["popularity_bucket"])
    pairs = {"corr_popularity_danceability": ("Popularity", "Danceability"),
             "corr_tempo_danceability": ("Tempo", "Danceability")}
    summary, ids = profile.grouped_summary(
        coarse, [["popularity_bucket"], []], {"avg_danceability": "Danceability"},
        aggregates={name: safe_corr(F.col(x), F.col(y)) for name, (x, y) in pairs.items()})
    summary, _ = materialise(summary, "popularity-summary")
    corr = summary.where(F.col("_set") == ids[()]).select(*pairs)
    coarse_avg = (summary.where(F.col("_set") == ids[("popularity_bucket",)])
                         .select("popularity_bucket", "avg_danceability").orderBy("popularity_bucket"))
    write_csv(corr, _p(out_root, "results", "popularity_correlations_csv"), single_file=True)
    write_csv(coarse_avg, _p(out_root, "results", "danceability_by_popularity4_csv"), single_file=True)
    return {"correlations": corr, "coarse": coarse_avg}


def _fine_branch(songs: DataFrame, out_root: str) -> dict[str, DataFrame]:
    """10-bucket table partitioned by bucket; averages per bucket in SQL."""
    fine = _through_parquet(studies.score_buckets(songs)["fine_rows"],
                            _p(out_root, "processed", "popularity_fine.parquet"), partition_by=["popularity_bucket"])
    fine_avg = bucket_average(fine, "popularity_bucket", "Danceability")
    write_csv(fine_avg, _p(out_root, "results", "danceability_by_popularity10_csv"), single_file=True)
    return {"fine": fine_avg}


def popularity_job(songs: DataFrame, out_root: str, concurrent: bool = True) -> dict[str, DataFrame]:
    """Bucketed tables partitioned by bucket; correlations and bucket averages
    read back from them (the bucket is the discovered partition column). The
    4- and 10-bucket branches are independent and run side by side."""
    out: dict[str, DataFrame] = {}
    for res in _side_by_side([_coarse_branch, _fine_branch], songs, out_root, concurrent):
        out.update(res)
    return out


def decade_job(songs: DataFrame, out_root: str, keep_all_columns: bool = True) -> dict[str, DataFrame]:
    """Decade table partitioned by decade, then the decade profile.

    The table has every column of ``songs``; ``keep_all_columns=False`` writes
    only the four that the profile reads.
    """
    cols = songs.columns if keep_all_columns else [presets.RELEASE_DATE, "Positiveness", "Tempo", "Energy"]
    rows = studies.decade_trends(songs.select(*[f"`{c}`" for c in cols]))["rows"]
    stored = _through_parquet(rows, _p(out_root, "processed", "decades.parquet"), partition_by=["decade"])
    measures = {"avg_positiveness": "Positiveness",
                "avg_tempo": F.col("Tempo") * F.lit(presets.DECADE_TEMPO_SCALE),
                "avg_energy": "Energy"}
    prof = profile.decade_profile(stored, "decade", measures, count_name="n_songs")
    write_parquet(prof, _p(out_root, "results", "decade_profile.parquet"))
    write_csv(prof, _p(out_root, "results", "decade_profile_csv"), single_file=True)
    return {"profile": prof}


def _flag_branch(songs: DataFrame, out_root: str) -> dict[str, DataFrame]:
    table = _through_parquet(studies.flag_table(songs), _p(out_root, "processed", "good_for_study.parquet"),
                             partition_by=["good_for_study"])
    res = studies.flag_profile(table)
    write_parquet(res["profile"], _p(out_root, "results", "good_for_study_profile.parquet"))
    write_csv(res["profile"], _p(out_root, "results", "good_for_study_profile_csv"), single_file=True)
    write_csv(res["share_time_signature"], _p(out_root, "results", "good_for_study_time_signature_csv"),
              single_file=True)
    write_csv(res["counts_emotion"], _p(out_root, "results", "good_for_study_emotion_csv"), single_file=True)
    write_csv(res["share_key"], _p(out_root, "results", "good_for_study_keys_csv"), single_file=True)
    return res


def _tag_branch(songs: DataFrame, out_root: str) -> dict[str, DataFrame]:
    tags = _through_parquet(studies.tag_table(songs), _p(out_root, "processed", "good_for_study_tags.parquet"),
                            partition_by=["good_for_study", "good_for_party"])
    # a few rows that two files and the caller read: computed once
    comparison, _ = materialise(studies.tag_comparison(tags, count_name="n_songs"), "tag-comparison")
    write_csv(comparison, _p(out_root, "results", "tag_comparison_csv"), single_file=True)
    study = comparison.where(F.col("tagged_as") == F.lit(presets.STUDY_SEGMENT))
    write_csv(study, _p(out_root, "results", "good_for_study_songs_csv"), single_file=True)
    return {"tag_comparison": comparison, "study_segment": study}


def study_job(songs: DataFrame, out_root: str, concurrent: bool = True) -> dict[str, DataFrame]:
    """The flag comparison and the tag comparison: two independent branches
    (each its own table from ``songs``), run side by side with ``concurrent``."""
    out: dict[str, DataFrame] = {}
    for res in _side_by_side([_flag_branch, _tag_branch], songs, out_root, concurrent):
        out.update(res)
    return out


def row_id_job(spark: SparkSession, songs_path: str, out_root: str,
               partitions: int | str | None = "auto") -> DataFrame:
    """The export with a contiguous 1-based ``id`` first, in file order
    (numbered as scanned, before rows are spread over the cores), typed, and
    written to ``processed/songs_with_id.parquet``."""
    raw = studies.read_songs(spark, songs_path, partitions=None)
    with temporary_tables(spark):
        numbered = keys.row_id(raw, spread=partitions)
        return _through_parquet(numbered, _p(out_root, "processed", "songs_with_id.parquet"))


def run_all(spark: SparkSession, songs_path: str, out_root: str,
            partitions: int | str | None = "auto", with_ids: bool = False,
            concurrent: bool = True, decade_all_columns: bool = True) -> dict[str, DataFrame]:
    """Convert the CSV export once to typed Parquet, then run every job from it.

    A multi-line CSV file is read by one task and cannot be pruned; Parquet
    is split across tasks and lets each job read only its columns.

    The four studies only share the typed table, so with ``concurrent`` they
    are submitted from separate driver threads and Spark runs their jobs
    side by side (its scheduler hands free task slots to whichever job has
    work), instead of leaving slots idle during each study's small jobs.
    """
    if with_ids:  # the numbered table is the typed export: one parse, one copy
        numbered = row_id_job(spark, songs_path, out_root, partitions)
        songs = numbered.drop("id")
    else:
        raw, found = studies.read_songs_counted(spark, songs_path, partitions=partitions)
        songs = _through_parquet(raw, _p(out_root, "processed", "songs.parquet"))
        # observed in that write: per typed column, the values that were no number
        write_csv(found.report(spark).coalesce(1), _p(out_root, "processed", "ingest_losses_csv"))
    names = ["tempo", "popularity", "decade", "study"]
    fns = [tempo_by_emotion_job, partial(popularity_job, concurrent=concurrent),
           partial(decade_job, keep_all_columns=decade_all_columns), partial(study_job, concurrent=concurrent)]
    results = _side_by_side(fns, songs, out_root, concurrent)
    out: dict[str, DataFrame] = {}
    for name, res in zip(names, results):
        out.update({f"{name}.{k}": v for k, v in res.items()})
    if with_ids:
        out["ids.songs"] = numbered
    return out


def parse_args(argv: list[str]) -> dict | None:
    """``<songs> <out_root> [partitions] [--with-ids] [--few-decade-columns]`` ->
    keyword arguments of ``run_all`` (without the session); None when the paths
    are missing."""
    with_ids = "--with-ids" in argv[1:]
    few = "--few-decade-columns" in argv[1:]
    args = [a for a in argv[1:] if a not in ("--with-ids", "--few-decade-columns")]
    if len(args) < 2:
        return None
    return {"songs_path": args[0], "out_root": args[1],
            "partitions": int(args[2]) if len(args) > 2 else "auto", "with_ids": with_ids,
            **({"decade_all_columns": False} if few else {})}


def main(argv: list[str]) -> int:
    kwargs = parse_args(argv)
    if kwargs is None:
        print(__doc__)
        return 2
    builder = SparkSession.builder.appName("facetspark-song-study")
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark, cluster_conf(stored_bytes(spark, kwargs["songs_path"])))
    ensure_checkpoint_dir(spark)
    with temporary_tables(spark):  # every result is a file by then
        run_all(spark, **kwargs)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
