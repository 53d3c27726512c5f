"""The four song studies, composed from the operators.

Each function takes the raw table (as read by ``sources.read_csv`` or a
Parquet scan) and returns a dict of lazy result DataFrames; nothing is
written unless a caller passes a result to ``sinks``. Column names default
to the song export's and are parameters, so the same plans run over any
table with a category, a score, a date or 0/1 tags.

1. ``category_measure``  -- e.g. tempo by emotion: group statistics with a
   minimum support, and a dense category index for a dashboard.
2. ``score_buckets``     -- e.g. danceability by popularity: correlations and
   averages per fixed score bucket (4 and 10 buckets), via SQL.
3. ``decade_trends``     -- e.g. positiveness / tempo / energy per decade.
4. ``flag_profile`` and ``tag_comparison`` -- e.g. "good for study" songs:
   mean profiles, category counts and shares per flag value, and a
   comparison of overlapping tag segments.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetspark.functions import presets
from facetspark.functions.expressions import percentage
from facetspark.operators import clean, derive, keys, profile, segments
from facetspark.operators.stored import materialise
from facetspark.plans.sql import bucket_average
from facetspark.sources.csv import read_csv

# Unit suffix some exports put after loudness values ("-5.2 dB"); in any other
# column such a text is no number.
UNIT_SUFFIX = {presets.LOUDNESS: r"(?i)\s*db$"}


def song_types() -> dict[str, str]:
    """Types of the song columns the studies use; everything else stays text.

    All are double: a score such as ``45.5`` or a flag written ``1.0`` is a
    value like any other and must not become null.
    """
    return {c: "double" for c in (*presets.SONG_MEASURES, "Popularity", *presets.USE_CASE_FLAGS)}


def read_songs(spark, path, partitions: int | str | None = "auto") -> DataFrame:
    """Read the song CSV export(s) and type the columns the studies use.

    Values that do not convert (junk text) become null, and are then
    dropped by each study's complete-row step, instead of failing the job.
    Columns missing from the file are skipped.
    """
    raw, types = _raw_songs(spark, path, partitions)
    return clean.typed(raw, types, strip_pattern=UNIT_SUFFIX)


def read_songs_counted(spark, path, partitions: int | str | None = "auto") -> tuple[DataFrame, clean.Conversions]:
    """``read_songs``, and per typed column how many values typing makes null,
    known once the first pass over the songs (the ingest's write) is done."""
    raw, types = _raw_songs(spark, path, partitions)
    return clean.typed_counted(raw, types, strip_pattern=UNIT_SUFFIX)


def _raw_songs(spark, path, partitions: int | str | None) -> tuple[DataFrame, dict[str, str]]:
    raw = read_csv(spark, path, partitions=partitions)
    present = {c.lower() for c in raw.columns}
    return raw, {c: t for c, t in song_types().items() if c.lower() in present}


def category_measure(raw: DataFrame, category: str = presets.EMOTION, measure: str = "Tempo",
                     min_count: int = presets.MIN_SONGS_PER_EMOTION, label: str | None = None,
                     count_name: str = "song_count") -> dict[str, DataFrame]:
    """Statistics of ``measure`` per ``category`` with at least ``min_count`` rows.

    * ``cleaned``: complete (category, measure) rows.
    * ``stats``: avg/min/max/stddev/count per supported category, sorted by
      the average. Lazy: one aggregation, no extra job.
    """
    lab = label or measure.lower()
    rows = clean.project_complete(raw, [F.col(f"`{category}`"), F.col(f"`{measure}`")])
    stats = profile.group_stats(rows, category, measure, min_count=min_count, label=lab, count_name=count_name)
    return {"cleaned": rows, "stats": stats}


def category_index(raw: DataFrame, category: str = presets.EMOTION, measure: str = "Tempo",
                   min_count: int = presets.MIN_SONGS_PER_EMOTION, index_col: str | None = None,
                   supported: DataFrame | None = None) -> DataFrame:
    """Rows of supported categories as (0-based category index int, measure double).

    The supported categories are counted with a partial aggregation, numbered
    in sorted order (materialised, size-checked), and joined back once:
    that single join both keeps the supported rows and attaches the index.
    ``supported`` gives the supported categories when they are already known
    (e.g. the keys of the written ``stats`` table), saving that count.
    """
    idx = index_col or f"{category}_index"
    rows = clean.project_complete(raw, [F.col(f"`{category}`"), F.col(f"`{measure}`")])
    if supported is None:
        supported = keys.supported_keys(rows, category, min_count)
    supported = supported.select(F.col(f"`{category}`"))
    return (keys.dense_index(rows, category, idx, keys=supported)
            .select(F.col(idx).cast("int").alias(idx), F.col(f"`{measure}`").cast("double").alias(measure)))


def score_buckets(raw: DataFrame, score: str = "Popularity", measure: str = "Danceability",
                  other: str = "Tempo", carry: Sequence[str] = ("Artist(s)", "song"),
                  bucket_column: str = "popularity_bucket",
                  coarse: tuple[Sequence[float], Sequence[str]] = (presets.POPULARITY_BOUNDS_4, presets.POPULARITY_LABELS_4),
                  fine: tuple[Sequence[float], Sequence[str]] = (presets.POPULARITY_BOUNDS_10, presets.POPULARITY_LABELS_10),
                  ) -> dict[str, DataFrame]:
    """Correlations of score and ``other`` with ``measure``, and bucket averages.

    * ``coarse_rows`` / ``fine_rows``: cleaned rows with the bucket label
      (the tables the study writes partitioned by bucket).
    * ``correlations``: one row, ``corr_<score>_<measure>`` and
      ``corr_<other>_<measure>``, computed in one pass.
    * ``coarse`` / ``fine``: average of ``measure`` per bucket, in label order.
    """
    present = {c.lower() for c in raw.columns}
    cols = [*(c for c in carry if c.lower() in present), score, measure, other]
    rows = clean.project_complete(raw, [F.col(f"`{c}`") for c in cols])
    coarse_rows = derive.with_bucket(rows, score, coarse[0], coarse[1], bucket_column)
    fine_rows = derive.with_bucket(rows, score, fine[0], fine[1], bucket_column)
    corr = profile.correlations(rows, {
        f"corr_{score.lower()}_{measure.lower()}": (score, measure),
        f"corr_{other.lower()}_{measure.lower()}": (other, measure),
    })
    return {
        "coarse_rows": coarse_rows,
        "fine_rows": fine_rows,
        "correlations": corr,
        "coarse": bucket_average(coarse_rows, bucket_column, measure),
        "fine": bucket_average(fine_rows, bucket_column, measure),
    }


def decade_trends(raw: DataFrame, date: str = presets.RELEASE_DATE,
                  measures: Mapping[str, str | Column] | None = None,
                  count_name: str = "n_songs", decade_column: str = "decade") -> dict[str, DataFrame]:
    """Averages per decade of the date column; rows without a valid date are left out.

    Default measures: positiveness, tempo x 100, energy.
    * ``rows``: the input with ``decade`` added (the study's partitioned table).
    * ``profile``: one row per decade, oldest first.
    """
    if measures is None:
        measures = {
            "avg_positiveness": "Positiveness",
            "avg_tempo": F.col("Tempo") * F.lit(presets.DECADE_TEMPO_SCALE),
            "avg_energy": "Energy",
        }
    rows = derive.with_decade(raw, date, decade_column)
    return {"rows": rows, "profile": profile.decade_profile(rows, decade_column, measures, count_name)}


def flag_table(raw: DataFrame, source_flag: str = "Good for Work/Study", flag: str = "good_for_study",
               measures: Sequence[str] = tuple(presets.SONG_MEASURES),
               categories: Sequence[str] = (presets.TIME_SIGNATURE, presets.EMOTION, presets.KEY),
               lower: Sequence[str] = (presets.EMOTION,), truthy: object = 1) -> DataFrame:
    """Complete rows of the flag, measures and categories, the 0/1 flag added,
    text categories lower-cased (the study's table partitioned by the flag)."""
    cols = [source_flag, *measures, *categories]
    rows = clean.project_complete(raw, [F.col(f"`{c}`") for c in cols])
    rows = derive.with_flags(rows, {source_flag: flag}, truthy=truthy)
    return clean.lower_case(rows, *lower) if lower else rows


def flag_profile(table: DataFrame, flag: str = "good_for_study",
                 measures: Mapping[str, str | Column] | None = None,
                 share_of: Sequence[str] = (presets.TIME_SIGNATURE, "key"),
                 count_of: Sequence[str] = (presets.EMOTION,), one_pass: bool | str = "auto",
                 store: bool = True, max_share: float = profile.FINEST_SHARE,
                 max_groups: int = profile.FINEST_GROUPS) -> dict[str, DataFrame]:
    """Compare flag = 0 with flag = 1.

    * ``profile``: average of each measure per flag value.
    * ``counts_<c>``: rows per (flag, c), by flag then count descending.
    * ``totals_<c>``: rows per c over both flag values, count descending.
    * ``share_<c>``: rows and % of the flag group per (flag, c).

    Rows without a flag are left out of every result. A column may be both in
    ``share_of`` and ``count_of``.

    In one pass every result is rolled up from one aggregation of ``table`` on
    the flag and all categories: a single scan however many results. ``store``
    writes that summary once to the shared checkpoint folder (one job runs
    here), for callers that use several results; without it the results are
    lazy and each computes it for itself. The summary has one row per
    combination of flag and categories that occurs, which can come near the
    rows of the table where the columns have many values. So ``one_pass="auto"``
    takes it if it is sure to be small: by ``profile.finest_pays``, which
    estimates the combinations from one pass over the key columns and compares
    them with ``max_share`` of the rows and ``max_groups`` (with ``store``; a
    lazy call runs no job and goes in one pass). Otherwise, and with
    ``one_pass=False``, each result is its own lazy aggregation over ``table``.
    Averages that are not double (decimal measures) are always taken from
    ``table``, with Spark's own rounding. All forms give the same rows.
    """
    ms = measures if measures is not None else presets.SONG_MEASURES_BY_ALIAS
    table = table.where(F.col(f"`{flag}`").isNotNull())
    shared = {c.lower() for c in share_of}
    count_of = [c for c in count_of if c.lower() not in shared]
    if one_pass == "auto" and (share_of or count_of):
        one_pass = not store or profile.finest_pays(table, [flag, *share_of, *count_of], max_share, max_groups)
    if not one_pass or not (share_of or count_of):  # a single result: nothing to share
        out = {"profile": profile.mean_profile(table, flag, ms, order=True)}
        for c in share_of:
            name = c.lower().replace(" ", "_")
            out[f"counts_{name}"] = profile.counts(table, [flag, c])
            out[f"totals_{name}"] = profile.counts(table, c)
            out[f"share_{name}"] = profile.share_of_group(table, flag, c)
        for c in count_of:
            out[f"counts_{c.lower().replace(' ', '_')}"] = profile.counts(table, [flag, c])
        return out

    categories = [*share_of, *count_of]
    summary, averages = profile.finest_summary(table, [flag, *categories], ms)
    if store:
        summary, _ = materialise(summary, "flag-summary")

    def rolled(*ks: str) -> DataFrame:
        return summary.groupBy(*[F.col(f"`{k}`") for k in ks]).agg(F.sum(profile.FINEST_ROWS).alias("count"))

    def by_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        first, rest = keys[0], keys[1:]
        if not rest:
            return df.orderBy(F.desc("count"), F.asc(f"`{first}`"))
        return df.orderBy(F.asc(f"`{first}`"), F.desc("count"), *[F.asc(f"`{k}`") for k in rest])

    if averages is None:
        out = {"profile": profile.mean_profile(table, flag, ms, order=True)}
    else:
        out = {"profile": summary.groupBy(F.col(f"`{flag}`")).agg(*averages).orderBy(f"`{flag}`")}
    for c in share_of:
        name = c.lower().replace(" ", "_")
        out[f"counts_{name}"] = by_count(rolled(flag, c), [flag, c])
        out[f"totals_{name}"] = by_count(rolled(c), [c])
        groups = rolled(flag).withColumnRenamed("count", "_group_rows")
        share = rolled(flag, c).join(groups, flag).select(
            F.col(f"`{flag}`"), F.col(f"`{c}`"), F.col("count"),
            percentage(F.col("count"), F.col("_group_rows")).alias("percentage"))
        out[f"share_{name}"] = share.orderBy(F.asc(f"`{flag}`"), F.desc("percentage"), F.asc(f"`{c}`"))
    for c in count_of:
        out[f"counts_{c.lower().replace(' ', '_')}"] = by_count(rolled(flag, c), [flag, c])
    return out


def tag_table(raw: DataFrame, flags: Mapping[str, str] | None = None,
              measures: Sequence[str] = tuple(presets.SONG_MEASURES), truthy: object = 1) -> DataFrame:
    """Complete rows of tags and measures, each tag turned into a 0/1 flag
    and the source tag columns dropped (the study's table partitioned by
    study and party flags)."""
    fl = dict(flags) if flags is not None else dict(presets.USE_CASE_FLAGS)
    rows = clean.project_complete(raw, [F.col(f"`{c}`") for c in (*fl, *measures)])
    return derive.with_flags(rows, fl, truthy=truthy, drop_sources=True)


def tag_comparison(table: DataFrame, segment_flags: Mapping[str, Sequence[str]] | None = None,
                   measures: Mapping[str, str | Column] | None = None, label: str = "tagged_as",
                   count_name: str | None = None, truthy: object = 1) -> DataFrame:
    """Profile of each tag segment (a segment = all its flags equal ``truthy``).

    Segments may overlap; all are computed in one pass over ``table``.
    """
    segs = segment_flags if segment_flags is not None else presets.TAG_SEGMENTS
    ms = measures if measures is not None else presets.SONG_MEASURES_BY_ALIAS
    conds = {name: segments.all_of(*fl, value=truthy) for name, fl in segs.items()}
    return segments.segment_profile(table, conds, ms, label=label, count_name=count_name)
