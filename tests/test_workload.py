"""The song jobs against the same studies with nothing shared: every result
file must hold the same rows."""

import os
import sys

import pytest

from facetspark.sources import read_csv

from .conftest import SF001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import song_workload as sw  # noqa: E402


@pytest.fixture(scope="module")
def both(spark):
    from facetspark.session import scratch_dir

    csv_path = sw.export_csv(spark, SF001)
    ours, shape = scratch_dir(spark, "ours"), scratch_dir(spark, "shape")
    sw.run_ours(spark, csv_path, ours)
    sw.run_unshared(spark, csv_path, shape)
    return csv_path, ours, shape


@pytest.mark.parametrize("ours_rel,shape_rel,kind", sw.PAIRS)
def test_same_results_as_unshared(spark, both, ours_rel, shape_rel, kind):
    _, ours, shape = both
    a, b = sw.read_result(spark, ours, ours_rel, kind), sw.read_result(spark, shape, shape_rel, kind)
    lower_b = {c.lower(): c for c in b.columns}
    common = [c for c in a.columns if c.lower() in lower_b]
    assert len(common) >= 2, (a.columns, b.columns)
    assert a.count() == b.count() > 0
    other = b.select(*[lower_b[c.lower()] for c in common]).toDF(*common)
    assert sw.result_rows(a, common) == sw.result_rows(other, common)


def test_same_results_helper_agrees(spark, both):
    _, ours, shape = both
    assert all(sw.same_results(spark, ours, shape).values())


def test_export_has_the_awkward_cases(spark, both):
    csv_path, _, _ = both
    raw = read_csv(spark, csv_path)
    titles = [r.song for r in raw.where("song LIKE '%live%'").select("song").limit(3).collect()]
    assert titles and all('"live"\n' in t for t in titles)
    assert raw.where("`Loudness (db)` LIKE '% dB'").count() > 0
    assert raw.where("`Release Date` = '29th April 2013'").count() > 0
    assert raw.where("`Release Date` IS NULL").count() > 0
    assert {r.emotion for r in raw.select("emotion").distinct().collect()} >= {"joy", "Joy"}
