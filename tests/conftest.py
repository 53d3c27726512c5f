from __future__ import annotations

import csv
import os
import random
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from facetspark.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

SONG_HEADER = [
    "Artist(s)", "song", "emotion", "Release Date", "Key", "Time signature",
    "Tempo", "Loudness (db)", "Energy", "Positiveness", "Speechiness", "Instrumentalness",
    "Danceability", "Acousticness", "Popularity",
    "Good for Work/Study", "Good for Relaxation/Meditation", "Good for Yoga/Stretching",
    "Good for Party", "Good for Exercise", "Good for Running",
]


def _song_rows() -> list[list[str]]:
    """Deterministic song export with the awkward cases of the real one."""
    rng = random.Random(7)
    rows = []
    # emotion sizes: 21 / 20 / 19 rows (support threshold 20 is inclusive), one-row group
    plan = [("joy", 14), ("Joy", 7), ("sadness", 20), ("anger", 19), ("love", 1), ("fear", 40)]
    edges = [0, 10, 11, 25, 26, 50, 51, 75, 76, 90, 91, 100]
    dates = ["2003-05-01", "2013", "29th April 2013", "", "1999-12-31", "1987-06-15", "2020-01-01"]
    i = 0
    for emotion, n in plan:
        for _ in range(n):
            pop = edges[i % len(edges)] if i < 48 else rng.randint(0, 100)
            flags = [rng.random() < p for p in (0.3, 0.4, 0.35, 0.45, 0.4, 0.4)]
            rows.append([
                f"Artist {i % 13}", f"Song {i}", emotion, dates[i % len(dates)],
                rng.choice(["C Maj", "D min", "E Maj", "A min"]),
                rng.choice(["4/4", "4/4", "4/4", "3/4", "5/4", "1/4"]),
                f"{rng.uniform(60, 200):.3f}",
                f"{rng.uniform(-20, 0):.2f}" + (" dB" if i % 11 == 0 else ""),
                str(rng.randint(0, 100)), str(rng.randint(0, 100)), str(rng.randint(0, 100)),
                str(rng.randint(0, 100)), str(rng.randint(0, 100)), str(rng.randint(0, 100)),
                str(pop),
                *["1" if f else "0" for f in flags],
            ])
            i += 1
    rows[3][1] = 'Line one\nline "two" of the title'
    rows[4][1] = 'He said "hi"'  # the csv module writes the quotes doubled
    rows[5][6] = "NaN"
    # a null in each column in turn
    for j in range(len(SONG_HEADER)):
        rows[20 + j][j] = ""
    # all-equal danceability within "love" (one row) and a zero-variance segment is covered in tests
    return rows


@pytest.fixture(scope="session")
def spark():
    s = local_session("facetspark-tests", cores=4, shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def song_rows():
    return _song_rows()


@pytest.fixture(scope="session")
def songs_csv(song_rows, tmp_path_factory):
    d = tmp_path_factory.mktemp("songs")
    half = len(song_rows) // 2
    for k, chunk in enumerate((song_rows[:half], song_rows[half:])):
        with open(d / f"part-{k}.csv", "w", newline="") as fh:
            w = csv.writer(fh, quoting=csv.QUOTE_MINIMAL, doublequote=True)
            w.writerow(SONG_HEADER)
            w.writerows(chunk)
    return str(d)


@pytest.fixture(scope="session")
def songs(spark, songs_csv):
    from facetspark.plans.studies import read_songs

    return read_songs(spark, songs_csv)


@pytest.fixture(scope="session")
def songs_pd(songs_csv):
    """The same export read by pandas: the brute-force side of the study tests."""
    import glob

    import numpy as np
    import pandas as pd

    frames = [pd.read_csv(p, dtype=str, keep_default_na=False) for p in sorted(glob.glob(f"{songs_csv}/*.csv"))]
    df = pd.concat(frames, ignore_index=True).replace({"": None})
    from facetspark.plans.studies import song_types

    for c, t in song_types().items():
        s = df[c].str.replace(r"(?i)\s*db$", "", regex=True)
        num = pd.to_numeric(s, errors="coerce")
        if t == "int":
            num = num.where(num == np.floor(num))
        df[c] = num
    return df


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="facetspark-test-")
