"""Fixed values of the song study.

FIXED VALUES — these must equal the original study's settings for its
results to come out the same. They are stated here once, in their
natural order, and every preset-based operator reads them from here.
"""

from __future__ import annotations

# The measure that some exports write with a unit.
LOUDNESS = "Loudness (db)"

# FIXED VALUES: popularity buckets, 4 labels. A score below the bound gets
# the label; anything at or above the last bound gets the final label.
# The last label is "75-100" although it holds 76 and up (kept as is).
POPULARITY_BOUNDS_4 = (26, 51, 76)
POPULARITY_LABELS_4 = ("0-25", "26-50", "51-75", "75-100")

# FIXED VALUES: popularity buckets, 10 labels.
POPULARITY_BOUNDS_10 = (11, 21, 31, 41, 51, 61, 71, 81, 91)
POPULARITY_LABELS_10 = (
    "0-10", "11-20", "21-30", "31-40", "41-50",
    "51-60", "61-70", "71-80", "81-90", "91-100",
)

# FIXED VALUES: the nine song measures, with the names of their averages.
SONG_MEASURES = {
    "Tempo": "avg_tempo",
    "Loudness (db)": "avg_loudness",
    "Energy": "avg_energy",
    "Positiveness": "avg_positiveness",
    "Speechiness": "avg_speechiness",
    "Instrumentalness": "avg_instrumentalness",
    "Danceability": "avg_danceability",
    "Acousticness": "avg_acousticness",
    "Popularity": "avg_popularity",
}

# FIXED VALUES: use-case tag columns of the source and their 0/1 flag names.
USE_CASE_FLAGS = {
    "Good for Work/Study": "good_for_study",
    "Good for Party": "good_for_party",
    "Good for Relaxation/Meditation": "good_for_relaxation_meditation",
    "Good for Yoga/Stretching": "good_for_yoga_stretching",
    "Good for Exercise": "good_for_exercise",
    "Good for Running": "good_for_running",
}

# FIXED VALUES: segment labels of the tag comparison and the flags that must
# all be 1 for a song to belong to the segment (segments may overlap).
TAG_SEGMENTS = {
    "good for study": ("good_for_study",),
    "good for calm": ("good_for_study", "good_for_relaxation_meditation", "good_for_yoga_stretching"),
    "good for activities": ("good_for_party", "good_for_running", "good_for_exercise"),
    "good for party": ("good_for_party",),
}

# The segment that has a result file of its own.
STUDY_SEGMENT = "good for study"

# FIXED VALUES: minimum number of songs for an emotion to be reported (inclusive).
MIN_SONGS_PER_EMOTION = 20

# FIXED VALUES: decade scaling of the tempo average in the decade study.
DECADE_TEMPO_SCALE = 100

# FIXED VALUES: source column names used by the studies.
RELEASE_DATE = "Release Date"
EMOTION = "emotion"
TIME_SIGNATURE = "Time signature"
KEY = "Key"

# The same nine measures as {average name: source column}, the form the
# profile operators take.
SONG_MEASURES_BY_ALIAS = {alias: source for source, alias in SONG_MEASURES.items()}
