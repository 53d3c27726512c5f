"""Quality rules on repetition, from a suffix array over words.

Texts are handled in batches: the words of a batch are numbered, and prefix
doubling sorts the suffixes of all its texts at once, the text's number being
part of the first key, so that no match crosses texts. A round sorts only the
suffixes that are not alone yet. The ranks of every round give the longest
common prefix of neighbours in the array; the larger of a suffix's two is the
length of the longest substring that starts there and occurs again, so the
spans [start, start + length) of at least ``min_words`` words are the union of
the maximal repeated substrings.

A text fails when such spans cover too large a part of it, or when one
repeated substring is too long.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetspark.llm.common import col, small_batches, with_columns

SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
_TAIL = bytes(range(0x80, 0xC0))  # UTF-8 bytes that do not begin a code point
BATCH_WORDS = 300_000

MIN_WORDS = 20
MAX_REPEAT_PCT = 30
WINDOW = 8
LONGEST_WORDS = 50
LONGEST_PCT = 20


def repeat_lengths(ids: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For every position the length of the longest substring that starts
    there and also starts at another position of the same text.

    ``ids``: words as numbers from 0; ``text``: the text of each, ascending.
    """
    n = len(ids)
    longest = np.zeros(n, dtype=np.int64)
    if n < 2:
        return longest
    end = np.searchsorted(text, text, side="right")
    # rank: place in the array of the first suffix with the same 2^k first words.
    # A suffix that ends sooner sorts first and shares its rank with none.
    key = text.astype(np.int64) * (int(ids.max()) + 1) + ids
    live = np.argsort(key, kind="stable")
    place = np.arange(n)
    rank = np.full(n + 1, -1, dtype=np.int64)
    rank[live] = np.maximum.accumulate(np.where(np.diff(key[live], prepend=-1) != 0, place, 0))
    ranks, step = [rank], 1
    while True:
        tied = np.concatenate(([False], np.diff(rank[live]) == 0, [False]))
        live = live[tied[1:] | tied[:-1]]
        if not len(live):
            break
        ahead = live + step
        follow = np.where(ahead < end[live], rank[np.minimum(ahead, n)] + 1, 0)
        sort = np.argsort(rank[live] * (n + 1) + follow, kind="stable")
        live, follow = live[sort], follow[sort]
        old, place = rank[live], np.arange(len(live))
        group = np.diff(old, prepend=-1) != 0
        part = group | (np.diff(follow, prepend=-1) != 0)
        rank = rank.copy()
        rank[live] = old + (np.maximum.accumulate(np.where(part, place, 0))
                            - np.maximum.accumulate(np.where(group, place, 0)))
        ranks.append(rank)
        step *= 2
    array = np.empty(n, dtype=np.int64)
    array[rank[:n]] = np.arange(n)
    a, b = array[:-1], array[1:]
    near = np.flatnonzero(ranks[0][a] == ranks[0][b])
    i, j, lcp = a[near], b[near], np.zeros(len(near), dtype=np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        step = np.where(ranks[k][i] == ranks[k][j], 1 << k, 0)
        i, j, lcp = i + step, j + step, lcp + step
    longest[a[near]] = lcp
    np.maximum.at(longest, b[near], lcp)
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Whether each position lies in a repeated substring of ``least`` words."""
    n = len(longest)
    reach = np.where(longest >= least, np.arange(n) + longest, 0)
    return np.maximum.accumulate(reach) > np.arange(n) if n else np.zeros(0, dtype=bool)


def _batches(texts: list[bytes]):
    """(first text, word lists) of consecutive texts, about BATCH_WORDS words each."""
    first, held, n = 0, [], 0
    for i, t in enumerate(texts):
        words = t.split()  # bytes: ASCII white space only
        held.append(words)
        n += len(words)
        if n >= BATCH_WORDS or i == len(texts) - 1:
            yield first, held
            first, held, n = i + 1, [], 0


def repetition(texts: list[bytes], window: int = WINDOW) -> pd.DataFrame:
    """n_words, n_repeat_words (in repeats of ``window`` words or more) and
    longest_repeat (words) of every text."""
    out = np.zeros((len(texts), 3), dtype=np.int64)
    for first, lists in _batches(texts):
        size = np.array([len(w) for w in lists])
        number: defaultdict[bytes, int] = defaultdict(count().__next__)
        ids = np.fromiter((number[w] for words in lists for w in words), np.int64, int(size.sum()))
        text = np.repeat(np.arange(len(lists)), size)
        longest = repeat_lengths(ids, text)
        part = slice(first, first + len(lists))
        out[part, 0] = size
        out[part, 1] = np.bincount(text[covered(longest, window)], minlength=len(lists))
        np.maximum.at(out[part, 2], text, longest)
    return pd.DataFrame(out, columns=["n_words", "n_repeat_words", "longest_repeat"])


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def quality_rules(df: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS,
                  max_repeat_pct: int = MAX_REPEAT_PCT, window: int = WINDOW,
                  longest_words: int = LONGEST_WORDS, longest_pct: int = LONGEST_PCT) -> DataFrame:
    """Adds the counts, base_failed and kept to every row.

    base_failed: fewer than ``min_words`` words, or more than
    ``max_repeat_pct`` % of them in repeats of ``window`` words. kept: not
    base_failed, and the longest repeated substring is at most
    ``longest_words`` words or ``longest_pct`` % of the text. A null text has
    no words. Rows are judged one by one, so repeated rows get equal results;
    input columns named like a result give way to it.
    """
    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                  "longest_repeat long")
    def counts(texts: pd.Series) -> pd.DataFrame:
        data = [t or b"" for t in texts]
        r = repetition(data, window)
        return pd.DataFrame({
            "n_words": r["n_words"],
            "word_chars": [len(t.translate(None, _SPACE + _TAIL)) for t in data],
            "n_symbols": [len(t) - len(t.translate(None, SYMBOLS)) for t in data],
            "n_dup_lines": [repeated_lines(t) for t in data],
            "n_repeat_words": r["n_repeat_words"], "longest_repeat": r["longest_repeat"]})

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat"]
    df = with_columns(small_batches(df), {"__c": counts(col(text_col).cast("binary"))})
    c = {n: F.col(f"__c.{n}") for n in names}
    failed = (c["n_words"] < min_words) | (100 * c["n_repeat_words"] > max_repeat_pct * c["n_words"])
    kept = ~failed & ((c["longest_repeat"] <= longest_words)
                      | (100 * c["longest_repeat"] <= longest_pct * c["n_words"]))
    return with_columns(df, {**c, "base_failed": failed, "kept": kept}).drop("__c")
