"""Language identification with error-correcting output codes.

Every language gets a codeword of bits; one binary classifier per bit tells,
from byte n-grams, whether the language's codeword has a 1 there. Decoding
picks the codeword of least loss, each bit's loss weighted by how well that
bit's classifier did on the training rows; a text whose two best codewords
lie close together is flagged as ambiguous.

Each classifier is a linear one over hashed n-grams: the log ratio of the
n-gram's share in the texts of its two halves of the languages. The counts
behind it come from a sample of at most ``train_rows`` labelled rows for each
language, chosen by a hash of the id; they are combined map-side, and one row
per language and n-gram slot reaches the driver.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetspark.llm.common import col, small_batches, with_columns

SLOTS = 1 << 15
ORDERS = (1, 2, 3, 4)
TRAIN_ROWS = 4000
MAX_LANGUAGES = 1000
LETTER = re.compile(r"[^\W\d_]")
# bytes that are no letter in ASCII become a space
_PLAIN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def codewords(n: int, seed: int = 42) -> np.ndarray:
    """n codewords of +1 / -1: all distinct two-way splits of up to 7
    languages, beyond that random ones of the best least distance in 64 tries."""
    if n <= 1:
        return np.ones((n, 1), dtype=np.int8)
    if n <= 7:
        splits = np.arange(1, 1 << (n - 1))
        return (1 - 2 * (splits >> np.arange(n)[:, None] & 1)).astype(np.int8)
    rng, best, width = np.random.default_rng(seed), None, int(np.ceil(15 * np.log2(n)))
    for _ in range(64):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), (n, width))
        code = code[:, np.abs(code.sum(axis=0)) < n]  # a constant bit tells nothing
        near = (code.astype(int) @ code.T - 2 * code.shape[1] * np.eye(n, dtype=int)).max() - code.shape[1]
        if best is None or near < best[0]:
            best = near, code
    return best[1]


def grams(text: str) -> np.ndarray:
    """Hashed n-gram slots of the whole text, words set off by one space."""
    data = text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN)
    b = np.frombuffer(b" " + b" ".join(data.split()) + b" ", dtype=np.uint8).astype(np.uint32)
    found, code = [], np.zeros(len(b), dtype=np.uint32)
    for n in range(1, max(ORDERS) + 1):
        if len(b) < n:
            break
        code = (code[:len(b) - n + 1] << np.uint32(8)) | b[n - 1:]
        if n in ORDERS:
            found.append(((code + np.uint32(n)) * np.uint32(2654435769)) >> np.uint32(32 - 15))
    return np.concatenate(found)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # language x bit
    weight: np.ndarray  # n-gram slot x bit
    trust: np.ndarray  # bit
    scale: float

    def margins(self, text: str) -> np.ndarray:
        g = grams(text)
        total = np.zeros(self.weight.shape[1])
        for i in range(0, len(g), 1 << 18):
            total += self.weight[g[i:i + (1 << 18)]].sum(axis=0, dtype=np.float64)
        return total / np.sqrt(len(g))

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language's index, its score in 0..1 and its lead over the next."""
        z = self.scale * margins[:, None, :] * self.code[None]
        loss = (np.logaddexp(0, -np.clip(z, -40, 40)) * self.trust).sum(axis=2)
        order = np.argsort(loss, axis=1, kind="stable")
        best = order[:, 0]
        like = np.exp(loss.min(axis=1, keepdims=True) - loss)
        share = np.sort(like / like.sum(axis=1, keepdims=True), axis=1)[:, ::-1]
        return best, share[:, 0], share[:, 0] - (share[:, 1] if share.shape[1] > 1 else 0)


def train(df: DataFrame, text_col: str, lang_col: str, pick: Column, train_rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on rows with a language, at most about ``train_rows`` of each, in
    order of the hash ``pick`` (0..2^32-1); None if there is no such row. Rows
    of one ``pick`` are learned from together or not at all, so it should tell
    rows apart. More than ``MAX_LANGUAGES`` languages are an error."""
    rows = small_batches(df).select(col(text_col).alias("text"), col(lang_col).alias("lang"), pick.alias("pick")).where(
        "lang is not null and text is not null")
    per = sorted((r[0], r[1]) for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect())  # one row per language
    if len(per) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in {lang_col}")
    if not per:
        return None
    langs = [x for x, _ in per]
    index = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
    below = F.create_map(*[F.lit(x) for lang, n in per for x in (lang, int(min(1.0, train_rows / n) * 2**32))])
    rows = rows.where(F.col("pick") < below[F.col("lang")]).select("text", index[F.col("lang")].alias("y"))
    n_lang = len(langs)

    def count(batches):
        sums = np.zeros((n_lang, SLOTS))
        for pdf in batches:
            for text, y in zip(pdf["text"], pdf["y"]):
                n = np.bincount(grams(text), minlength=SLOTS)
                sums[y] += np.sqrt(n)  # long and repetitive texts count less
        y, slot = np.nonzero(sums)
        yield pd.DataFrame({"y": y, "slot": slot, "n": sums[y, slot]})

    got = rows.mapInPandas(count, "y long, slot long, n double").groupBy("y", "slot").agg(
        F.sum("n").alias("n")).toPandas()  # languages x SLOTS rows at most
    counts = np.zeros((n_lang, SLOTS))
    counts[got["y"], got["slot"]] = got["n"]
    share = (counts + 0.1) / (counts + 0.1).sum(axis=1, keepdims=True)
    code = codewords(n_lang)
    weight = np.zeros((SLOTS, code.shape[1]), dtype=np.float32)
    for b in range(code.shape[1]):
        one, two = share[code[:, b] > 0], share[code[:, b] < 0]
        if len(one) and len(two):
            weight[:, b] = np.log(one.mean(axis=0)) - np.log(two.mean(axis=0))
    model = Model(langs, code, weight, np.ones(code.shape[1]), 1.0)

    def score(batches):
        for pdf in batches:
            m = np.array([model.margins(t) for t in pdf["text"]]).reshape(len(pdf), -1)
            right = m * model.code[pdf["y"].to_numpy()]
            yield pd.DataFrame({"bit": np.tile(np.arange(m.shape[1]), len(m)), "right": (right > 0).ravel() * 1.0})

    fit = rows.mapInPandas(score, "bit long, right double").groupBy("bit").agg(
        F.avg("right").alias("p")).toPandas().sort_values("bit")
    p = np.clip(fit["p"].to_numpy(), 0.5, 0.9999)
    model.trust = np.log(p / (1 - p)) / np.log(p / (1 - p)).sum() if (p > 0.5).any() else np.ones(len(p)) / len(p)
    return model


def identify(df: DataFrame, model: Model | None, text_col: str = "text", least_lead: float = 0.1) -> DataFrame:
    """Adds lang_pred, score and ambiguous to every row.

    Only the text is looked at. A text that is null or has no letter, and any
    text when nothing was learned, gets ``und``, score 0. Columns of these
    names in the input give way to the results.
    """
    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def found(texts: pd.Series) -> pd.DataFrame:
        known = np.array([model is not None and t is not None and bool(LETTER.search(t)) for t in texts], dtype=bool)
        out = pd.DataFrame({"lang_pred": "und", "score": 0.0, "ambiguous": False}, index=texts.index)
        if known.any():
            best, score, lead = model.decode(np.array([model.margins(t) for t in texts[known]]))
            out.loc[known, "lang_pred"] = np.array(model.languages, dtype=object)[best]
            out.loc[known, "score"] = score
            out.loc[known, "ambiguous"] = lead < least_lead
        return out

    kept = with_columns(small_batches(df), {"__found": found(col(text_col))})
    return with_columns(kept, {n: F.col(f"__found.{n}") for n in ("lang_pred", "score", "ambiguous")}).drop("__found")
