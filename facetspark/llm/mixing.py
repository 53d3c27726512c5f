"""Mixing sources to target weights.

Words of a source, document after document, are packed into blocks of fixed
length. The mix is a sequence of output shards of ``shard_slots`` block slots
each. A shard draws how many of its slots each source gets; slot j of a
source, counted over all shards, is mapped through a pseudorandom permutation
of that source's block numbers (a new one for every pass over the source),
and slots are joined with blocks by that number.

The draw of a shard is the whole part of the expected counts plus a
multinomial draw of what is left, so that the drift from the targets stays a
few blocks per shard while shards remain independent tasks.

Sizes are summed in levels (``running_start``), so no task holds a whole
source. The driver sees one row per source, up to ``max_sources``, never per document.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetspark.llm.common import WORD, col, row_key, running_start, stored

CHUNK_ROWS = 512
SLOTS_PER_TASK = 1 << 18
MAX_SOURCES = 100_000


def targets(sizes: list[tuple[str | None, int]], weights: list[float], share: float,
            most: float) -> list[tuple[str | None, int, float]]:
    """(source, size, target): sources by code point, null last, weights
    repeating; ``share`` of all words, at most ``most`` passes over a source,
    the excess shared again by weight until no target is above."""
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = [float(weights[i % len(weights)]) for i in range(len(order))]
    target = [0.0] * len(order)
    free, left = set(range(len(order))), share * sum(n for _, n in order)
    while free:
        unit = sum(weight[i] for i in sorted(free))
        over = {i for i in free if unit and left * weight[i] / unit > most * order[i][1]}
        for i in free:
            target[i] = left * weight[i] / unit if unit else 0.0
        for i in over:
            target[i] = most * order[i][1]
        if not over:
            break
        left -= sum(target[i] for i in sorted(over))
        free -= over
    return [(s, n, t) for (s, n), t in zip(order, target)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Image of each i in [0, n) under the permutation that ``key`` names: a
    four-round Feistel network on the next even number of bits, walked until
    the value is below n."""
    i, n, key = (np.asarray(x).astype(np.uint64) for x in (i, n, key))
    bits = np.array([max(1, math.ceil((int(x) - 1).bit_length() / 2)) for x in np.unique(n)], dtype=np.uint64)
    half = bits[np.searchsorted(np.unique(n), n)]
    low = (np.uint64(1) << half) - np.uint64(1)
    out = i.copy()
    todo = np.arange(len(i))
    while len(todo):
        x, h, m, k = out[todo], half[todo], low[todo], key[todo]
        a, b = x >> h, x & m
        for r in range(4):
            a, b = b, a ^ (_mixed(b + k * np.uint64(2 * r + 1) + np.uint64(r)) & m)
        out[todo] = (a << h) | b
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def draw_counts(p: np.ndarray, slots: int, seed: int, shard: int) -> np.ndarray:
    """How many of a shard's slots each source gets."""
    want = p * slots
    sure = np.floor(want).astype(np.int64)
    rest = want - sure
    open_ = slots - int(sure.sum())
    if open_ > 0 and rest.sum() > 0:
        sure += np.random.Generator(np.random.Philox(key=[seed, shard])).multinomial(open_, rest / rest.sum())
    return sure


@dataclass
class Mix:
    """documents: __id, __source, __size, __k1, __k2 (row key), __sx, __start,
    __total, __target; columns: those of the table that was mixed;
    slots: shard, sx, epoch, block; pieces: sx, block, __start (of the
    document), __id, from, n (its words in the block)."""

    documents: DataFrame
    slots: DataFrame
    pieces: DataFrame
    columns: list[str]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
        block_words: int = 128, shard_slots: int = 4096, seed: int = 42,
        max_sources: int = MAX_SOURCES) -> Mix:
    """The plan of the mix of all rows of ``df``.

    A null text has no words; a null source is a source of its own, last in
    order. Rows with equal or null ids are packed like any other, in order of
    (id, size, row key). Wordless documents and empty tables give no blocks. ``most``
    is a whole number of passes in which no block repeats within a pass, so no
    document is used more than ``most`` times. More sources than
    ``max_sources`` are an error: a row for each goes to the driver.
    """
    spark = df.sparkSession
    docs = stored(df.select(col(id_col).alias("__id"), col(source_col).alias("__source"),
                            word_count(col(text_col)).alias("__size"), *row_key(df)))
    per = docs.groupBy("__source").agg(F.sum("__size"), F.count(F.lit(1))).limit(max_sources + 1).collect()
    if len(per) > max_sources:
        raise ValueError(f"more than {max_sources} sources; targets are worked out by the driver, one row per source")
    goal = targets([(r[0], r[1]) for r in per], list(weights), share, most)
    rows = sum(r[2] for r in per)
    blocks = [-(-n // block_words) for _, n, _ in goal]
    info = spark.createDataFrame(
        [(i, s, n, t, b) for i, ((s, n, t), b) in enumerate(zip(goal, blocks))],
        f"__sx int, s {dict(docs.dtypes)['__source']}, __total long, __target double, __blocks long")
    docs = docs.join(F.broadcast(info), docs["__source"].eqNullSafe(info["s"])).drop("s", "__blocks")
    chunks = max(1, rows // CHUNK_ROWS)
    # rows without an id are dealt by their content, or those of one size would be one chunk
    deal = F.when(F.col("__id").isNull(), F.col("__k1")).otherwise(F.xxhash64("__id", "__size"))
    docs = stored(running_start(docs, ["__sx"], F.pmod(deal, F.lit(chunks)),
                                [F.col(c) for c in ("__id", "__size", "__k1", "__k2")], "__size", "__start", levels=3))

    # slots each source should get: passes over it times its blocks
    want = np.array([t / n * b if n else 0.0 for (_, n, t), b in zip(goal, blocks)])
    total = round(want.sum())
    p = want / want.sum() if total else want

    def draws(batches):
        for pdf in batches:
            for shard in pdf["id"]:
                n = draw_counts(p, min(shard_slots, total - shard * shard_slots), seed, int(shard))
                yield pd.DataFrame({"shard": shard, "sx": np.arange(len(n), dtype=np.int32), "n": n})[n > 0]

    shards = spark.range(-(-total // shard_slots)).mapInPandas(draws, "shard long, sx int, n long")
    first = running_start(stored(shards), ["sx"], F.floor(F.col("shard") / 1024), [F.col("shard")], "n", "first")
    # dealt evenly before they unfold: a row becomes up to a shard of slots
    first = first.repartition(max(1, -(-total // SLOTS_PER_TASK)), "shard", "sx")
    slots = first.join(F.broadcast(info.select(F.col("__sx").alias("sx"), "__blocks")), "sx").select(
        "shard", "sx", "__blocks", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("j"))
    slots = slots.where(F.col("j") < most * F.col("__blocks")).withColumn(
        "epoch", F.floor(F.col("j") / F.col("__blocks")))

    @F.pandas_udf("long")
    def image(i: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series(permuted(i.to_numpy(), n.to_numpy(), key.to_numpy().view(np.uint64)))

    slots = slots.select("shard", "sx", "epoch", image(
        F.col("j") - F.col("epoch") * F.col("__blocks"), F.col("__blocks"),
        F.xxhash64(F.lit(seed), "sx", "epoch")).alias("block"))

    end = F.col("__start") + F.col("__size")
    pieces = docs.where("__size > 0").select(
        F.col("__sx").alias("sx"), "__start", "__id", "__size",
        F.explode(F.sequence(F.floor(F.col("__start") / block_words),
                             F.floor((end - 1) / block_words))).alias("block"))
    begin = F.greatest(F.col("block") * block_words, F.col("__start"))
    stop = F.least((F.col("block") + 1) * block_words, F.col("__start") + F.col("__size"))
    pieces = pieces.select("sx", "block", "__start", "__id", (begin - F.col("__start")).alias("from"),
                           (stop - begin).alias("n"))
    return Mix(docs, slots, pieces, df.columns)


def taken(plan: Mix) -> DataFrame:
    """One row per document: __id, __source, __size, __total, __target, taken."""
    times = plan.slots.groupBy("sx", "block").agg(F.count(F.lit(1)).alias("times"))
    used = plan.pieces.join(times, ["sx", "block"]).groupBy("sx", "__start").agg(
        F.sum(F.col("n") * F.col("times")).alias("taken"))
    d, u = plan.documents, used.withColumnRenamed("__start", "s")
    out = d.join(u, (d["__sx"] == u["sx"]) & (d["__start"] == u["s"]) & (d["__size"] > 0), "left")
    return out.select("__id", "__source", "__size", "__total", "__target",
                      F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(df: DataFrame, plan: Mix, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with each text cut to the words that a pass of the mix takes, in
    their order, one row per document and pass (column ``__epoch``); documents
    of which nothing is taken go. Words are joined by one space. ``df`` is the
    table that was mixed; its rows are known by their whole content, so ids may
    be null or repeated, and each of several equal rows has its own words.
    """
    if df.columns != plan.columns:
        raise ValueError(f"the mixed table has columns {plan.columns}, this one {df.columns}")
    use = plan.slots.join(plan.pieces, ["sx", "block"])
    d = plan.documents.select(F.col("__sx").alias("sx"), "__start", "__size", "__k1", "__k2")
    use = use.join(d.where("__size > 0"), ["sx", "__start"]).groupBy(
        "sx", "__start", "__k1", "__k2", F.col("epoch").alias("__epoch")).agg(
        F.sort_array(F.collect_list(F.struct("from", "n"))).alias("__use"))
    docs = df.select("*", *row_key(df)).dropDuplicates(["__k1", "__k2"])
    split = F.split(F.regexp_replace(col(text_col), r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    # the outer transform holds the words once; inside the inner one alone they would be split for every piece
    text = F.get(F.transform(F.array(split), lambda words: F.array_join(F.flatten(F.transform(
        "__use", lambda u: F.slice(words, (u["from"] + 1).cast("int"), u["n"].cast("int")))), " ")), 0)
    out = docs.join(use, ["__k1", "__k2"])
    return out.select(*[text.alias(c) if c == text_col else col(c) for c in df.columns], "__epoch")


def mixed_blocks(df: DataFrame, plan: Mix, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mix itself: shard, place (random order key within the shard), sx,
    epoch, block and its words. Ids must be unique."""
    pieces = plan.pieces.join(df.select(col(id_col).alias("__id"), col(text_col).alias("__text")), "__id")
    words = F.split(F.regexp_replace("__text", r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    packed = pieces.select("sx", "block", "__start", F.slice(
        words, (F.col("from") + 1).cast("int"), F.col("n").cast("int")).alias("w")).groupBy("sx", "block").agg(
        F.sort_array(F.collect_list(F.struct("__start", "w"))).alias("w"))
    packed = packed.select("sx", "block", F.flatten(F.col("w.w")).alias("words"))
    return plan.slots.join(packed, ["sx", "block"]).select(
        "shard", F.xxhash64("shard", "sx", "epoch", "block").alias("place"), "sx", "epoch", "block", "words")
