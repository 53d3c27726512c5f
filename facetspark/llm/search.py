"""Ranked lexical search, reversed: the documents pass by an index of the queries.

The terms of the items (the queries) form an inverted index that is sent to
the tasks. One pass over the texts leaves, for each document, its number of
terms and the counts of its terms that any item has, as a table of integers;
the corpus figures are sums over that table. A second pass streams it through
the index: every document adds to the scores of the items that share a term
with it, and each item keeps its best ``k`` in a bounded list. The lists of
the tasks, at most ``k`` rows an item each, are merged in two steps.

Items are taken in blocks of about ``BLOCK_BYTES`` of text, so an index has a
bounded size whatever the number of items; each block makes its own passes.
All scores are exact 64-bit integers. No document text is shuffled.
"""

from __future__ import annotations

import math
from bisect import insort
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetspark.llm.bpe import slices
from facetspark.llm.common import LEAN_PARQUET, col, small_batches, stored
from facetspark.llm.pieces import ragged
from facetspark.session import scratch_dir

K = 20
BLOCK_BYTES = 8 << 20
CELLS = 1 << 21  # scores of a chunk of documents
MERGERS = 64
_N, _L = -1, -2  # keys of the corpus figures beside the terms' numbers

# every byte that is part of a term as it is, A-Z lower-cased; all others part terms
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return (text or "").encode("utf-8").translate(_FOLD).split()


class Index:
    """The inverted index of a block of items: for each term the items that
    hold it, and how often."""

    def __init__(self, names: list, texts: list[str | None]):
        self.names = names
        self.number: dict[bytes, int] = {}
        postings: dict[int, list[tuple[int, int]]] = {}
        for item, text in enumerate(texts):
            for term, times in Counter(terms(text)).items():
                postings.setdefault(self.number.setdefault(term, len(self.number)), []).append((item, times))
        size = np.array([len(postings[t]) for t in range(len(self.number))], dtype=np.int64)
        self.start, self.size = np.cumsum(size) - size, size
        flat = np.array([p for t in range(len(self.number)) for p in postings[t]], dtype=np.int64).reshape(-1, 2)
        self.item, self.times = flat[:, 0].copy(), flat[:, 1].copy()


def term_counts(docs: DataFrame, sent, id_col: str, text_col: str) -> DataFrame:
    """(id, n, term, tf) of every document: all its terms' number, and the
    numbers and counts of those in the index."""
    id_type = docs.select(col(id_col)).schema[0].dataType
    rows = small_batches(docs).select(col(id_col).alias("id"), col(text_col).alias("text"))

    def run(batches):
        number = sent.value.number
        for batch in batches:
            for part in slices(batch, "text"):
                n, size, term, tf = [], [], [], []
                for text in part.column(1).to_pylist():
                    words = terms(text)
                    found = Counter(map(number.get, words))
                    found.pop(None, None)
                    n.append(len(words))
                    size.append(len(found))
                    term += found.keys()
                    tf += found.values()
                ends = pa.array(np.cumsum([0, *size]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32()))], names=["id", "n", "term", "tf"])

    schema = T.StructType([T.StructField("id", id_type), T.StructField("n", T.LongType()),
                           T.StructField("term", T.ArrayType(T.IntegerType())), T.StructField("tf", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema)


def corpus_figures(counts: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """N, L and the df of every term of the index. The driver gets one row a term."""
    def run(batches):
        df, n, size = np.zeros(n_terms, dtype=np.int64), 0, 0
        for batch in batches:
            df += np.bincount(batch.column(1).flatten().to_numpy(), minlength=n_terms)
            each = batch.column(0).to_numpy()
            n, size = n + int((each > 0).sum()), size + int(each.sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, [_N, _L])), pa.array(np.append(df[some], [n, size]))],
                                         names=["key", "value"])

    sums = counts.select("n", "term").mapInArrow(run, "key long, value long").groupBy("key").agg(F.sum("value").alias("value"))
    got = dict(map(tuple, sums.collect()))
    return got.get(_N, 0), got.get(_L, 0), np.array([got.get(t, 0) for t in range(n_terms)], dtype=np.int64)


def term_weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Best:
    """The best k (score, id) of every item; equal scores by ascending id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.lists = k, [[] for _ in range(items)]
        self.least = np.ones(items, dtype=np.int64)  # no score below it gets in

    def add(self, ids: list, scores: np.ndarray) -> None:
        """scores: a row a document, a column an item."""
        low = self.least
        if len(scores) > self.k:
            low = np.maximum(low, np.partition(scores, len(scores) - self.k, axis=0)[-self.k])
        doc, item = np.nonzero(scores >= low)
        for d, i, s in zip(doc.tolist(), item.tolist(), scores[doc, item].tolist()):
            mine = self.lists[i]
            entry = (-s, ids[d] is None, ids[d] if ids[d] is not None else 0)
            if len(mine) < self.k:
                insort(mine, entry)
            elif entry < mine[-1]:
                mine.pop()
                insort(mine, entry)
            if len(mine) == self.k:
                self.least[i] = -mine[-1][0]


def best_documents(counts: DataFrame, sent, n: int, size: int, weight: np.ndarray, k: int, item_type: T.DataType) -> DataFrame:
    """(item, item_id, id, score): at most k rows an item from each task."""
    id_type = counts.schema["id"].dataType
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type),
                           T.StructField("id", id_type), T.StructField("score", T.LongType())])

    def run(batches):
        index = sent.value
        items = len(index.names)
        best = Best(items, k)
        per = max(1, CELLS // max(1, items))
        kind = None
        for batch in batches:
            kind = batch.schema.field("id").type
            for part in (batch.slice(i, per) for i in range(0, batch.num_rows, per)):
                length = np.array([75 + 25 * x * n // size if x else 0 for x in part.column(1).to_pylist()], dtype=np.int64)
                doc = np.repeat(np.arange(part.num_rows), part.column(2).value_lengths().to_numpy())
                term = part.column(2).flatten().to_numpy().astype(np.int64)
                tf = part.column(3).flatten().to_numpy().astype(np.int64)
                gain = weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * length[doc]))
                scores = np.zeros(part.num_rows * items, dtype=np.int64)
                # postings are unfolded in runs of about a chunk's cells
                run_of = (np.cumsum(index.size[term]) - 1) // CELLS if len(term) else term
                for r in range(int(run_of[-1]) + 1 if len(term) else 0):
                    a, b = np.searchsorted(run_of, [r, r + 1])
                    t, wide = term[a:b], index.size[term[a:b]]
                    places = ragged(np.arange(len(index.item)), index.start[t], wide)
                    np.add.at(scores, np.repeat(doc[a:b] * items, wide) + index.item[places],
                              np.repeat(gain[a:b], wide) * index.times[places])
                best.add(part.column(0).to_pylist(), scores.reshape(part.num_rows, items))
        if kind is not None:
            rows = [(i, index.names[i], None if null else x, -s) for i, mine in enumerate(best.lists) for s, null, x in mine]
            columns = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], names_type), pa.array(columns[2], kind),
                 pa.array(columns[3], pa.int64())], names=["item", "item_id", "id", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    names_type = to_arrow_type(item_type)
    return counts.mapInArrow(run, schema)


def ranked(rows: DataFrame, k: int) -> DataFrame:
    """The best k rows of every item, numbered; first within groups of tasks."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    rows = rows.withColumn("merger", F.spark_partition_id() % MERGERS)
    some = rows.withColumn("rank", F.row_number().over(Window.partitionBy("item", "merger").orderBy(*order)))
    some = some.where(F.col("rank") <= k).drop("rank", "merger")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_col, rank, id_col, score): each item's k best documents with a
    score above 0, or all of them if there are fewer.

    Every row of ``items`` is a query of its own and every row of ``docs`` a
    document of its own, also if ids repeat or are null; equal scores rank by
    ascending document id, null ids last. A null or empty text has no terms:
    such items give no rows, such documents have no score. Other columns are
    not read. Either table may be empty; the result then has no rows.
    """
    spark = docs.sparkSession
    item_type = items.select(col(item_col)).schema[0].dataType
    queries = items.select(col(item_col).alias("item_id"), col(item_text_col).alias("text"))
    volume = queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-volume // block_bytes))
    if blocks > 1:
        queries = stored(queries)
    results = []
    for block in range(blocks):
        mine = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        asked = mine.where(F.length("text") > 0).collect()  # about block_bytes of text
        index = Index([r[0] for r in asked], [r[1] for r in asked])
        sent = spark.sparkContext.broadcast(index)
        to = scratch_dir(spark, "terms")
        term_counts(docs, sent, id_col, text_col).write.options(**LEAN_PARQUET).parquet(to)
        counts = spark.read.parquet(to)
        n, size, df = corpus_figures(counts, len(index.number))
        weight = np.array([term_weight(n, int(x)) for x in df], dtype=np.int64)
        results.append(ranked(best_documents(counts, sent, n, size, weight, k, item_type), k))
    found = reduce(DataFrame.unionByName, results)
    return found.select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")
