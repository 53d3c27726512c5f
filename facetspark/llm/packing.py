"""Packing of documents into training sequences, in order, by dynamic programming.

The ids of the documents of an input partition, each with its end id, form one
stream. It is cut into windows of at most ``window`` ids. A window is padded to
``window``, unless its length is a power of two. Cuts may lie at document ends
(free), at sentence ends (``SENTENCE_COST``) and, where a stretch has neither,
every ``LEAST_GAP`` ids (``BREAK_COST``). The least sum f of padding and cut
costs up to a candidate cut j at place p[j] is

    f[j] = cost[j] + min(  min over p[j] - p[i] <= window   of  f[i] + window - (p[j] - p[i]),
                           min over p[j] - p[i] = 2^k       of  f[i]  )

The first minimum is that of f[i] + p[i] over a window that only moves on, so
a monotone queue gives it in constant time on average; the second looks at one
place for each power of two.

A stream is worked off in stretches of whole documents. A stretch ends at the
cheapest cut among its last ``window`` ids; the ids behind it go on with the
next stretch, so only the last sequence of an input partition is padded for
want of documents. Nothing is shuffled: memory is one stretch and one document.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetspark.llm.bpe import read_spec, slices
from facetspark.llm.common import col, small_batches, worker_state
from facetspark.llm.pieces import Library, byte_letters

WINDOW = 4096
END_ID = 2
SENTENCE_COST, BREAK_COST, LEAST_GAP = 4, 12, 64
STRETCH = 1 << 18
MARKS = ".!?…。！？"


def sentence_ends(spec: str, marks: str = MARKS) -> np.ndarray:
    """Per id, whether it is a whole word of sentence marks."""
    model = json.loads(spec)["model"]
    byte = {letter: i for i, letter in enumerate(byte_letters())}
    end = model.get("end_of_word_suffix") or ""
    table = np.zeros(max(model["vocab"].values()) + 1, dtype=bool)
    for token, i in model["vocab"].items():
        word = token[:len(token) - len(end)] if token.endswith(end) else ""
        if word and all(c in byte for c in word):
            text = bytes(byte[c] for c in word).decode("utf-8", "replace")
            table[i] = set(text) <= set(marks)
    return table


def candidates(doc_ends: np.ndarray, sentences: np.ndarray, gap: int = LEAST_GAP, sentence_cost: int = SENTENCE_COST,
               break_cost: int = BREAK_COST) -> tuple[np.ndarray, np.ndarray]:
    """Places of possible cuts, ascending from 0, and their costs. The last
    document end is the end of the stream."""
    natural = np.union1d(np.append(doc_ends, 0), sentences)
    room = np.diff(natural)
    wide = np.flatnonzero(room > gap)
    n = (room[wide] - 1) // gap
    breaks = np.repeat(natural[wide], n) + gap * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + 1)
    at = np.concatenate((natural, breaks))
    cost = np.concatenate((np.where(np.isin(natural, doc_ends), 0, sentence_cost), np.full(len(breaks), break_cost)))
    order = np.argsort(at, kind="stable")
    return at[order], cost[order]


def cheapest(at: np.ndarray, cost: np.ndarray, window: int) -> tuple[list[int], list[int]]:
    """f and the cut before, for every candidate cut; neighbours are at most
    ``window`` apart."""
    place = np.full(int(at[-1]) + 1, -1, dtype=np.int64)
    place[at] = np.arange(len(at))
    ends, starts, size = [], [], 1  # cuts a power of two apart
    while size <= window:
        first = np.searchsorted(at, size)
        i = place[at[first:] - size]
        ends.append(first + np.flatnonzero(i >= 0))
        starts.append(i[i >= 0])
        size *= 2
    ends, starts = np.concatenate(ends), np.concatenate(starts)
    order = np.argsort(ends, kind="stable")
    upto = np.searchsorted(ends[order], np.arange(len(at)), side="right").tolist()
    starts = starts[order].tolist()
    p, c = at.tolist(), cost.tolist()
    f, back = [0] * len(p), [0] * len(p)
    keys, queue, head = [0], [0], 0  # f + place, ascending from head on, and the candidates
    for j in range(1, len(p)):
        here = p[j]
        while p[queue[head]] < here - window:
            head += 1
        best = queue[head]
        least = keys[head] + window - here
        for i in starts[upto[j - 1]:upto[j]]:
            if f[i] < least:
                least, best = f[i], i
        f[j] = least = least + c[j]
        back[j] = best
        key = least + here
        while len(keys) > head and keys[-1] > key:
            keys.pop()
            queue.pop()
        keys.append(key)
        queue.append(j)
    return f, back


def choose_cuts(at: np.ndarray, cost: np.ndarray, window: int, last: bool) -> np.ndarray:
    """Places of the cuts chosen, from 0 on. ``last``: up to the stream's end,
    else up to the cheapest cut among the last ``window`` ids."""
    f, back = cheapest(at, cost, window)
    j = len(f) - 1
    if not last:
        first = int(np.searchsorted(at, at[-1] - window + 1))
        tail = np.array(f[first:])
        j = first + int(np.flatnonzero(tail == tail.min())[-1])
    cuts = [j]
    while j:
        j = back[j]
        cuts.append(j)
    return at[cuts[::-1]]


class Stream:
    """Packs one stream of documents; ``add`` and ``close`` give record batches
    of pieces."""

    def __init__(self, shard: int, sentences: np.ndarray, id_type: pa.DataType, window: int, gap: int, costs: tuple[int, int]):
        self.sequence, self.sentences, self.id_type = shard << 33, sentences, id_type
        self.window, self.gap, self.costs = window, gap, costs
        self.names: list = []  # of the documents that have ids left
        self.offset = np.zeros(0, dtype=np.int64)  # ids of theirs that are packed
        self.total = np.zeros(0, dtype=np.int64)
        self.parts: list[np.ndarray] = []
        self.held = 0

    def add(self, names: list, ids: np.ndarray, n: np.ndarray):
        """Whole documents of ``n`` ids each, end ids included."""
        self.names += names
        self.offset = np.concatenate((self.offset, np.zeros(len(n), dtype=np.int64)))
        self.total = np.concatenate((self.total, n))
        self.parts.append(ids)
        self.held += len(ids)
        if self.held >= STRETCH:
            yield self._pack(False)

    def close(self):
        if self.held:
            yield self._pack(True)

    def _pack(self, last: bool) -> pa.RecordBatch:
        ids = np.concatenate(self.parts)
        ends = np.cumsum(self.total - self.offset)
        known = ids < len(self.sentences)
        marks = np.flatnonzero(known & self.sentences[np.where(known, ids, 0)]) + 1
        at, cost = candidates(ends, marks, self.gap, *self.costs)
        cuts = choose_cuts(at, cost, self.window, last)
        done = int(cuts[-1])
        edges = np.union1d(cuts, ends[ends < done])
        start = edges[:-1]
        doc = np.searchsorted(ends, start, side="right")
        window = np.searchsorted(cuts, start, side="right") - 1
        begin = ends - (self.total - self.offset)
        data = np.ascontiguousarray(ids[:done], dtype="<u4")
        batch = pa.RecordBatch.from_pydict({
            "id": pa.array([self.names[d] for d in doc.tolist()], self.id_type),
            "start": pa.array(start - begin[doc] + self.offset[doc]),
            "data": pa.Array.from_buffers(pa.binary(), len(start), [
                None, pa.py_buffer((4 * edges).astype("<i4")), pa.py_buffer(data)]),
            "doc_tokens": pa.array(self.total[doc]),
            "sequence_id": pa.array(self.sequence + window),
            "offset": pa.array(start - cuts[window])})
        left = int(np.searchsorted(ends, done, side="right"))
        self.sequence += len(cuts) - 1
        self.offset = self.offset[left:] + np.maximum(0, done - begin[left:])
        self.total, self.names = self.total[left:], self.names[left:]
        self.parts, self.held = [ids[done:]], len(ids) - done
        return batch


def pack_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   end_id: int = END_ID, gap: int = LEAST_GAP, sentence_cost: int = SENTENCE_COST,
                   break_cost: int = BREAK_COST) -> DataFrame:
    """(id, start, data, doc_tokens, sequence_id, offset): the pieces of all
    documents. ``data`` holds a piece's ids as 32-bit little-endian numbers,
    ``start`` its document's ids before it, ``doc_tokens`` all of the
    document's ids with the end id, ``offset`` its place in the sequence.

    Documents follow each other as the table's partitions hold them; sequences
    do not go beyond an input partition. A null text is empty and still has its
    end id; rows with null or repeated ids are documents of their own; other
    columns are not read. An empty table gives no piece. A document must fit a
    task; it may be longer than any window.
    """
    if window < 1 or not 1 <= gap <= window:
        raise ValueError("windows hold at least one id, and breaks lie within a window")
    spec = read_spec(path)
    id_type = df.select(col(id_col)).schema[0].dataType
    rows = small_batches(df).select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"),
                                    F.spark_partition_id().alias("shard"))

    def run(batches):
        words = worker_state(("library", hash(spec)), lambda: Library(spec))
        sentences = worker_state(("sentences", hash(spec)), lambda: sentence_ends(spec))
        stream = None
        for batch in batches:
            for part in slices(batch, "text"):
                if not part.num_rows:
                    continue
                if stream is None:
                    stream = Stream(part.column(2)[0].as_py(), sentences, batch.schema.field("id").type, window, gap,
                                    (sentence_cost, break_cost))
                ids, n = words.encode_words(part.column(1).to_pylist())
                yield from stream.add(part.column(0).to_pylist(), np.insert(ids, np.cumsum(n), end_id), n + 1)
        if stream is not None:
            yield from stream.close()

    out = rows.mapInArrow(run, f"id {id_type.simpleString()}, start long, data binary, doc_tokens long, "
                               "sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col) if id_col != "id" else out
