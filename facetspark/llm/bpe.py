"""BPE encoding and decoding with a tokenization automaton.

The automaton reads tokens: its states are "start" and "the last token was t",
and an arc labelled v leaves state u exactly if a BPE run can put v right
after u. It is built merge by merge. The gadget of merge r, (a, b) -> ab,

* gives ab the arcs that b has at that point (what may follow b may follow ab),
* lets ab follow whatever a may follow at that point, and
* takes the arc b from state a: from now on the pair is always merged.

Of all ways to spell a word, exactly one is a path of the finished automaton,
and it is the BPE encoding; its arc labels, put together, are the decoding.

A full table would have one cell per pair of tokens, so the gadgets are kept
as arrays (halves and rank of every merge) and a cell is filled the first time
a word asks for it, by undoing gadgets from the younger token on until the
merge that decides the cell is found. After that a step is one table lookup.

Encoding walks the table with the longest piece first and steps back from a
dead end, which marks a position as no token border, so a word takes linear
time. Words that a worker has met lie in its bounded table (``pieces``).
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetspark.llm.common import col, small_batches, with_columns, worker_state
from facetspark.llm.pieces import Table, byte_letters, joined, text_counts, words

ARC_CELLS = 300_000
SLICE_BYTES = 4 << 20


class Automaton:
    def __init__(self, ids: dict[str, int], merges: list[tuple[str, str]], word_end: str):
        self.ids, self.word_end = ids, word_end
        size = max(ids.values()) + 1
        self.left, self.right, self.born = [-1] * size, [-1] * size, [-1] * size
        self.joined: dict[int, int] = {}
        self.size = size
        self.arcs: dict[int, bool] = {}
        made = {ids[a + b] for a, b in merges}
        for r, (a, b) in enumerate(merges):
            self._gadget(r, ids[a], ids[b], ids[a + b], made)
        # letters of the tokens as a tree of dicts; a node's token is under "".
        # A token that no run of merges makes is on no path.
        self.end = "\n" if word_end else ""
        self.width: dict[int, int] = {}
        self.root: dict = {}
        for t, i in ids.items():
            if i in made and self.born[i] < 0:
                continue
            if word_end and t.endswith(word_end):
                t = t[:-len(word_end)] + self.end
            self.width[i] = len(t)
            node = self.root
            for letter in t:
                node = node.setdefault(letter, {})
            node[""] = i

    def _gadget(self, r: int, a: int, b: int, ab: int, made: set[int]) -> None:
        if any(x in made and self.born[x] < 0 for x in (a, b)) or not self._undo(a, b):
            return  # earlier merges never leave a and b side by side
        self.joined.setdefault(a * self.size + b, r)
        if self.born[ab] < 0:
            self.left[ab], self.right[ab], self.born[ab] = a, b, r

    def _fill(self, u: int, v: int) -> bool:
        if len(self.arcs) >= ARC_CELLS:
            self.arcs.clear()
        open_ = self.arcs[u * self.size + v] = self._undo(u, v)
        return open_

    def _undo(self, u: int, v: int) -> bool:
        born, before = self.born, 1 << 60
        while True:
            r = self.joined.get(u * self.size + v)
            if r is not None and r < before:
                return False
            if born[u] > born[v]:
                before, u = born[u], self.right[u]
            elif born[v] >= 0:
                before, v = born[v] + 1, self.left[v]  # of equal merges the left one comes first
            else:
                return True

    def _starting(self, text: str, i: int) -> list[int]:
        """Tokens that the text goes on with at i, shortest first."""
        node, found = self.root, []
        for k in range(i, len(text)):
            node = node.get(text[k])
            if node is None:
                break
            if "" in node:
                found.append(node[""])
        return found

    def path(self, word: str) -> list[int]:
        """Token ids of a word written in base letters."""
        text, arcs, size, width = word + self.end, self.arcs, self.size, self.width
        n, i, last = len(text), 0, -1
        dead: set[int] = set()
        path: list[int] = []
        left = [self._starting(text, 0)]
        while True:
            options = left[-1]
            while options:
                t = options.pop()
                j = i + width[t]
                if j in dead:
                    continue
                if last < 0:
                    break
                open_ = arcs.get(last * size + t)
                if open_ if open_ is not None else self._fill(last, t):
                    break
            else:
                if not path:
                    raise ValueError("a letter of the word is not in the vocabulary")
                dead.add(i)
                left.pop()
                i -= width[path.pop()]
                last = path[-1] if path else -1
                continue
            path.append(t)
            if j == n:
                return path
            i, last = j, t
            left.append(self._starting(text, j))


class Encoder:
    """A vocabulary file: added tokens, normalisation, pre-splitting, merges."""

    def __init__(self, spec: str):
        s = json.loads(spec)
        model = s["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.added = {t["content"]: t["id"] for t in s["added_tokens"]}
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        split = next(p for p in s["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.letters = byte_letters()
        self.table = Table(id_type=np.uint16 if self.automaton.size <= 1 << 16 else np.uint32)

    def chunk(self, text: str) -> list[int]:
        """Ids of a text, word by word."""
        found: list[int] = []
        for part in self.split_added.split(text) if any(a in text for a in self.added) else (text,):
            if part in self.added:
                found.append(self.added[part])
                continue
            # letter by letter: no special form of a last sigma
            low = part if part.isascii() else unicodedata.normalize("NFC", part).replace("Σ", "σ")
            for word in self.words.findall(low.lower()):
                found += self.automaton.path("".join([self.letters[b] for b in word.encode("utf-8", "replace")]))
        return found

    def _values(self, spans: list[bytes]) -> list[list[int]]:
        return [self.chunk(s.decode("utf-8")) for s in spans]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has.

        White space separates words and has no ids; a stop or comma that ends
        a word is a word of its own.
        """
        b, at = joined(texts)
        start, end = words(b, at)
        ids, n = self.table.numbers(b, start, end, self._values)
        return ids, text_counts(start, n, at)


def encoder(spec: str) -> Encoder:
    return worker_state(("bpe", hash(spec)), lambda: Encoder(spec))


def arc_labels(spec: str) -> list[str]:
    """The label of every id."""
    s = json.loads(spec)
    ids = {**s["model"]["vocab"], **{t["content"]: t["id"] for t in s["added_tokens"]}}
    labels = [""] * (max(ids.values()) + 1)
    for t, i in ids.items():
        labels[i] = t
    return labels


def read_spec(path: str) -> str:
    """The vocabulary file, read by the driver and sent to the tasks (a few MB)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES):
    """Zero-copy parts of a batch with about ``size`` bytes in ``column``."""
    per = max(1, int(batch.num_rows * size / (batch.column(column).nbytes + 1)))
    for i in range(0, batch.num_rows, per):
        yield batch.slice(i, per)


def _mapped(df: DataFrame, source: str, into: str, kind: T.DataType, make) -> DataFrame:
    """``df`` with column ``into`` made from ``source`` slice by slice; a
    column that is already called ``into`` gives way."""
    base = small_batches(df).select(*[c for c in df.columns if c.lower() != into.lower() or c == source])
    names = [c for c in base.columns if c.lower() != into.lower()]
    schema = T.StructType([*(base.schema[c] for c in names), T.StructField(into, kind)])

    def run(batches):
        for batch in batches:
            for part in slices(batch, source, SLICE_BYTES // 4):
                made = make(part.column(part.schema.get_field_index(source)))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(part.schema.get_field_index(c)) for c in names], made], names=[*names, into])

    return base.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, text_col: str = "text", into: str = "ids") -> DataFrame:
    """Adds the token ids of each whole text (array of int).

    A null or empty text has no ids; strings of added tokens in a text are
    those tokens. Rows are independent, so order, copies and nulls elsewhere
    do not matter.
    """
    spec = read_spec(path)

    def make(texts: pa.Array) -> pa.Array:
        enc = encoder(spec)
        ids, n = enc.encode([t or "" for t in texts.to_pylist()])
        ends = np.cumsum([0, *n], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.view("<i4")))

    return _mapped(df, text_col, into, T.ArrayType(T.IntegerType()), make)


def decode(df: DataFrame, path: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds the decoded text: the labels of the ids, joined by one space.

    The vocabulary of this kind names no decoder, so word ends and byte
    letters stay as they are in the labels. Null ids decode to no text.
    """
    # one literal, split when the plan is optimised: labels hold no space
    labels = F.split(F.lit(" ".join(arc_labels(read_spec(path)))), " ")
    return with_columns(df, {into: F.coalesce(
        F.array_join(F.transform(col(ids_col), lambda i: F.get(labels, i)), " "), F.lit(""))})
