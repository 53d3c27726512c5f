"""Alignment of two tokenizers over one corpus, Arrow-native.

A text with a space before it is encoded by a byte-level vocabulary (A) and by
a piece model (B). In every batch the tokens of all documents are flat Arrow
columns beside their parent index; running sums of the tokens' byte lengths,
started anew at each document, give the byte place where a token ends. A hash
join of the two sides on (document, end) gives the links, and ``group_by``
counts the linked id pairs of a batch. Spark adds up these partial counts.

The encoded links are written once; the figures that need the corpus-wide
counts come from a second pass over them. The counts of all pairs (at most
the product of the vocabularies) meet the links in blocks of at most
``BLOCK_PAIRS`` pairs, dealt by a hash, each sent to the tasks whole: the links
are never shuffled, whatever pair is frequent.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetspark.llm.bpe import read_spec, slices
from facetspark.llm.common import LEAN_PARQUET, col, delete_path, give_back, small_batches, stored, worker_state
from facetspark.llm.pieces import Library, Table, byte_letters, joined, one_core, pieces, text_counts, wide_space
from facetspark.session import scratch_dir

BLOCK_PAIRS = 2_000_000  # of 24 bytes
_SLICE = 1 << 19


def byte_tokens(spec: str) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary."""
    s = json.loads(spec)
    byte = {letter: i for i, letter in enumerate(byte_letters())}
    vocab = s["model"]["vocab"]
    out = [b""] * (max([*vocab.values(), *(t["id"] for t in s["added_tokens"])]) + 1)
    for t in s["added_tokens"]:
        out[t["id"]] = t["content"].encode("utf-8")
    for token, i in vocab.items():
        if all(c in byte for c in token):
            out[i] = bytes(byte[c] for c in token)
    return out


class Pieces:
    """A sentencepiece model behind a worker's table of spans.

    The model puts one space before a text. It never joins pieces across a cut
    before a space or line feed if no piece holds one behind another
    character, nor before a stop if no piece has one behind a letter; this is
    looked up in the vocabulary, and a model that has such pieces is not cut.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode("utf-8")
                      for i, p in enumerate(names)]
        lead = self.model.encode("\n")
        plain = [p for i, p in enumerate(names) if not self.model.is_byte(i)]
        self.cuts = (len(lead) == 2 and self.bytes[lead[0]] == b" " and self.bytes[lead[1]] == b"\n" and not any(
            "▁" in p.lstrip("▁") or "\n" in p or any(
                c in ".," and p[k].isascii() and p[k].isalpha() for k, c in enumerate(p[1:])) for p in plain))
        self.table = Table(id_type=np.uint16 if len(names) <= 1 << 16 else np.uint32)

    def values(self, spans: list[bytes]) -> list[list[int]]:
        """Ids of spans. What does not begin with a space is asked for behind
        a line feed, whose two ids go."""
        text = [s.decode("utf-8") for s in spans]
        led = [t[1:] if t[:1] == " " else "\n" + t for t in text]
        return [ids if t[:1] == " " else ids[2:] for t, ids in zip(text, self.model.encode(led, num_threads=1))]

    def encode(self, texts: list[str], b: np.ndarray, at: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Ids of all texts and how many each has; b, at: the texts' bytes
        with a space before each, start, end: their spans."""
        if not self.cuts:
            ids = self.model.encode(texts, num_threads=1)
            return np.array([i for x in ids for i in x], dtype=np.uint32), np.array([len(x) for x in ids], dtype=np.int64)
        ids, n = self.table.numbers(b, start, end, self.values)
        return ids, text_counts(start, n, at)


class Pair:
    """Both tokenizers of a worker, and the bytes and spellings of their ids."""

    def __init__(self, spec: str, model: bytes):
        one_core()
        self.a, self.b = Library(spec, special=False), Pieces(model)
        self.sides = [pa.array(byte_tokens(spec), pa.binary()), pa.array(self.b.bytes, pa.binary())]
        self.widths = [np.array([len(x) for x in side.to_pylist()], dtype=np.int64) for side in self.sides]
        most = max(map(len, self.sides))
        # every id followed by each of the marks, and by nothing
        self.spelled = pa.array([f"{i}{mark}".encode() for mark in (",", "|", ";", "") for i in range(most)], pa.binary())
        self.most = most

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and B: flat ids, and how many each text has. A text that is
        empty, or whose joined tokens differ from it, has none."""
        data, at = joined(texts, " ")
        start, end = pieces(data, at)
        ids, n = self.a.table.numbers(data, start, end, self.a.values)
        sides = [[ids, text_counts(start, n, at)], list(self.b.encode(texts, data, at, start, end))]
        wide = {i: self.a.whole(" " + t) for i, t in enumerate(texts) if wide_space(t)}
        if wide:
            parts = np.split(sides[0][0], np.cumsum(sides[0][1])[:-1])
            for i, x in wide.items():
                parts[i], sides[0][1][i] = np.array(x, dtype=np.uint32), len(x)
            sides[0][0] = np.concatenate(parts)
        good = np.array([t != "" for t in texts], dtype=bool)
        raw = data.tobytes()
        for (ids, n), names in zip(sides, self.sides):
            edge, made = _run_together(names, ids, np.concatenate(([0], np.cumsum(n))))
            if not np.array_equal(edge, at) or made != raw:
                good &= [made[s:e] == raw[u:v] for s, e, u, v in zip(
                    edge[:-1].tolist(), edge[1:].tolist(), at[:-1].tolist(), at[1:].tolist())]
        return [(ids[np.repeat(good, n)], np.where(good, n, 0)) for ids, n in sides]


def _run_together(names: pa.Array, pick: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The picked strings one after the other, and where the pick's edges fall."""
    if not len(pick):
        return np.zeros(len(edges), dtype=np.int64), b""
    taken = names.take(pa.array(pick.astype(np.int64)))
    offsets = np.frombuffer(taken.buffers()[1], dtype=np.int32)[:len(taken) + 1]
    return offsets[edges].astype(np.int64), taken.buffers()[2].to_pybytes()[:int(offsets[-1])]


def token_ends(ids: np.ndarray, n: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent index of every token, and the byte place in its document where it ends."""
    parent = np.repeat(np.arange(len(n)), n)
    run = np.cumsum(widths[ids])
    first = np.cumsum(n) - n
    before = np.concatenate(([0], run))[first]
    return parent, run - before[parent]


def linked(sides, widths) -> pa.Table:
    """(doc, end, place_a, a, place_b, b): all pairs of tokens that end together."""
    tables = []
    for name, (ids, n), w in zip("ab", sides, widths):
        parent, end = token_ends(ids, n, w)
        tables.append(pa.table({"doc": parent, "end": end, f"place_{name}": np.arange(len(ids)), name: ids.astype(np.int64)}))
    return tables[0].join(tables[1], ["doc", "end"], join_type="inner", use_threads=False)


def group_numbers(sides, widths, links: pa.Table) -> list[np.ndarray]:
    """For A and B: the group of every token, counted over the whole batch. A
    group ends where tokens of both sides end; as both sides end with their
    document, no group reaches beyond one."""
    out = []
    for name, (ids, n) in zip("ab", sides):
        last = np.zeros(len(ids) + 1, dtype=np.int64)
        place = np.unique(links[f"place_{name}"].to_numpy())
        parent, end = token_ends(ids, n, widths["ab".index(name)])
        # of tokens that end at one place (empty ones), the last closes the group
        if len(place):
            nxt = np.minimum(place + 1, len(ids) - 1)
            same = (place + 1 < len(ids)) & (parent[nxt] == parent[place]) & (end[nxt] == end[place])
            last[place[~same] + 1] = 1
        out.append(np.cumsum(last)[:-1])
    return out


def spelled_groups(pair: Pair, sides, groups) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of every document."""
    docs = [np.repeat(np.arange(len(n)), n) for _, n in sides]
    total = int(max((int(g[-1]) + 1 for g in groups if len(g)), default=0))
    size = [np.bincount(g, minlength=total) for g in groups]
    base = np.concatenate(([0], np.cumsum(size[0] + size[1])))
    pick = np.zeros(int(base[-1]), dtype=np.int64)
    of_doc = np.zeros(total, dtype=np.int64)
    for g, d in zip(groups, docs):
        of_doc[g] = d
    final = np.append(of_doc[1:] != of_doc[:-1], True) if total else np.zeros(0, dtype=bool)
    for side, ((ids, _), g) in enumerate(zip(sides, groups)):
        inside = np.arange(len(g)) - (np.cumsum(size[side]) - size[side])[g]
        closes = inside == size[side][g] - 1
        mark = np.where(closes, 1 if side == 0 else np.where(final[g], 3, 2), 0)
        pick[base[g] + (size[0][g] if side else 0) + inside] = mark * pair.most + ids
    edge, text = _run_together(pair.spelled, pick, np.concatenate(([0], np.cumsum(sides[0][1] + sides[1][1]))))
    return [text[s:e] for s, e in zip(edge[:-1].tolist(), edge[1:].tolist())]


@dataclass
class Alignment:
    """docs: (id, n_a, n_b, n_groups, groups, a, b), one row per document,
    stored; a, b: the ids of its links, in order."""

    docs: DataFrame
    pairs: DataFrame  # (pair, n, best): pair = a << 32 | b; best: the highest n of its b
    n_pairs: int
    path: str

    def delete(self) -> None:
        delete_path(self.docs.sparkSession, self.path)


def align(df: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
          keep_groups: bool = True) -> Alignment:
    """Encodes every whole text on both sides and links the tokens.

    Null and empty texts, and those whose joined token bytes on either side
    differ from a space and the text, have no tokens and an empty group
    string. Rows are documents of their own, whatever ids repeat or are null;
    other columns are not read. An empty table gives empty results. With
    ``keep_groups`` off only the SHA-256 of the group string is kept (column
    ``groups``, empty for no tokens).
    """
    spark, spec = df.sparkSession, read_spec(byte_path)
    with open(piece_path, "rb") as f:
        model = f.read()
    id_type = df.select(col(id_col)).schema[0].dataType
    rows = small_batches(df).select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))

    def run(batches):
        pair = worker_state(("pair", hash(spec)), lambda: Pair(spec, model))
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                sides = pair.encode(part.column(1).to_pylist())
                links = linked(sides, pair.widths).sort_by([("place_a", "ascending"), ("place_b", "ascending")])
                groups = group_numbers(sides, pair.widths, links)
                said = spelled_groups(pair, sides, groups)
                if not keep_groups:
                    said = [hashlib.sha256(x).hexdigest().encode() if x else b"" for x in said]
                doc = links["doc"].to_numpy()
                ends = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=part.num_rows)))).astype(np.int32)
                n_groups = np.zeros(part.num_rows, dtype=np.int64)
                if len(groups[0]):
                    parent = np.repeat(np.arange(part.num_rows), sides[0][1])
                    n_groups = np.bincount(parent, weights=np.append(groups[0][1:] != groups[0][:-1], True),
                                           minlength=part.num_rows).astype(np.int64)
                lists = [pa.ListArray.from_arrays(pa.array(ends), links[c].combine_chunks().cast(pa.int32()))
                         for c in "ab"]
                out = pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sides[0][1]), pa.array(sides[1][1]), pa.array(n_groups),
                     pa.array([x.decode() for x in said]), *lists],
                    names=["id", "n_a", "n_b", "n_groups", "groups", "a", "b"])
                del sides, links, groups, said, doc, lists  # before the next slice's arrays
                yield out
            give_back()

    to = scratch_dir(spark, "links")
    rows.mapInArrow(run, f"id {id_type.simpleString()}, n_a long, n_b long, n_groups long, groups string, "
                         "a array<int>, b array<int>").write.options(**LEAN_PARQUET).parquet(to)
    docs = spark.read.parquet(to)

    def count(batches):
        for batch in batches:
            a, b = (batch.column(k).flatten().to_numpy().astype(np.int64) for k in (0, 1))
            part = pa.table({"pair": a << 32 | b}).group_by("pair", use_threads=False).aggregate([([], "count_all")])
            yield from part.rename_columns(["pair", "n"]).to_batches()

    n = docs.select("a", "b").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    n = stored(n)
    best = n.groupBy(F.expr("pair & 4294967295").alias("b")).agg(F.max("n").alias("best"))
    pairs = n.join(best, F.expr("pair & 4294967295") == best.b).select("pair", "n", "best")
    return Alignment(docs, pairs, n.count(), to)


def link_figures(found: Alignment, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """docs' columns without the links, and n_links, n_best (links whose pair
    has its b's highest count) and count_sum (of the links' pair counts)."""
    blocks = max(1, -(-found.n_pairs // block_pairs))
    spark = found.docs.sparkSession
    dealt = stored(found.pairs) if blocks > 1 else found.pairs
    docs = found.docs.withColumns({
        "n_links": F.size("a").cast("long"), "n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    for k in range(blocks):
        mine = dealt.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == k) if blocks > 1 else dealt
        block = mine.toArrow().sort_by("pair")  # about block_pairs rows
        pairs, n, best = (block[c].to_numpy() for c in ("pair", "n", "best"))
        sent = spark.sparkContext.broadcast((pairs, n, n == best))
        kept = [c for c in docs.columns if c not in ("a", "b") or k + 1 < blocks]

        def add(batches, sent=sent, kept=kept):
            pairs, n, best = sent.value
            for batch in batches:
                columns = dict(zip(batch.schema.names, batch.columns))
                ends = np.concatenate(([0], np.cumsum(columns["a"].value_lengths().to_numpy())))
                a, b = (columns[c].flatten().to_numpy().astype(np.int64) for c in "ab")
                want = a << 32 | b
                near = np.minimum(np.searchsorted(pairs, want), max(0, len(pairs) - 1))
                hit = pairs[near] == want if len(pairs) else np.zeros(len(want), dtype=bool)
                for name, value in (("n_best", best), ("count_sum", n)):
                    each = np.zeros(len(want), dtype=np.int64)
                    each[hit] = value[near[hit]]
                    run = np.concatenate(([0], np.cumsum(each)))
                    columns[name] = pa.array(columns[name].to_numpy() + run[ends[1:]] - run[ends[:-1]])
                yield pa.RecordBatch.from_arrays([columns[c] for c in kept], names=kept)

        docs = docs.mapInArrow(add, docs.select(*kept).schema)
        if k + 1 < blocks:
            docs = stored(docs)
    return docs


def aligned_documents(df: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
                      keep_groups: bool = True, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``align`` and ``link_figures`` in one: (id, n_a, n_b, n_groups, groups,
    n_links, n_best, count_sum), stored; the links are deleted."""
    found = align(df, byte_path, piece_path, id_col, text_col, keep_groups)
    try:
        return stored(link_figures(found, block_pairs)).withColumnRenamed("id", id_col)
    finally:
        found.delete()
