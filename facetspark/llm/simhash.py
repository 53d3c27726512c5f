"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints: every shingle of ``shingle_words`` lower-cased words is hashed
with XXH64; a bit of the fingerprint is 1 where more than half of the hashes
have it.

Links (at most ``max_bits`` differing bits) are searched among the distinct
fingerprints, in three moves:

1. *Co-location.* The 64 bits are cut into max_bits + 1 blocks. Two
   fingerprints within the distance agree on a whole block, so each is sent
   to one group per block value. A group of more than ``leaf`` fingerprints
   is cut again over its free bits in the same way, so that groups stay small
   whatever the density; a pair within the distance always still meets, and a
   group with few free bits left is small by itself.
2. *Index.* A task sorts each group by Gray rank (neighbours in that order
   share long bit patterns) and builds a tree over it: a node holds the mask
   of bits that all fingerprints below agree on, less the bits its parent has
   already, and their values.
3. *Search.* Every fingerprint walks down from its group's root, adding the
   differences in each node's own bits; a subtree is dropped as a whole when
   the sum passes ``max_bits``.

Only a spanning forest of the links of a group leaves the task; components
of the forest equal those of the links.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetspark.llm.common import col, connected_components, join_hubs, min_labels, on_arrow, row_key, small_batches, stored, with_columns

FANOUT = 8
LEAF = 1024
SEED = 42
_M64 = (1 << 64) - 1


def fingerprint_of(data: bytes | None, shingle_words: int) -> int:
    """Unsigned 64-bit SimHash of a text in UTF-8; no word: 0."""
    words = (data or b"").lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle_words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        starts = np.zeros(len(words) + 1, dtype=np.int64)
        np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED)
                  for s, e in zip(starts[:-shingle_words].tolist(), (starts[shingle_words:] - 1).tolist())]
    h = np.array(hashes, dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i:i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h)).view(">u8")[0])


def fingerprints(df: DataFrame, text_col: str, shingle_words: int, into: str = "__fp") -> DataFrame:
    """Adds the fingerprint as a signed long (same 64 bits)."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, shingle_words) for t in texts], dtype=np.uint64).view(np.int64))

    return small_batches(df).withColumn(into, fp(col(text_col).cast("binary")))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _cuts(fixed: int, parts: int) -> list[int]:
    """``fixed`` plus each of ``parts`` even blocks of the free bits."""
    free = [i for i in range(63, -1, -1) if not fixed >> i & 1]
    blocks = [b for b in np.array_split(np.array(free, dtype=np.int64), parts) if len(b)]
    return [fixed | sum(1 << int(i) for i in b) for b in blocks]


def _gray_rank(c):
    """Sortable rank of a 64-bit pattern in Gray order (native expression)."""
    for s in (1, 2, 4, 8, 16, 32):
        c = c.bitwiseXOR(F.shiftrightunsigned(c, s))
    return c.bitwiseXOR(F.lit(-(1 << 63)))


def _grouped(fps: DataFrame, max_bits: int, leaf: int) -> DataFrame:
    """(mask, key, fp) rows whose groups are small; see the module's text."""
    masks = _cuts(0, max_bits + 1)
    rows = fps.select(F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"), "fp")
    done = None
    while True:
        rows = rows.select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("key"), "fp")
        # a group of f free bits has at most 2^f members
        open_ = [m for m in masks if 64 - m.bit_count() > np.log2(leaf)]
        big = rows.groupBy("mask", "key").count().where(
            (F.col("count") > leaf) & F.col("mask").isin([_signed(m) for m in open_])).select("mask", "key")
        big = stored(big)
        if big.isEmpty():
            return rows if done is None else done.unionByName(rows)
        marked = stored(rows.join(big.withColumn("big", F.lit(True)), ["mask", "key"], "left"))
        small = marked.where("big is null").select("mask", "key", "fp")
        done = small if done is None else done.unionByName(small)
        children = {m: _cuts(m, max_bits + 1) for m in open_}
        table = F.create_map(*[x for m, c in children.items()
                               for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(k)) for k in c]))])
        rows = marked.where("big").select(F.explode(table[F.col("mask")]).alias("mask"), "fp")
        masks = sorted({k for c in children.values() for k in c})


def _tree(starts: np.ndarray, sizes: np.ndarray, fp: np.ndarray) -> list[dict]:
    """Levels from the single fingerprints up to one root per group."""
    full = np.uint64(_M64)
    levels = [{"first": starts, "n": sizes, "all": fp, "any": fp}]
    while levels[-1]["n"].max() > 1:
        low = levels[-1]
        n = -(-low["n"] // FANOUT)
        first = np.concatenate(([0], np.cumsum(n)[:-1]))
        inside = np.arange(n.sum()) - np.repeat(first, n)
        child = np.repeat(low["first"], n) + inside * FANOUT
        levels.append({"first": first, "n": n, "child": child,
                       "children": np.minimum(FANOUT, np.repeat(low["first"] + low["n"], n) - child),
                       "all": np.bitwise_and.reduceat(low["all"], child),
                       "any": np.bitwise_or.reduceat(low["any"], child)})
    above = np.zeros(len(levels[-1]["all"]), dtype=np.uint64)
    for level in reversed(levels):
        common = full ^ (level["all"] ^ level["any"])
        level["own"] = common & ~above  # bits this node adds to its ancestors'
        if "child" in level:
            above = np.repeat(common, level["children"])
    return levels


def links_within(group: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of one group at ``max_bits`` or fewer differing bits.

    ``group`` is sorted; ``fp`` in Gray order inside a group.
    """
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(fp)])))
    levels = _tree(starts, sizes, fp)
    home = np.repeat(np.arange(len(starts)), sizes)
    work = np.cumsum(sizes[home])
    a, b = [], []
    begin = 0
    while begin < len(fp):  # blocks of queries, so that the frontier stays small
        end = max(begin + 1, int(np.searchsorted(work, (work[begin - 1] if begin else 0) + (1 << 21))))
        q = np.arange(begin, end)
        q = q[sizes[home[q]] > 1]
        node, seen = home[q], np.zeros(len(q), dtype=np.int64)
        for i in range(len(levels) - 1, -1, -1):
            level = levels[i]
            seen = seen + np.bitwise_count((fp[q] ^ level["all"][node]) & level["own"][node])
            near = seen <= max_bits
            q, node, seen = q[near], node[near], seen[near]
            if i:
                n = level["children"][node]
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                node = np.repeat(level["child"][node], n) + step
                q, seen = np.repeat(q, n), np.repeat(seen, n)
        right = q < node
        a.append(q[right])
        b.append(node[right])
        begin = end
    return np.concatenate(a) if a else np.array([], int), np.concatenate(b) if b else np.array([], int)


def fingerprint_links(fps: DataFrame, max_bits: int, leaf: int = LEAF) -> DataFrame:
    """A spanning forest (a, b) of the links among distinct fingerprints ``fp``."""
    def search(t: pa.Table) -> pa.Table:
        mask, key = t["mask"].to_numpy(), t["key"].to_numpy()
        fp = t["fp"].to_numpy().view(np.uint64)
        new = np.concatenate(([True], (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])))
        a, b = links_within(np.cumsum(new), fp, max_bits)
        label = min_labels(len(fp), a, b)
        bound = np.flatnonzero(label != np.arange(len(fp)))
        signed = fp.view(np.int64)
        return pa.table({"a": signed[bound], "b": signed[label[bound]]})

    grouped = _grouped(fps, max_bits, leaf).withColumn("rank", _gray_rank(F.col("fp")))
    return (grouped.repartition("mask", "key").sortWithinPartitions("mask", "key", "rank")
            .select("mask", "key", "fp").mapInArrow(on_arrow(search, ["mask", "key"]), "a long, b long"))


def _rooted(ids: DataFrame, shingle_words: int, max_bits: int, leaf: int) -> DataFrame:
    """The columns of ``ids`` (__id, __text, others) but the text, with __fp,
    __root (a fingerprint that names the component) and component_id."""
    docs = stored(fingerprints(ids, "__text", shingle_words).drop("__text"))
    per_fp = stored(docs.groupBy("__fp").agg(F.min("__id").alias("__min"), F.count(F.lit(1)).alias("__n")))
    fps = per_fp.select(F.col("__fp").alias("fp"))
    comp = connected_components(fingerprint_links(fps, max_bits, leaf))
    rooted = stored(per_fp.join(comp, per_fp["__fp"] == comp["node"], "left").select(
        "__fp", "__min", F.coalesce("root", "__fp").alias("__root")))
    least = stored(rooted.groupBy("__root").agg(F.min("__min").alias("component_id"), F.count(F.lit(1)).alias("__n")))
    most_docs, most_fps = (d.agg(F.max("__n")).first()[0] or 0 for d in (per_fp, least))
    rooted = join_hubs(rooted, least.drop("__n"), ["__root"], ["__fp"], most_fps)
    return join_hubs(docs, rooted.select("__fp", "__root", "component_id"), ["__fp"], ["__id"], most_docs)


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle_words: int = 3, max_bits: int = 2, leaf: int = LEAF) -> DataFrame:
    """One row (id, fingerprint, component_id) per input row.

    component_id is the smallest id of all rows reachable through links,
    copies included. A null or wordless text has fingerprint 0 and links like
    any other. Null ids are never a component_id unless the component has no
    other; repeated rows each return a row. An empty table gives an empty one.
    Other input columns are not carried, whatever their names.
    """
    ids = df.select(col(id_col).alias("__id"), col(text_col).alias("__text"))
    out = _rooted(ids, shingle_words, max_bits, leaf)
    return out.select(F.col("__id").alias(id_col),
                      F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``df`` that represent their component, one of each: that of
    the smallest id; of several rows with this id, the one of the smallest
    fingerprint, then of the smallest hash of the row. Rows are known by their
    whole content, so an id may be repeated.

    Rows without an id stay, as nothing tells them apart as documents.
    """
    key = row_key(df)
    rows = _rooted(df.select(col(id_col).alias("__id"), col(text_col).alias("__text"), *key),
                   shingle_words, max_bits, LEAF)
    keep = rows.where(F.col("__id") == F.col("component_id")).groupBy("__root").agg(
        F.min(F.struct("__fp", "__k1", "__k2")).alias("__one")).select("__one.__k1", "__one.__k2")
    kept = df.where(col(id_col).isNotNull()).select("*", *key).join(
        keep, ["__k1", "__k2"], "left_semi").dropDuplicates(["__k1", "__k2"])
    return kept.select(*[col(c) for c in df.columns]).unionByName(df.where(col(id_col).isNull()))
