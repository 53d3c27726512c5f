"""Embedding near-duplicates by cross-polytope hashing.

Equal vectors are one class first, so copies cost nothing. A table hashes a
class's vector by ``hashes`` pseudorandom rotations, each three rounds of
random signs and a fast Hadamard transform: a rotation's value is the
coordinate of largest size with its sign. Besides the bucket of its own
values, a vector enters the ``probes`` next likely buckets (one rotation's
value replaced by its runner-up, smallest loss first).

What is dealt to the buckets is light: a class's number and a sketch of
``BITS`` signs of random projections. Two vectors meet if they share a bucket
and their sketches differ in no more bits than pairs at the threshold do (the
mean and ``SIGMAS`` deviations more). A bucket of more than ``block`` vectors
is cut into parts, and every pair of parts is a group of its own, so a hot
bucket spreads over many tasks and no pair is left out.

A group with few such pairs names them, and their vectors are fetched and
compared in double precision. A group with more than ``dense`` pairs a vector
names its members instead: only these vectors travel to the group, and what
leaves its task is a count per vector and a spanning forest of the links, so no
group ever writes all of its pairs. Every pair is counted in its first common
bucket only.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetspark.llm.common import col, connected_components, join_hubs, min_labels, on_arrow, stored

TABLES = 8
HASHES = 2
PROBES = 2
BLOCK = 1000
BITS = 128
SIGMAS = 4.5
DENSE = 4
SMALL = 32
HOT_BROADCAST = 1_000_000


def _hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform along the last axis (length a power of 2)."""
    n, h = x.shape[-1], 1
    while h < n:
        y = x.reshape(*x.shape[:-1], n // (2 * h), 2, h)
        x = np.stack((y[..., 0, :] + y[..., 1, :], y[..., 0, :] - y[..., 1, :]), axis=-2).reshape(*x.shape)
        h *= 2
    return x / np.sqrt(n)


def buckets(x: np.ndarray, table: int, hashes: int, probes: int, seed: int) -> np.ndarray:
    """Bucket numbers of unit vectors: own bucket, then ``probes`` others."""
    n, dim = x.shape
    width = 1 << max(1, (dim - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, width - dim)))
    first = np.empty((n, hashes), dtype=np.int64)
    second, loss = np.empty((n, hashes), dtype=np.int64), np.empty((n, hashes))
    for h in range(hashes):
        signs = np.random.default_rng([seed, table, h]).choice((-1.0, 1.0), (3, width))
        y = x
        for s in signs:
            y = _hadamard(y * s)
        size = np.abs(y)
        top = np.argpartition(size, width - 2, axis=1)[:, -2:]
        pair = np.take_along_axis(size, top, axis=1)
        turn = pair[:, 0] > pair[:, 1]
        top[turn] = top[turn][:, ::-1]
        value = top * 2 + (np.take_along_axis(y, top, axis=1) < 0)
        first[:, h], second[:, h] = value[:, 1], value[:, 0]
        loss[:, h] = np.abs(pair[:, 1] - pair[:, 0])
    radix = (2 * width) ** np.arange(hashes, dtype=np.int64)
    own = first @ radix
    swaps = np.array([[m >> h & 1 for h in range(hashes)] for m in range(1, 1 << hashes)])
    cost = (loss**2) @ swaps.T
    take = np.argsort(cost, axis=1, kind="stable")[:, :probes]
    other = own[:, None] + (((second - first) * radix) @ swaps.T)[np.arange(n)[:, None], take]
    return np.concatenate((own[:, None], other), axis=1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def sketch(x: np.ndarray, seed: int) -> np.ndarray:
    """``BITS`` signs of random projections of unit vectors, as 64-bit words."""
    planes = np.random.default_rng([seed, x.shape[1]]).normal(size=(x.shape[1], BITS))
    return np.packbits(x @ planes >= 0, axis=1).view(np.int64)


def sketch_limit(threshold: float) -> int:
    """Bits in which the sketches of linked vectors differ at most: a sign
    differs with probability angle / pi."""
    p = math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    return math.ceil(BITS * p + SIGMAS * math.sqrt(BITS * p * (1 - p)))


def sketches_near(a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)).sum(axis=-1, dtype=np.int64) <= limit  # signed: counts |x|


def first_common(p: np.ndarray, q: np.ndarray, tables: int) -> np.ndarray:
    """The first bucket that rows of ``p`` and ``q`` share, the same from either
    side: lowest table, then lowest number; -1 if there is none."""
    n, per = len(p), p.shape[1] // tables
    a, b = p.reshape(n, tables, per).astype(np.int64), q.reshape(n, tables, per).astype(np.int64)
    none = np.iinfo(np.int64).max
    low = np.where((a[:, :, :, None] == b[:, :, None, :]).any(axis=3), a, none).min(axis=2)
    at = (low != none).argmax(axis=1)
    value = low[np.arange(n), at]
    return np.where(value == none, -1, value * tables + at)


def groups(t: pa.Table, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of equal keys."""
    key = np.stack([t[k].to_numpy() for k in keys])
    cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
    start = np.concatenate(([0], cut))
    return start, np.diff(np.concatenate((start, [t.num_rows])))


def vectors(c: pa.ChunkedArray, rows: np.ndarray | slice) -> np.ndarray:
    """Lists of one length as the rows of a matrix, in double precision."""
    c = c.combine_chunks()
    c = c.slice(rows.start, rows.stop - rows.start) if isinstance(rows, slice) else c.take(pa.array(rows))
    return c.flatten().to_numpy().reshape(len(c), -1)


def meeting_pairs(s: np.ndarray, part: np.ndarray, two_parts: np.ndarray, start: np.ndarray, size: np.ndarray,
                  limit: int, dense: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row pairs inside the groups whose sketches are near (in a group of two
    parts: between these), and which groups have more than ``dense`` a row."""
    group = np.repeat(np.arange(len(start)), size)
    left = np.repeat(start + size, size) - np.arange(len(group))  # rows of the group from this one on
    few = np.repeat(size <= SMALL, size)
    firsts, seconds = [], []
    for d in range(1, min(SMALL, int(size.max())) if len(size) else 0):
        a = np.flatnonzero(few & (left > d))
        a = a[sketches_near(s[a], s[a + d], limit) & (~two_parts[group[a]] | (part[a] != part[a + d]))]
        firsts.append(a)
        seconds.append(a + d)
    many = np.zeros(len(start), dtype=bool)
    for g in np.flatnonzero(size > SMALL):
        at, n, found = start[g], size[g], 0
        for k in range(0, n, 256):
            near = sketches_near(s[at + k:at + min(k + 256, n), None], s[None, at:at + n], limit)
            a, b = np.nonzero(near)
            ok = a + k < b
            a, b = at + k + a[ok], at + b[ok]
            if two_parts[g]:
                ok = part[a] != part[b]
                a, b = a[ok], b[ok]
            found += len(a)
            firsts.append(a)
            seconds.append(b)
            if found > dense * n:
                many[g] = True
                break
    a = np.concatenate([np.array([], dtype=np.int64), *firsts])
    b = np.concatenate([np.array([], dtype=np.int64), *seconds])
    many |= np.bincount(group[a], minlength=len(start)) > dense * size
    keep = ~many[group[a]]
    return a[keep], b[keep], many


def embedding_components(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                         threshold: float = 0.9, tables: int = TABLES, hashes: int = HASHES,
                         probes: int = PROBES, block: int = BLOCK, seed: int = 42, dense: int = DENSE,
                         hot_broadcast: int = HOT_BROADCAST) -> DataFrame:
    """One row (id, n_links, component_id, kept) per input row.

    A vector that is null, empty, zero or holds a null or non-finite component
    links with nothing. Vectors of different lengths do not link either. Links
    with a null id count for n_links, but such an id is a component_id only of
    a component that has no other. kept: id = component_id, also false for a
    null id. Repeated rows are vectors of their own, equal ones link.

    ``dense``: pairs a vector from which a group is compared whole; the list of
    buckets of more than ``block`` vectors is broadcast up to ``hot_broadcast``
    rows and joined by a shuffle beyond. Neither changes the result.
    """
    dim_ok = F.size("v") > 0
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # single-precision input travels as such; lengths and products are taken in double
    kind = "float" if isinstance(df.select(col(vector_col)).schema[0].dataType.elementType, T.FloatType) else "double"
    rows = df.select(col(id_col).alias("__id"), col(vector_col).cast(f"array<{kind}>").alias("v"))
    good = rows.where(F.coalesce(dim_ok & finite & F.exists("v", lambda x: x != 0), F.lit(False)))
    # two 64-bit hashes name a class of equal vectors; -0.0 equals 0.0
    v = F.transform("v", lambda x: x + F.lit(0.0).cast(kind))
    hashed = good.select("__id", F.xxhash64(v).alias("k1"), F.hash(v).alias("k2"), "v")
    classes = hashed.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies"), F.min("__id").alias("least"),
                                             F.first("v").alias("v"))
    per = 1 + probes
    width = tables * per
    # bucket numbers of vectors of up to 4096 components fit an int for two hashes
    whole, whole_np = ("int", np.int32) if hashes <= 2 else ("long", np.int64)
    limit = sketch_limit(threshold)

    def hash_all(batches):
        for t in batches:
            t = pa.Table.from_batches([t])
            size = pc.list_value_length(t["v"]).to_numpy()
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                x = unit(vectors(t["v"], at).astype(np.float64))
                b = np.concatenate([buckets(x, k, hashes, probes, seed) for k in range(tables)], axis=1)
                signs = sketch(x, seed)
                out = t.take(pa.array(at)).append_column("b", pa.array(list(b.astype(whole_np))))
                for k in range(signs.shape[1]):
                    out = out.append_column(f"s{k}", pa.array(signs[:, k]))
                yield from out.to_batches()

    # a class has its number from the stored table, so it never changes after
    numbered = classes.withColumn("c", F.monotonically_increasing_id())
    id_type = classes.schema["least"].dataType.simpleString()
    words = [f"s{k}" for k in range(BITS // 64)]
    known = stored(numbered.mapInArrow(
        hash_all, f"k1 long, k2 int, copies long, least {id_type}, v array<{kind}>, c long, b array<{whole}>, "
        + ", ".join(f"{w} long" for w in words)))
    # a bucket's number holds its table; vectors of other lengths are in other groups
    entry = known.select("c", *words, F.size("v").alias("dim"), F.posexplode("b").alias("pos", "value")).select(
        "c", *words, "dim", (F.col("value").cast("long") * tables + F.floor(F.col("pos") / per)).alias("bucket"))
    hot = stored(entry.groupBy("bucket", "dim").count().where(F.col("count") > block).select(
        "bucket", "dim", F.ceil(F.col("count") / block).cast("int").alias("parts")))
    n_hot, most_parts = hot.agg(F.count(F.lit(1)), F.max("parts")).first()
    entry = entry.join(F.broadcast(hot) if n_hot <= hot_broadcast else hot, ["bucket", "dim"], "left").withColumn(
        "parts", F.coalesce("parts", F.lit(1)))
    entry = entry.withColumn("part", F.pmod(F.xxhash64("c", F.lit(seed)), F.col("parts")).cast("int"))
    # part i meets part j in group (i, j), i <= j
    entry = entry.select("c", *words, "bucket", "dim", "part", F.explode(
        F.sequence(F.lit(0), F.col("parts") - 1)).alias("o")).select(
        "c", *words, "bucket", "dim", "part", F.least("part", "o").alias("i"), F.greatest("part", "o").alias("j"))
    keys = ["bucket", "dim", "i", "j"]

    def meet(t: pa.Table) -> pa.Table:
        start, size = groups(t, keys)
        two_parts = (t["i"].to_numpy() != t["j"].to_numpy())[start]
        signs = np.stack([t[w].to_numpy() for w in words], axis=1)
        a, b, many = meeting_pairs(signs, t["part"].to_numpy(), two_parts, start, size, limit, dense)
        members = np.flatnonzero(np.repeat(many, size))
        at, c = np.concatenate((a, members)), t["c"].to_numpy()
        return pa.table({"c": c[at], "other": np.concatenate((c[b], np.full(len(members), -1))),
                         **{k: t[k].to_numpy()[at] for k in [*keys, "part"]}})

    met = stored(entry.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        on_arrow(meet, keys), "c long, other long, bucket long, dim int, i int, j int, part int"))

    # named pairs: once each, with the buckets (at most ``width``) that named them
    pairs = stored(met.where("other >= 0").groupBy(F.least("c", "other").alias("p"), F.greatest("c", "other").alias("q")).agg(
        F.collect_set("bucket").alias("seen")))
    ends = pairs.select("p").unionAll(pairs.select("q")).groupBy("p").count()
    most_pairs = ends.agg(F.max("count")).first()[0] or 0

    def side(name: str) -> DataFrame:
        return known.select(F.col("c").alias(name), *[F.col(x).alias(f"{x}_{name}") for x in ("copies", "v", "b")])

    def verify(batches):
        for t in batches:
            t = pa.Table.from_batches([t])
            size = pc.list_value_length(t["v_p"]).to_numpy()
            for d in np.unique(size):
                r = t.take(pa.array(np.flatnonzero(size == d)))
                every = np.arange(r.num_rows)
                x, y = (unit(vectors(r[n], every).astype(np.float64)) for n in ("v_p", "v_q"))
                first = first_common(vectors(r["b_p"], every), vectors(r["b_q"], every), tables)
                seen = r["seen"].combine_chunks()
                named = np.repeat(first, seen.value_lengths().to_numpy()) == seen.flatten().to_numpy()
                cut = np.concatenate(([0], np.cumsum(seen.value_lengths().to_numpy())[:-1]))
                ok = (np.einsum("ij,ij->i", x, y) >= threshold) & np.logical_or.reduceat(named, cut)
                p, q, n_p, n_q = (r[n].to_numpy()[ok] for n in ("p", "q", "copies_p", "copies_q"))
                yield from pa.table({"c": np.concatenate((p, q)), "n": np.concatenate((n_q, n_p)),
                                     "root": np.concatenate((p, p))}).to_batches()

    both = join_hubs(join_hubs(pairs, side("p"), ["p"], ["q"], most_pairs), side("q"), ["q"], ["p"], most_pairs)
    named = both.select("p", "q", "seen", *[f"{x}_{n}" for n in "pq" for x in ("copies", "v", "b")]).mapInArrow(
        verify, "c long, n long, root long")

    def compare(t: pa.Table) -> pa.Table:
        c, copies, part_ = t["c"].to_numpy(), t["copies"].to_numpy(), t["part"].to_numpy()
        signs = np.stack([t[w].to_numpy() for w in words], axis=1)
        out_c, out_n, out_root = [], [], []
        for at, n in zip(*groups(t, keys)):
            rows_ = slice(int(at), int(at + n))
            xs, b, s_ = unit(vectors(t["v"], rows_).astype(np.float64)), vectors(t["b"], rows_), signs[rows_]
            bucket, i, j = (t[k][at].as_py() for k in ("bucket", "i", "j"))
            two = np.flatnonzero(part_[rows_] == j) if i != j else np.arange(n)
            one = np.flatnonzero(part_[rows_] == i)
            p, q = [np.array([], dtype=np.int64)], [np.array([], dtype=np.int64)]
            for k in range(0, len(one), 256):
                some = one[k:k + 256]
                a, z = np.nonzero((xs[some] @ xs[two].T >= threshold) & sketches_near(
                    s_[some][:, None], s_[two][None], limit))
                a, z = some[a], two[z]
                ok = a < z if i == j else np.ones(len(a), dtype=bool)
                p.append(a[ok])
                q.append(z[ok])
            p, q = np.concatenate(p), np.concatenate(q)
            label = min_labels(n, p, q)
            mine = np.empty(len(p), dtype=bool)
            for k in range(0, len(p), 1 << 14):
                some = slice(k, k + (1 << 14))
                mine[some] = first_common(b[p[some]], b[q[some]], tables) == bucket
            p, q = p[mine], q[mine]
            links = np.bincount(p, weights=copies[rows_][q], minlength=n) + np.bincount(
                q, weights=copies[rows_][p], minlength=n)
            use = (links > 0) | (label != np.arange(n))
            out_c.append(c[rows_][use])
            out_n.append(links[use].astype(np.int64))
            out_root.append(c[rows_][label[use]])
        cat = lambda z: np.concatenate([np.array([], dtype=np.int64), *z])
        return pa.table({"c": cat(out_c), "n": cat(out_n), "root": cat(out_root)})

    # a class is in ``width`` buckets, each of at most ``most_parts`` groups it takes part in
    members = join_hubs(met.where("other < 0").drop("other"), known.select("c", "copies", "v", "b", *words), ["c"], keys,
                        width * (most_parts or 1))
    crowded = members.repartition(*keys).sortWithinPartitions(*keys).select(
        *keys, "part", "c", "copies", "v", "b", *words).mapInArrow(on_arrow(compare, keys), "c long, n long, root long")
    found = stored(named.unionAll(crowded))
    comp = connected_components(found.select(F.col("c").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("c").agg(F.sum("n").alias("n"))
    out = known.select("c", "k1", "k2", "copies", "least").join(linked, "c", "left").join(
        comp.withColumnRenamed("node", "c"), "c", "left").select(
        "c", "k1", "k2", "copies", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "c").alias("root"))
    out = stored(out)
    least = stored(out.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n")))
    most_classes = least.agg(F.max("n")).first()[0] or 0
    most_copies = out.agg(F.max("copies")).first()[0] or 0
    least = least.drop("n")
    out = join_hubs(out, least, ["root"], ["c"], most_classes).select("k1", "k2", "n_links", "component_id")
    linked_rows = join_hubs(hashed.select("__id", "k1", "k2"), out, ["k1", "k2"], ["__id"], most_copies).select(
        "__id", "n_links", "component_id")
    bad = rows.where(~F.coalesce(dim_ok & finite & F.exists("v", lambda x: x != 0), F.lit(False))).select(
        "__id", F.lit(0).cast("long").alias("n_links"), F.col("__id").alias("component_id"))
    out = linked_rows.unionByName(bad)
    return out.select(F.col("__id").alias(id_col), "n_links", "component_id",
                      F.coalesce(F.col("__id") == F.col("component_id"), F.lit(False)).alias("kept"))
