import collections
import zlib

import numpy as np
from tokenizers import Tokenizer

from facetspark.llm import packing
from facetspark.llm.bpe import read_spec
from facetspark.llm.queries import QUERIES, tokenizer


def brute_cost(at, cost, window):
    """Least sum of padding and cut costs, by trying every pair of cuts."""
    f = [0]
    for j in range(1, len(at)):
        f.append(min(f[i] + (0 if n & (n - 1) == 0 else window - n) + cost[j]
                     for i in range(j) for n in [at[j] - at[i]] if n <= window))
    return f


def test_monotone_queue_finds_the_least_cost():
    rng = np.random.default_rng(3)
    for _ in range(200):
        window = int(rng.integers(1, 40))
        gaps = rng.integers(1, min(window, int(rng.integers(1, 12))) + 1, int(rng.integers(1, 60)))
        at = np.concatenate(([0], np.cumsum(gaps)))
        cost = rng.integers(0, 9, len(at))
        f, back = packing.cheapest(at, cost, window)
        assert f == brute_cost(at.tolist(), cost.tolist(), window)
        cuts = packing.choose_cuts(at, cost, window, True).tolist()
        sizes = np.diff(cuts)
        assert cuts[0] == 0 and cuts[-1] == at[-1] and (sizes <= window).all()
        by = dict(zip(at.tolist(), cost.tolist()))
        assert sum(by[c] for c in cuts[1:]) + sum(0 if n & (n - 1) == 0 else window - n for n in sizes.tolist()) == f[-1]
        part = packing.choose_cuts(at, cost, window, False).tolist()
        assert at[-1] - part[-1] < window and set(part) <= set(at.tolist())


def test_candidates():
    at, cost = packing.candidates(np.array([5, 30]), np.array([3, 5, 12]), gap=6, sentence_cost=4, break_cost=12)
    assert dict(zip(at.tolist(), cost.tolist())) == {0: 4, 3: 4, 5: 0, 11: 12, 12: 4, 18: 12, 24: 12, 30: 0}
    marks = packing.sentence_ends(read_spec(tokenizer("word_bpe_49k.json")))
    t = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    ids = t.encode("One two. Three! 3.5 four,", add_special_tokens=False).ids
    assert [t.id_to_token(i) for i in ids if marks[i]] == [".</w>", "!</w>", ".</w>"]


def check(rows, texts, window):
    """Pieces hold every document's ids once, sequences have no gaps; gives padding and ids."""
    t = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    by, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(by) == set(texts)
    for i, parts in by.items():
        ids, at = np.array(t.encode(texts[i] or "", add_special_tokens=False).ids + [2], dtype="<u4"), 0
        for r in sorted(parts, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for parts in sequences.values():
        n = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == n
            n += r.length
        assert n <= window
        total += n
        padding += window - n if n & (n - 1) else 0
    return padding, total


def test_query_packs_every_document(spark, sf001):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    rows = QUERIES["op13_window_packing"](spark, sf001).collect()
    padding, total = check(rows, texts, 4096)
    assert padding < 0.01 * total
    # documents of one partition follow each other in their order
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset))]
    first = list(dict.fromkeys(order))
    assert len(first) == len(texts) and order == [i for i in first for _ in range(order.count(i))]


def test_stretches_and_odd_rows(spark, monkeypatch):
    texts = {1: None, 2: "", 3: "One. Two! " * 900, 4: "no marks at all " * 500, 5: "x", 6: "  \n ", 7: "end." * 40}
    df = spark.createDataFrame([(i, t, 7, "b", 0) for i, t in texts.items()],
                               "doc_id long, text string, id int, data string, offset int").coalesce(1)
    from pyspark.sql import functions as F

    def pieces(d, **kw):
        p = packing.pack_documents(d, tokenizer("word_bpe_49k.json"), **kw)
        return p.select("doc_id", "start", (F.length("data") / 4).cast("long").alias("length"),
                        F.crc32("data").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

    for window in (4096, 100, 64, 1):
        padding, total = check(pieces(df, window=window, gap=min(8, window)).collect(), texts, window)
        assert padding <= 0.1 * total + window
    assert pieces(df.limit(0)).collect() == []
    twice = pieces(df.unionByName(df).withColumn("doc_id", F.lit(None).cast("long"))).collect()
    assert sum(r.length for r in twice) == 2 * total and {r.doc_id for r in twice} == {None}


def test_stream_carries_ids_over():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    packing_stretch, packing.STRETCH = packing.STRETCH, 300
    try:
        marks = np.zeros(50, dtype=bool)
        marks[7] = True
        s = packing.Stream(1, marks, pa.int64(), 64, 8, (4, 12))
        batches, want = [], []
        for k in range(30):
            n = rng.integers(1, 90, 5)
            ids = rng.integers(0, 60, n.sum()).astype(np.uint32)
            want.append(ids)
            batches += s.add(list(range(5 * k, 5 * k + 5)), ids, n)
        batches += s.close()
    finally:
        packing.STRETCH = packing_stretch
    t = pa.Table.from_batches(batches)
    assert b"".join(t["data"].to_pylist()) == np.concatenate(want).astype("<u4").tobytes()
    assert len(batches) > 3 and t["sequence_id"].to_pylist() == sorted(t["sequence_id"].to_pylist())
    at = {}
    for i, start, data, total in zip(*(t[c].to_pylist() for c in ("id", "start", "data", "doc_tokens"))):
        assert at.get(i, 0) == start
        at[i] = start + len(data) // 4
        last = total
    assert sorted(at) == list(range(150)) and at[149] == last
