import math
import random
import re
from collections import Counter

import duckdb

from facetspark.llm import search
from facetspark.llm.queries import ORACLE_SQL, QUERIES


def brute_terms(text):
    found = re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text or "")
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in found]


def brute(docs, items, k):
    """Per item row, its best (score, id) rows; docs and items: lists of (id, text)."""
    bags = [(i, brute_terms(t)) for i, t in docs]
    n, size = sum(bool(b) for _, b in bags), sum(len(b) for _, b in bags)
    df = Counter(t for _, b in bags for t in set(b))
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            tf, total = Counter(b), 0
            for t in brute_terms(text):
                if tf[t]:
                    m = 100 - 25 + 25 * len(b) * n // size
                    total += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (
                        1000000000 * tf[t] // (1000 * tf[t] + 12 * m))
            if total > 0:
                scores.append((-total, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k], 1)]
    return out


def rows(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_search_equals_brute_force(spark):
    rng = random.Random(2)
    vocab = ["the", "The", "a1", "été", "ÉTÉ", "日本", "x_y", "z", "\x7fq", "don't", "rare"]
    text = lambda n: " ".join(rng.choice(vocab[:3] if rng.random() < 0.5 else vocab) for _ in range(n))
    docs = [(i, text(rng.randint(0, 30))) for i in range(120)] + [(i, "the z rare") for i in range(200, 260)]
    docs += [(None, "the z rare"), (None, "rare"), (7, "rare rare"), (7, "rare rare"), (300, None), (301, ""), (302, " -- "),
             (303, "the " * 20000)]
    items = [(i, text(rng.randint(0, 12))) for i in range(14)] + [(1, "rare rare z"), (1, "rare rare z"), (None, "the z"),
                                                                 (50, None), (51, ""), (52, "nowhere")]
    d = spark.createDataFrame([(i, t, 5, 0, "q") for i, t in docs], "doc_id long, text string, n int, score int, item_id string")
    q = spark.createDataFrame([(i, t, 3, "r") for i, t in items], "item_id long, text string, doc_id int, rank string")
    for parts, block in ((1, 1 << 20), (7, 60)):
        got = search.search(d.repartition(parts), q, k=5, block_bytes=block)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert rows(got) == sorted(brute(docs, items, 5), key=str)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search.search(none, items).collect() == [] == search.search(some, items.limit(0)).collect()
    assert search.search(some.select("doc_id", search.F.lit(None).cast("string").alias("text")), items).collect() == []


def test_chunks_of_documents_and_postings(spark, monkeypatch):
    docs = [(i, " ".join(f"t{j}" for j in range(i % 17, i % 17 + i % 9))) for i in range(300)]
    items = [(i, f"t{i} t{i + 1} t{i} t3") for i in range(12)]
    index = search.Index([i for i, _ in items], [t for _, t in items])
    assert index.size.sum() == sum(len(set(t.split())) for _, t in items)
    best = search.Best(1, 3)
    best.add([5, 4, 3, 2, None], search.np.array([[2], [2], [2], [2], [2]]))
    best.add([1, 9], search.np.array([[2], [3]]))
    assert best.lists == [[(-3, False, 9), (-2, False, 1), (-2, False, 2)]]


def test_query_matches_its_sql(spark, sf001):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf001}/{t}.parquet')")
    want = con.sql(ORACLE_SQL["op11_ranked_search"]).project("item_id, rank, doc_id, score").fetchall()
    assert rows(QUERIES["op11_ranked_search"](spark, sf001)) == sorted(want, key=str) and len(want) > 300
