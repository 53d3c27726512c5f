import numpy as np
import xxhash

from facetspark.llm import cosine, simhash
from facetspark.llm.common import connected_components, join_hubs, min_labels


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, bits):
    a, b = [], []
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a.append(j)
                b.append(i)
    label = min_labels(len(fps), np.array(a, int), np.array(b, int))
    least = {}
    for i, x in zip(ids, label):
        least[x] = min(least.get(x, i), i)
    return [least[x] for x in label]


def test_simhash_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in rng.integers(0, 400, 300)]
    texts = [None, "", " \n", "One two", "one TWO", "x", "É é a b c", "x " * 3000]
    for k in range(60):
        w = list(base)
        for _ in range(k % 6):
            w[int(rng.integers(0, 300))] = "z"
        texts.append(" ".join(w))
    texts += [" ".join(f"u{x}" for x in rng.integers(0, 9999, 50)) for _ in range(60)]
    rows = [(i, t, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    for leaf in (4, 1024):  # a small leaf forces the hot-group cuts
        got = {r.doc_id: r for r in simhash.simhash_components(df, leaf=leaf).collect()}
        fps = [brute_fingerprint(t) for t in texts]
        assert [got[i].fingerprint for i in range(len(rows))] == [f"{f:016x}" for f in fps]
        assert [got[i].component_id for i in range(len(rows))] == brute_components(range(len(rows)), fps, 2)


def test_simhash_search_on_dense_fingerprints(spark):
    rng = np.random.default_rng(6)
    centre = int(rng.integers(0, 1 << 62))
    fps = sorted({centre ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 7)), replace=False))
                  for _ in range(500)})
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    links = simhash.fingerprint_links(df, 2, leaf=8)
    root = {r.node: r.root for r in connected_components(links).collect()}
    want = brute_components(range(len(fps)), fps, 2)
    groups = {}
    for f, w in zip(fps, want):
        groups.setdefault(w, set()).add(root.get(simhash._signed(f), simhash._signed(f)))
    assert all(len(g) == 1 for g in groups.values()) and len({*map(min, groups.values())}) == len(groups)


def test_simhash_edge_rows(spark):
    schema = "doc_id long, text string"
    assert simhash.simhash_components(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, None)], schema)
    got = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.simhash_components(df).collect())
    assert got == [("7", "7"), ("7", "7"), ("None", "7"), ("None", "None")]
    assert simhash.simhash_dedup(df).where("doc_id is not null").count() == 1


def test_dedup_with_repeated_ids(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(7, a, 1), (7, b, 2), (9, a, 3), (9, "c d e f g", 4), (3, "x y z u v", 5), (8, "x y z u v", 6), (8, b, 7)]
    df = spark.createDataFrame(rows * 2, "doc_id long, text string, n int")
    got = simhash.simhash_dedup(df.repartition(3)).collect()
    assert sorted((r.doc_id, r.n) for r in got) == [(3, 5), (7, 1), (7, 2), (9, 4)]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(5, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_components_and_joins_with_hubs(spark):
    rng = np.random.default_rng(4)
    a = np.concatenate([rng.integers(0, 400, 120), np.full(300, 1), np.full(200, 399), rng.integers(400, 410, 5)])
    b = np.concatenate([rng.integers(0, 400, 120), rng.integers(0, 399, 300), rng.integers(200, 410, 200), np.full(5, 405)])
    links = spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a long, b long")
    nodes = sorted({int(x) for p, q in zip(a, b) if p != q for x in (p, q)})
    label = min_labels(410, a, b)
    for hub_rows in (2, 10_000):
        got = {r.node: r.root for r in connected_components(links, hub_rows=hub_rows).collect()}
        assert got == {n: int(label[n]) for n in nodes}
    rows = spark.createDataFrame([(k, i) for i, k in enumerate([5] * 300 + [6, 7, None])], "k long, i long")
    per = spark.createDataFrame([(5, "five"), (7, "seven"), (8, "eight")], "k long, name string")
    for most in (300, 2):
        got = join_hubs(rows, per, ["k"], ["i"], most, hub_rows=10).select("k", "i", "name").collect()
        assert sorted(map(tuple, got)) == [*((5, i, "five") for i in range(300)), (7, 301, "seven")]


def test_hubs_of_the_operators(spark, monkeypatch):
    monkeypatch.setattr(simhash, "join_hubs", lambda *a: join_hubs(*a, hub_rows=3))
    monkeypatch.setattr(cosine, "join_hubs", lambda *a: join_hubs(*a, hub_rows=3))
    docs = spark.createDataFrame([(i, "same words in all of these rows") for i in range(40)] + [(None, None), (99, "x")],
                                 "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.simhash_components(docs).collect()}
    assert got == {**{i: 0 for i in range(40)}, None: None, 99: 99}
    vectors = spark.createDataFrame([(i, [1.0, 2.0, float(i % 7) / 50]) for i in range(40)] + [(50, [-1.0, 2.0, 0.0])],
                                    "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in cosine.embedding_components(vectors).collect()}
    assert got == {**{i: (39, 0) for i in range(40)}, 50: (0, 50)}


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(60, 24))
    near = x[:30] + 0.25 * rng.normal(size=(30, 24))
    vectors = [*x.tolist(), *near.tolist(), *x[:3].tolist() * 4, None, [], [0.0] * 24, [float("nan")] * 24,
               [None] + [1.0] * 23, [float("inf")] * 24, [1.0, 2.0]]
    rows = [(i, v, 3) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, kept int")
    good = [i for i, v in enumerate(vectors) if v and len(v) == 24 and all(
        c is not None and np.isfinite(c) for c in v) and any(v)]
    u = np.array([vectors[i] for i in good])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(u @ u.T >= 0.9, 1))
    label = min_labels(len(good), a, b)
    degree = np.bincount(a, minlength=len(good)) + np.bincount(b, minlength=len(good))
    want = {i: (0, i) for i in range(len(rows))}
    want |= {i: (int(degree[k]), good[label[k]]) for k, i in enumerate(good)}
    for block in (5, 1000):  # small parts force the hot-bucket cuts
        got = cosine.embedding_components(df, block=block, tables=16, probes=3).collect()
        assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_ways_of_comparing_embeddings_agree(spark):
    # pairs named or groups compared whole, hot buckets broadcast or joined, vectors of several lengths
    rng = np.random.default_rng(17)
    rows = []
    for dim, n in ((16, 90), (2, 30), (1, 12), (8194, 3)):
        centre = rng.normal(size=(3, dim))
        rows += (centre[rng.integers(0, 3, n)] + 0.3 * rng.normal(size=(n, dim))).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    want, a, b = {}, [], []
    for i, v in enumerate(rows):
        for j in range(i):
            if len(rows[j]) == len(v) and np.dot(v, rows[j]) / np.linalg.norm(v) / np.linalg.norm(rows[j]) >= 0.9:
                a.append(j)
                b.append(i)
    label, degree = min_labels(len(rows), np.array(a), np.array(b)), np.bincount(a + b, minlength=len(rows))
    want = {i: (int(degree[i]), int(label[i])) for i in range(len(rows))}
    for more in ({"dense": 0}, {"dense": 1000}, {"dense": 1, "block": 7}, {"block": 7, "hot_broadcast": 0}):
        got = cosine.embedding_components(df, tables=16, probes=3, **more).collect()
        assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want, more


def test_sketches_keep_pairs_at_the_threshold():
    rng = np.random.default_rng(18)
    for dim in (2, 16, 64):
        x = cosine.unit(rng.normal(size=(4000, dim)))
        z = rng.normal(size=x.shape)
        z = cosine.unit(z - (z * x).sum(axis=1, keepdims=True) * x)
        y = 0.9 * x + np.sqrt(1 - 0.81) * z
        near = cosine.sketches_near(cosine.sketch(x, 42), cosine.sketch(y, 42), cosine.sketch_limit(0.9))
        assert near.mean() > 0.999
    far = cosine.sketches_near(cosine.sketch(x, 42), cosine.sketch(x[::-1].copy(), 42), cosine.sketch_limit(0.9))
    assert far.mean() < 0.01


def test_cross_polytope_recall_at_the_threshold():
    rng = np.random.default_rng(8)
    x = cosine.unit(rng.normal(size=(3000, 64)))
    z = rng.normal(size=x.shape)
    z = cosine.unit(z - (z * x).sum(axis=1, keepdims=True) * x)
    y = 0.9 * x + np.sqrt(1 - 0.81) * z
    hit = np.zeros(len(x), dtype=bool)
    for t in range(cosine.TABLES):
        p, q = (cosine.buckets(v, t, cosine.HASHES, cosine.PROBES, 42) for v in (x, y))
        hit |= (p[:, :, None] == q[:, None, :]).any(axis=(1, 2))
    assert hit.mean() > 0.995
