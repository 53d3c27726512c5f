import zlib

import numpy as np
from tokenizers import Tokenizer

from facetspark.llm import bpe, tokenfiles
from facetspark.llm.pieces import Table
from facetspark.llm.queries import tokenizer

ODD = ["", "  a  b \n\n c\t d ", "It's <|endoftext|> x<|startoftext|>y we'll 'S", "ÀÉ Σας ΟΔΟΣ İstanbul ½ ² Ⅷ 12 日本 한국 🙂👍🏽",
       "a" * 5000, "ab" * 3000, " x　y​ z\x85w\x1cq", "!!!???...''s", "don't I'LL.", "ﬁ ǅ ß", "thth, " * 50,
       "\x00\x01 \U0010ffff", " leading", "trail ", "a \n b.", "one.\nTwo,\n\nthree. four..", ".", "x.", "é. é, a."]


def texts(spark, sf001):
    return ODD + [r.text or "" for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()]


def test_automaton_equals_the_library(spark, sf001):
    path = tokenizer("word_bpe_49k.json")
    want = Tokenizer.from_file(path)
    t = texts(spark, sf001)
    df = spark.createDataFrame([(i, x, "c") for i, x in enumerate(t)] + [(-1, None, "c")], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(df, path), path).collect()}
    for i, x in enumerate(t):
        ids = want.encode(x, add_special_tokens=False).ids
        assert got[i].ids == ids and got[i].decoded == want.decode(ids, skip_special_tokens=False)
    assert got[-1].ids == [] and got[-1].decoded == ""


def test_automaton_of_a_small_vocabulary():
    merges = [("a", "b"), ("ab", "a"), ("b", "a"), ("a", "a"), ("aa", "ab"), ("ba", "ba")]
    vocab = {t: i for i, t in enumerate(["a", "b", *["".join(m) for m in merges]])}
    auto = bpe.Automaton(vocab, merges, "")

    def plain(word):
        parts = list(word)
        while True:
            ranks = [(merges.index((x, y)), i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if (x, y) in merges]
            if not ranks:
                return [vocab[p] for p in parts]
            i = min(ranks)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    for n in range(1, 11):
        for k in range(1 << n):
            word = "".join("ab"[k >> i & 1] for i in range(n))
            assert auto.path(word) == plain(word)


def test_blocks_round_trip():
    rng = np.random.default_rng(4)
    for _ in range(25):
        n = int(rng.integers(1, 9000))
        ids = (rng.pareto(1.0, n) * rng.integers(1, 4000)).clip(0, 2**32 - 1).astype(np.uint32)
        data = tokenfiles.pack(ids, int(rng.integers(1, 3000)), float(rng.random()))
        a, b = sorted(rng.integers(0, n + 1, 2).tolist())
        assert (tokenfiles.unpack(data) == ids).all() and (tokenfiles.unpack(data, a, b) == ids[a:b]).all()


def test_token_files(spark, sf001):
    path = tokenizer("byte_bpe_50k.json")
    want = Tokenizer.from_file(path)
    t = texts(spark, sf001)
    rows = [(len(t) - i, x) for i, x in enumerate(t)] + [(None, "n"), (5, None), (5, "dup")]
    got = tokenfiles.token_documents(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    start, expected = 0, []
    for i, x in order:
        ids = np.array([*want.encode(x or "", add_special_tokens=False).ids, 2], dtype="<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected
    none = spark.createDataFrame([], "doc_id long, text string")
    assert tokenfiles.token_documents(none, path).count() == 0


def test_word_table_keeps_no_wrong_span():
    table, data = Table(), b"aa bb aa cc " + b"x" * 100 + b" bb"
    start = np.array([0, 3, 6, 9, 12, 113])
    end = np.array([2, 5, 8, 11, 112, 115])
    asked = []

    def values(spans):
        asked.append(sorted(spans))
        return [np.array([len(s), s[0]], dtype="<u4") for s in spans]

    for _ in range(2):
        got, n = table.numbers(data, start, end, values)
        assert got.reshape(-1, 2)[:, 1].tolist() == [97, 98, 97, 99, 120, 98] and n.tolist() == [2] * 6
    assert asked == [[b"aa", b"bb", b"cc", b"x" * 100], [b"x" * 100]]
