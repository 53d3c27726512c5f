import collections
import hashlib

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from facetspark.llm import alignment
from facetspark.llm.bpe import read_spec
from facetspark.llm.queries import QUERIES, tokenizer
from tests.llm.test_tokens import ODD, texts

MORE = ["▁x y", "a▁ b", "a ▁b", "<s>x</s> <unk> <0x0A>", "www. a.b c., d", "x\r\ny \r z", "\n\n a", " \n.", "\n.", "e.\nf,", ", .",
        "a\t b", "\x00", "no break 　wide x", "日本語 のテキスト。", "  two  spaces  ", "\r", "x\n", "\nx", "é́ ﬁ"]


def brute(every):
    """The figures of all documents, from the libraries on whole texts."""
    a = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    byte = alignment.byte_tokens(read_spec(tokenizer("byte_bpe_50k.json")))
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    docs, counts = {}, collections.Counter()
    for k, t in every.items():
        x = a.encode(" " + (t or ""), add_special_tokens=False).ids
        y = b.encode(t or "")
        if not t or any(b"".join(z) != (" " + t).encode() for z in ([byte[i] for i in x], [piece(i) for i in y])):
            x, y = [], []
        ends = []
        for z in ([byte[i] for i in x], [piece(i) for i in y]):
            at, e = 0, []
            for w in z:
                at += len(w)
                e.append(at)
            ends.append(e)
        links = [(i, j) for i, e in zip(x, ends[0]) for j, f in zip(y, ends[1]) if e == f] if len(x) < 3000 else [
            (x[ends[0].index(e)], y[ends[1].index(e)]) for e in sorted(set(ends[0]) & set(ends[1]))]
        groups, last = [], 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            groups.append("|".join(",".join(str(i) for i, f in zip(ids, en) if last < f <= e) for ids, en in zip((x, y), ends)))
            last = e
        docs[k] = (len(x), len(y), groups, links)
        counts.update(links)
    high = collections.Counter()
    for (_, j), n in counts.items():
        high[j] = max(high[j], n)
    return {k: (na, nb, len(g), len(ln), sum(counts[p] == high[p[1]] for p in ln), sum(counts[p] for p in ln), ";".join(g))
            for k, (na, nb, g, ln) in docs.items()}


@pytest.fixture(scope="module")
def every(spark, sf001):
    some = [t for t in texts(spark, sf001) if len(t) < 4000][:90] + ODD + MORE
    return {**dict(enumerate(some)), -1: None, -2: some[50], -3: some[50]}


def frame(spark, every):
    return spark.createDataFrame([(k, t, 1, "n", 0) for k, t in every.items()],
                                 "doc_id long, text string, a int, groups string, id int")


def rows(df):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in df.collect()}


@pytest.mark.parametrize("block_pairs", [2_000_000, 700])
def test_alignment_equals_brute_force(spark, every, block_pairs):
    paths = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
    got = rows(alignment.aligned_documents(frame(spark, every), *paths, block_pairs=block_pairs))
    want = brute(every)
    assert set(got) == set(want)
    for k in want:
        assert got[k] == want[k], (k, (every[k] or "")[:60])
    assert sum(w[0] == 0 for w in want.values()) > 4


def test_no_rows_and_rows_without_ids(spark, every):
    paths = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.aligned_documents(none, *paths).collect() == []
    df = spark.createDataFrame([(None, "one two"), (None, "one two"), (1, None), (1, "one")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_links, r.n_best, r.count_sum) for r in alignment.aligned_documents(df, *paths).collect())
    assert got == [(0, 2, 2, 5), (0, 2, 2, 5), (1, 0, 0, 0), (1, 1, 1, 3)]


def test_query(spark, tmp_path, every):
    frame(spark, every).write.parquet(f"{tmp_path}/documents.parquet")
    want = {k: (*w[:6], hashlib.sha256(w[6].encode()).hexdigest() if w[6] else "") for k, w in brute(every).items()}
    df = QUERIES["op12_token_alignment"](spark, str(tmp_path))
    assert set(df.columns) >= {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}
    assert rows(df.withColumnRenamed("groups_sha256", "groups")) == want


def test_a_model_with_pieces_across_cuts_is_not_cut(spark):
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        p = alignment.Pieces(f.read())
    assert p.cuts
    data, at = alignment.joined(["a b", "c"], " ")
    start, end = alignment.pieces(data, at)
    cut = p.encode(["a b", "c"], data, at, start, end)
    p.cuts = False
    whole = p.encode(["a b", "c"], data, at, start, end)
    assert all((x == y).all() for x, y in zip(cut, whole))
