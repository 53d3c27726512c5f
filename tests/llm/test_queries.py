"""The registered queries themselves, on all columns their contracts name."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from facetspark.llm import pii
from facetspark.llm.queries import QUERIES, tokenizer
from tests.llm.test_near_dups import brute_components, brute_fingerprint
from tests.llm.test_texts import brute_pii
from tests.llm.test_tokens import ODD


@pytest.fixture(scope="module")
def documents(spark, sf001):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}


@pytest.fixture
def tables(spark, tmp_path):
    """Writes frames as the tables of a folder."""
    def write(**frames):
        for name, rows in frames.items():
            rows.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write


def personal(text):
    base = brute_pii(text or "")
    said = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
    return [*(sum(k == i for _, k, _ in base) for i in range(4)), hashlib.sha256(said.encode()).hexdigest()], base


def test_personal_data_of_the_query(spark, sf001, documents, tables):
    own = {1: "mail a.b@c.de or x@y.org, host 10.0.0.1, call +1 555 123 4567 or +44 20 7946 0958 or +49 30 1234567",
           2: None, 3: "", 4: "card 4111 1111 1111 1111 and 1.2.3.4 and 300.1.1.1", 5: "clean text"}
    folder = tables(documents=spark.createDataFrame(
        [(i, t, "en", "s", 0) for i, t in own.items()], "doc_id long, text string, lang string, source string, n_email int"))
    kinds = set()
    for at, texts in ((sf001, documents), (folder, own)):
        rows = QUERIES["op4_personal_data"](spark, at).collect()
        assert sorted(r.doc_id for r in rows) == sorted(texts)
        for r in rows:
            want, base = personal(texts[r.doc_id])
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256] == want
            assert {f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base} <= set(r.spans.split(",") if r.spans else [])
            kinds |= {tuple(want[:4])}
    assert (2, 1, 0, 3) in kinds and (0, 1, 1, 0) in kinds


SCHEMA = "doc_id long, text string, lang string, source string, ids int, taken int, fingerprint int, start int"


@pytest.fixture
def odd(spark, tables):
    """Nulls, empty and long texts, copies, extra columns named as results are."""
    own = dict(enumerate([*ODD, None, "one two", "One TWO", "w " * 20000]))
    rows = [(i, t, "en", ("b", "a", None)[i % 3], 1, 2, 3, 4) for i, t in own.items()]
    return tables(documents=spark.createDataFrame(rows, SCHEMA).repartition(3)), own


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_simhash_of_the_query(spark, sf001, documents, odd):
    for at, texts in ((sf001, documents), odd):
        ids = sorted(texts)
        fps = [brute_fingerprint_by_ascii(texts[i]) for i in ids]
        want = {i: (f"{f:016x}", c) for i, f, c in zip(ids, fps, brute_components(ids, fps, 2))}
        assert {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash"](spark, at).collect()} == want


def brute_fingerprint_by_ascii(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return brute_fingerprint(" ".join(words(lower)))


def plain_targets(totals):
    """Shares of 150 % by weight, none above twice its source, the excess shared again."""
    order = sorted(totals, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(totals.values())
    while open_:
        by = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / by > 2 * totals[s]}
        if not over:
            return target | {s: left * weight[s] / by for s in open_}
        target |= {s: 2.0 * totals[s] for s in over}
        left -= sum(2 * totals[s] for s in over)
        open_ -= over
    return target


def test_source_mix_of_the_query(spark, sf001, odd):
    for at in (sf001, odd[0]):
        docs = {r.doc_id: r for r in spark.read.parquet(f"{at}/documents.parquet").collect()}
        size = {i: len(words(r.text)) for i, r in docs.items()}
        total = {}
        for i, r in docs.items():
            total[r.source] = total.get(r.source, 0) + size[i]
        target, taken = plain_targets(total), dict.fromkeys(total, 0)
        got = QUERIES["op2_source_mix"](spark, at).collect()
        assert sorted(r.doc_id for r in got) == sorted(docs)
        for r in got:
            source = docs[r.doc_id].source
            assert (r.size, r.source_size) == (size[r.doc_id], total[source]) and 0 <= r.taken <= 2 * r.size
            assert r.target == pytest.approx(target[source])
            taken[source] += r.taken
        for s in total:  # blocks of 128 words, the rest of a shard drawn
            assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 40 * 128
        again = QUERIES["op2_source_mix"](spark, at).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_language_of_the_query(spark, sf001, documents, odd):
    rows = spark.read.parquet(f"{sf001}/documents.parquet").collect()
    lang = {r.doc_id: r.lang for r in rows}
    learned = {r.lang for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 != 1} - {None}
    got = QUERIES["op3_language"](spark, sf001).collect()
    assert sorted(r.doc_id for r in got) == sorted(documents)
    right = []
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        no_letter = not any(c.isalpha() for c in documents[r.doc_id] or "")
        assert r.lang_pred == "und" if no_letter else r.lang_pred in learned | {"und"}
        if r.held_out and lang[r.doc_id] is not None and not no_letter:
            right.append(r.lang_pred == lang[r.doc_id])
    assert len(right) > 10 and np.mean(right) > 0.95
    at, texts = odd
    got = {r.doc_id: r.lang_pred for r in QUERIES["op3_language"](spark, at).collect()}
    assert got.keys() == texts.keys()
    assert all(p == "und" for i, p in got.items() if not any(c.isalpha() for c in texts[i] or ""))


def test_word_tokens_of_the_query(spark, sf001, documents, odd):
    t = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    for at, texts in ((sf001, documents), odd):
        want = {}
        for i, x in texts.items():
            ids = t.encode(x or "", add_special_tokens=False).ids
            want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        got = QUERIES["op7_word_bpe"](spark, at).collect()
        assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(want)


def test_token_files_of_the_query(spark, sf001, documents, odd):
    t = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    for at, texts in ((sf001, documents), odd):
        want, start = {}, 0
        for i in sorted(texts):
            ids = np.array([*t.encode(texts[i] or "", add_special_tokens=False).ids, 2], dtype="<u4")
            want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
            start += len(ids)
        got = QUERIES["op9_token_files"](spark, at).collect()
        assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == want and len(got) == len(want)


def test_main_text_of_the_query(spark, sf001, tables):
    page = ("<html><head><title>t</title><style>p{}</style></head><body class='has-sidebar'><nav><a>Home</a></nav>"
            "<article><h1>On &lt;%d&gt;</h1><p>First\n part &amp; <b>bold</b>%d.</p><aside>see also</aside><script>var x</script>"
            "<p>Second.</p><form><input>send</form><div class='comments'><p>nice</p></div></article><footer>f</footer>")
    rows = [(i, f"http://h{i % 2}.org/{i}", page % (i, i), 1, "t") for i in range(6)]
    rows += [(7, None, None, 1, None), (8, "http://e.org", "", 1, None), (9, "http://p.org", "<p>a  b</p> c\u00e9", 1, "")]
    at = tables(pages=spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int, text string"))
    want = {i: f"On <{i}>\n\nFirst part & bold{i}.\n\nSecond." for i in range(6)} | {7: "", 8: "", 9: "a b\n\nc\u00e9"}
    got = {r.page_id: r for r in QUERIES["op10_host_text"](spark, at).collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) and r.url == dict((x[0], x[1]) for x in rows)[i] for i, r in got.items())
    given = {r.page_id: r.url for r in spark.read.parquet(f"{sf001}/pages.parquet").collect()}
    got = QUERIES["op10_host_text"](spark, sf001).collect()
    assert {r.page_id: r.url for r in got} == given and all(r.text and r.n_chars == len(r.text) for r in got)
