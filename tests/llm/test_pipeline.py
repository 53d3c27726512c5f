from tokenizers import Tokenizer

import corpus_pipeline
from facetspark.llm.queries import ORACLE_SQL, QUERIES, tokenizer
from tests.llm.test_near_dups import brute_components, brute_fingerprint
from tests.llm.test_texts import brute_pii, brute_repeat


def test_stages_take_effect(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    names = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}

    one = corpus_pipeline.quality_stage(spark, docs, sf001)
    kept = {r.doc_id for r in one.collect()}
    for i, r in rows.items():
        words = (r.text or "").encode().split()
        cover, longest = brute_repeat(words, 8) if len(words) < 400 else (None, None)
        if cover is not None:
            good = len(words) >= 20 and 100 * cover <= 30 * len(words) and (longest <= 50 or 100 * longest <= 20 * len(words))
            assert (i in kept) == good
    two = corpus_pipeline.simhash_stage(spark, one, sf001)
    ids = sorted(kept)
    comp = brute_components(ids, [brute_fingerprint(rows[i].text) for i in ids], 2)
    assert sorted(r.doc_id for r in two.collect()) == sorted(set(comp))
    three = corpus_pipeline.personal_data_stage(spark, two, sf001)
    for r in three.collect():
        base = brute_pii(rows[r.doc_id].text)
        assert all(rows[r.doc_id].text[s:e] not in r.text for s, _, e in base) and r.n_chars == len(r.text)
    four = corpus_pipeline.mixing_stage(spark, three, sf001)
    sizes = {r.doc_id: len(r.text.encode().split()) for r in three.collect()}
    used = {}
    for r in four.collect():
        used[r.doc_id] = used.get(r.doc_id, 0) + len(r.text.split(" "))
    assert all(n <= 2 * sizes[i] for i, n in used.items())
    assert abs(sum(used.values()) - 1.5 * sum(sizes.values())) < 128 * 25
    assert one.columns == two.columns == three.columns == four.columns == names


def test_run_equals_the_library_on_its_texts(spark, sf001):
    t = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    got = corpus_pipeline.run(spark, sf001).collect()
    assert got and all(r.n_tokens == len(r.ids) and r.decoded == t.decode(r.ids, skip_special_tokens=False) for r in got)


def test_empty_documents(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf001)
        assert out.count() == 0


def test_odd_documents_through_all_stages(spark, sf001):
    """Null ids, sources and texts, copies with one id, a very long text and columns named as the stages' own."""
    def text(k, n=60):
        return " ".join(f"w{k}x{i}" for i in range(n))

    mail = text(1) + " write to ann.lee@mail.example.org or 10.1.2.3 now"
    rows = [(1, mail, "a"), (1, mail, "a"), (2, mail, "b"), (3, text(3), None), (None, text(4), "b"), (None, None, None),
            (5, "", "a"), (6, "too short", "a"), (7, "same words again " * 40, "b"), (8, text(8, 60_000), "a"), (9, text(3), None)]
    schema = ("doc_id long, text string, lang string, source string, n_chars long, kept string, n_words string, "
              "fingerprint int, component_id string, spans string, base int, taken int, __size int, decoded int, ids string")
    docs = spark.createDataFrame([(i, t, None, s, -1, "k", "n", 1, "c", "s", 2, 3, 4, 5, "i") for i, t, s in rows], schema)
    names, out = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf001).collect(), docs.schema) if len(out) < 4 else stage(
            spark, docs, sf001)
        out[name] = docs.collect()
    assert all(list(r[0].asDict()) == names for r in list(out.values())[:4])
    assert sorted((str(r.doc_id), len(r.text)) for r in out["quality rules"]) == sorted(
        (str(i), len(t)) for i, t, _ in rows if i not in (5, 6, 7) and t)
    assert sorted(str(r.doc_id) for r in out["simhash near-dedup"]) == ["1", "3", "8", "None"]
    private = {r.doc_id: r for r in out["personal data"]}
    assert "ann.lee" not in private[1].text and "10.1.2.3" not in private[1].text and private[1].text.startswith(text(1))
    assert all(private[i].text == t and private[i].n_chars == len(t) for i, t in ((3, text(3)), (8, text(8, 60_000))))
    mixed = [w for r in out["source mixing"] for w in r.text.split(" ")]
    assert set(mixed) <= {w for r in private.values() for w in r.text.split(" ")}
    assert max(mixed.count(w) for w in mixed[:20]) <= 2 and {r.kept for r in out["source mixing"]} == {"k"}
    t = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    want = sorted(t.encode(r.text, add_special_tokens=False).ids for r in out["source mixing"])
    assert sorted(r.ids for r in out["bpe encoding"]) == want and want
    assert all(r.decoded == t.decode(r.ids, skip_special_tokens=False) for r in out["bpe encoding"])


def test_registered():
    assert {int(k[2:].split("_")[0]) for k in QUERIES if k != "pipeline"} == set(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES) and len(corpus_pipeline.STAGES) == 5
