import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from facetspark.llm import common, hosttext, langid, mixing, pii, preference, quality

DOCS = "doc_id long, text string, source string"


def brute_repeat(words, window):
    n, cover, longest = len(words), set(), 0
    at = {}
    for i in range(n - window + 1):
        at.setdefault(tuple(words[i:i + window]), []).append(i)
    for p in at.values():
        if len(p) > 1:
            cover |= {k for i in p for k in range(i, i + window)}
    for size in range(1, n):
        c = Counter(tuple(words[i:i + size]) for i in range(n - size + 1))
        if max(c.values()) < 2:
            break
        longest = size
    return len(cover), longest


def test_repetition_matches_brute_force():
    rng = np.random.default_rng(1)
    texts = [" ".join(map(str, rng.integers(0, k, n))) for k in (1, 2, 3, 30) for n in (0, 1, 2, 9, 40, 77)]
    got = quality.repetition([t.encode() for t in texts], 8)
    for t, r in zip(texts, got.itertuples()):
        assert (r.n_words, r.n_repeat_words, r.longest_repeat) == (len(t.split()), *brute_repeat(t.split(), 8))


def test_quality_rules_edges(spark):
    long_ = " ".join(f"w{i}" for i in range(5000))
    rows = [(1, None), (2, ""), (3, "a\n\na\n a \na"), (4, long_), (5, long_ + " " + long_), (6, "é#*< x"), (4, long_)]
    df = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, kept boolean")
    got = {r.doc_id: r for r in quality.quality_rules(df).collect()}
    assert [got[i].kept for i in (1, 2, 3, 4, 5)] == [False, False, False, True, False]
    assert got[3].n_dup_lines == 2 and got[5].longest_repeat == 5000 and got[6].word_chars == 6
    assert got[6].n_symbols == 3 and quality.quality_rules(df.limit(0)).count() == 0


def test_targets_by_hand():
    got = mixing.targets([("b", 100), ("a", 10), (None, 50)], [3, 1, 2], 1.5, 2)
    # 240 words: a stops at 20, b and null share 220 by 1:2, null stops at 100, b gets the rest
    assert got == [("a", 10, 20.0), ("b", 100, 120.0), (None, 50, 100.0)]


def test_permutation_is_one():
    for n in (1, 2, 5, 64, 1000):
        i = np.arange(n)
        image = mixing.permuted(i, np.full(n, n), np.full(n, 99))
        assert sorted(image.tolist()) == i.tolist()


def test_mix(spark):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 200))), "abc"[i % 3] if i % 5 else None) for i in range(400)]
    rows += [(None, "x y", "a"), (3, None, "b"), (3, rows[3][1], rows[3][2])]
    df = spark.createDataFrame(rows, DOCS)
    got = mixing.taken(mixing.mix(df, block_words=16)).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r["__size"] for r in got)
    for s in (None, "a", "b", "c"):
        part = [r for r in got if r["__source"] == s]
        assert sum(r.taken for r in part) == pytest.approx(part[0]["__target"], abs=64)
    key = lambda r: (str(r["__id"]), r["__size"], r.taken)
    assert sorted(map(key, got)) == sorted(map(key, mixing.taken(mixing.mix(df, block_words=16)).collect()))
    assert mixing.taken(mixing.mix(df.limit(0))).count() == 0


def test_running_sums_in_three_levels(spark, monkeypatch):
    monkeypatch.setattr(common, "FAN", 4)
    rows = [("ab"[i % 3 > 0], i, i * 7 % 5) for i in range(300)] + [(None, 1, 2), (None, 2, 3)]
    df = spark.createDataFrame(rows, "k string, i long, n long")
    want, total = {}, Counter()
    for k, i, n in sorted(rows, key=lambda r: r[1]):
        want[k, i], total[k] = total[k], total[k] + n
    for levels in (2, 3, 4):
        got = common.running_start(df, ["k"], F.floor(F.col("i") / 3), [F.col("i")], "n", "at", levels).collect()
        assert {(r.k, r.i): r["at"] for r in got} == want


def test_too_many_sources_are_an_error(spark):
    df = spark.createDataFrame([(i, "a b", f"s{i}") for i in range(5)], DOCS)
    with pytest.raises(ValueError, match="sources"):
        mixing.mix(df, max_sources=4)


def test_mixed_texts_hold_the_words_taken(spark):
    rows = [(i, "  " + " ".join(f"d{i}w{k}" for k in range(i * 7 % 90)), "ab"[i % 2]) for i in range(80)]
    df = spark.createDataFrame(rows, DOCS)
    plan = mixing.mix(df, block_words=16)
    want = {r["__id"]: r.taken for r in mixing.taken(plan).collect()}
    words = Counter()
    for r in mixing.mixed_documents(df, plan).collect():
        part = r.text.split(" ")
        assert all(w.startswith(f"d{r.doc_id}w") for w in part) and len(set(part)) == len(part)
        words[r.doc_id] += len(part)
    assert {i: n for i, n in want.items() if n} == dict(words)
    blocks = mixing.mixed_blocks(df, plan).collect()
    assert sum(len(b.words) for b in blocks) == sum(want.values()) and max(len(b.words) for b in blocks) == 16


def test_language_held_out_accuracy(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    model = langid.train(docs.where(crc % 3 != 1), "text", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(2**32)))
    held = langid.identify(docs.where(crc % 3 == 1).where("lang is not null"), model).collect()
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95 and all(0 <= r.score <= 1 for r in held)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "the " * 50000)], "doc_id long, text string")
    assert [r.lang_pred for r in langid.identify(odd, model).orderBy("doc_id").collect()][:3] == ["und"] * 3
    none = langid.train(docs.limit(0), "text", "lang", F.lit(0))
    assert none is None and {r.lang_pred for r in langid.identify(odd, none).collect()} == {"und"}


def test_codewords_differ():
    for n in (1, 2, 4, 7, 12):
        code = langid.codewords(n)
        assert len({tuple(c) for c in code.tolist()}) == n


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute_pii(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for pattern, kind in ((r"[0-9]([\x20-]?[0-9])+", 2), (r"\+[0-9][\x20().0-9-]+[0-9]", 3)):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m[0])
            if kind == 2 and 14 <= len(d) <= 19 and luhn(d) or kind == 3 and 10 <= len(d) <= 15:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_personal_data_matches_brute_force(spark, sf001):
    odd = [None, "", "a.b@c.d%x@y.z", "1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.4", "🙂 x@y.co 4111 1111 1111 1111",
           "+1 (658) 555-4270+44 20 7946 0958 +1", "9" * 20000 + " " + "a" * 20000 + "@", "a@b" + ".c" * 9000,
           "1-" * 9000 + "1", "+1" + " " * 9000 + "2345678901", "card 4111 1111 1111 1112, call 555-123-4567"]
    texts = odd + [r.text for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, spans int")
    for r in pii.find_personal_data(df).collect():
        base = [tuple(s) for s in r.base]
        assert base == brute_pii(texts[r.doc_id] or "")
        assert set(base) <= {tuple(s) for s in r.found}
    assert pii.find_personal_data(df.limit(0)).count() == 0


def test_redaction(spark):
    df = spark.createDataFrame([(1, "mail x@y.co now 🙂 1.2.3.4"), (2, None), (3, "clean")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert got == {1: "mail <EMAIL> now 🙂 <IP>", 2: None, 3: "clean"}


def test_preference_pairs(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "user", "q"), (1, 3, "assistant", "éa"),
             (2, 0, "user", "only"), (3, 1, "assistant", None), (3, 0, None, "x"), (None, 0, "user", "lost"),
             (4, 0, "assistant", "s"), (4, 1, "assistant", "s")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    done = preference.format_pairs(preference.reply_pairs(preference.conversations(df)))
    got = {r.conv_id: r for r in done.collect()}
    assert set(got) == {1, 3, 4}
    r = got[1]
    assert r.n_prompt_turns == 3 and r.prompt.startswith("<|im_start|>user\nhi<|im_end|>\n")
    assert [r.chosen_text[m.start:m.end] for m in r.chosen_mask] == ["éa<|im_end|>\n"]
    assert [r.rejected_text[m.start:m.end] for m in r.rejected_mask] == ["yo<|im_end|>\n"]
    assert got[3].n_prompt_turns == 2 and got[3].chosen_text == ""
    assert got[4].n_prompt_turns == 2 and got[4].chosen_text == got[4].rejected_text == ""
    assert preference.format_pairs(preference.reply_pairs(preference.conversations(df.limit(0)))).count() == 0


def test_conversations_without_a_reply(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "system", "b"), (2, 0, "user", "q"), (2, 1, "assistant", "r")],
                               "conv_id long, turn long, role string, text string")
    pairs = preference.reply_pairs(preference.conversations(df), replyless=True)
    got = {r.conv_id: r for r in preference.format_pairs(pairs).collect()}
    assert set(got) == {1, 2} and got[2].chosen_text and got[1].n_prompt_turns == 2
    assert got[1].prompt == "<|im_start|>user\na<|im_end|>\n<|im_start|>system\nb<|im_end|>\n"
    assert got[1].chosen_text == got[1].rejected_text == "" and got[1].chosen_mask == got[1].rejected_mask == []


def test_blocks_of_a_messy_page():
    page = ('<title>t</title><div id=nav><li>A<li>B</div><article><h1>T &amp;\n u</h1><p>One <b>two<br>three</p> '
            '<span class="ad">buy</span> tail<p>4 &lt;<script>if(a<b){"</p>"}</script> five<aside>no</aside>'
            '<div class="comments"><p>c</div><form>f</form></article><footer>z')
    got = hosttext.blocks(page)
    assert [t for k, t in got if k == "inner"] == ["T & u", "One two three", "tail", "4 < five"]


def test_marks_around_an_article_do_not_empty_the_page():
    for page in ('<body class="has-sidebar"><article><p>a b</article>', '<div class="content with-sidebar"><article>a b</article></div>',
                 '<article class="post comments-open"><p>a b</article>', '<body class="sidebar"><main>a b</main>',
                 '<div class="sidebar-layout"><div id=widget><article>a b</article></div><p>c</div>',
                 '<div class="no-comments"><article><p>a b</p><div class="comments"><p>c</div></article></div>',
                 '<article>a b</article><ol class="comments"><li><article>c d</article></ol>'):
        assert [t for k, t in hosttext.blocks(page) if k == "inner"] == ["a b"]
    assert [k for k, _ in hosttext.blocks('<div class="left-sidebar">x</div><div class="sidebar-open">y</div>')] == ["never", "open"]


def test_host_strings_and_edges(spark):
    frame = "<body><ul><li>Home page</li><li>About us now</li></ul><p>%s</p><div>All rights are reserved here</div>"
    rows = [(i, f"http://h.com/{i}", frame % f"p{i} q{i} r{i} s{i}", 1) for i in range(6)]
    rows += [(9, None, None, 1), (10, None, "", 1), (None, "x", "<p>alone</p>", 1), (11, "http://o.com", "<p>x " * 9999, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    for chunk in (128, 3):
        got = {r.page_id: r.text for r in hosttext.main_text(df, chunk_pages=chunk).collect()}
        assert [got[i] for i in range(6)] == [f"p{i} q{i} r{i} s{i}" for i in range(6)]
        assert got[9] == got[10] == "" and got[None] == "alone" and len(got[11].split("\n\n")) == 9999


def test_mixed_documents_without_ids(spark):
    texts = [" ".join(f"{a}{i}" for i in range(40)) for a in "abcdef"]
    rows = [(None, t, s, {"k": t[:1]}) for t, s in zip(texts, "xyxyxy")] + [(None, texts[0], "x", {"k": "a"})] * 2
    rows += [(7, texts[1], "x", None), (7, texts[2], "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, more map<string,string>")
    plan = mixing.mix(df, block_words=16)
    got = mixing.mixed_documents(df, plan).collect()
    used, want = Counter(), Counter()
    for r in got:
        used[r.doc_id, r.source, r.text.split()[0][0]] += len(r.text.split())
        assert {w[0] for w in r.text.split()} == {r.text[0]} and (not r.more or r.more["k"] == r.text[0])
        assert len(set(r.text.split())) == len(r.text.split())  # a pass takes a word once
    copies = Counter((i, s, t[0]) for i, t, s, _ in rows)
    assert set(used) == set(copies) and all(n <= 2 * 40 * copies[k] for k, n in used.items())
    for r in mixing.taken(plan).collect():
        want[r["__id"], r["__source"]] += r.taken
    by = Counter()
    for (i, s, _), n in used.items():
        by[i, s] += n
    assert by == want


def test_short_phrases_stay_in_sentences(spark):
    long = " ".join(f"w{i}" for i in range(25))
    rows = [(i, f"http://h.com/{i}", f"<ul><li>Home<li>About our site</ul><p>a{i} at the end of the day b{i}</p>"
             f"<h2>Summary</h2><p>c{i} {long} d{i}") for i in range(3)]
    got = hosttext.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {
        i: f"a{i} at the end of the day b{i}\n\nSummary\n\nc{i} d{i}" for i in range(3)}


def test_repeats_are_found_across_chunks(spark):
    long = " ".join(f"w{i}" for i in range(22))
    rows = [(i, f"http://h.com/{i}", f"<p>a{i} b{i}</p>" + ("<ul><li>One menu<li>of few pages</ul>" if i in (3, 40) else "")
             + (f"<p>c{i} {long} d{i}" if i in (5, 77) else "")) for i in range(90)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [{r.page_id: r.text for r in hosttext.main_text(df, chunk_pages=n).collect()} for n in (128, 2)]
    assert got[0] == got[1] == {i: f"a{i} b{i}" + (f"\n\nc{i} d{i}" if i in (5, 77) else "") for i in range(90)}


def test_host_repeats_decide_inside_articles(spark):
    page = "<nav>Home</nav><article><h1>t%d u%d</h1><p>Share this with your friends</p><p>a%d b%d</p>%s</article>"
    rows = [(i, f"http://h.com/{i}", page % (i, i, i, i, "<p>said by two pages only</p>" if i < 2 else "")) for i in range(8)]
    rows += [(i, "http://o.com", "<article><p>The same text on all of these</p><i>x</i>") for i in (20, 21)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for n in (128, 2):
        got = {r.page_id: r.text for r in hosttext.main_text(df, chunk_pages=n).collect()}
        assert got == {i: f"t{i} u{i}\n\na{i} b{i}" + ("\n\nsaid by two pages only" if i < 2 else "") for i in range(8)} | {
            i: "The same text on all of these\n\nx" for i in (20, 21)}
    assert hosttext.main_text(df.limit(0)).count() == 0


def brute_repeated(streams, least):
    at = {}
    for s in set(map(tuple, streams)):
        for i in range(len(s) - least + 1):
            at.setdefault(s[i:i + least], set()).add(s)
    return [[any(len(at.get(tuple(s[j:j + least]), ())) > 1 for j in range(max(0, i - least + 1), i + 1))
             for i in range(len(s))] for s in streams]


def test_host_suffix_array_matches_brute_force():
    rng = np.random.default_rng(3)
    for least in (2, 3, 4, 5):
        streams = [[str(x) for x in rng.integers(0, 4, int(rng.integers(0, 30)))] for _ in range(12)]
        assert hosttext._chunk(streams, least) == brute_repeated(streams, least)


def test_words_of_classes_name_subjects_too():
    def inner(page):
        return [t for k, t in hosttext.blocks(page) if k == "inner"]

    for name in ("related-work", "legal-analysis", "share-price", "post-header", "promo-history"):
        assert inner(f'<article><p>a</p><div class="{name}">b c</div></article>') == ["a", "b c"]
    for name in ("related", "related-posts", "ad-300x250", "share_buttons", "comment-12", "main-nav", "skip-to-content"):
        assert inner(f'<article><p>a</p><div class="{name}">b c</div></article>') == ["a"]
    assert inner("<article>x <svg/> y <math /> z <svg><path/>q</svg> w</article>") == ["x y z w"]
    assert inner("<article><h2>Only a heading</h2></article>") == ["Only a heading"]


def test_pages_of_marked_blocks_and_shared_headings(spark):
    head = "Results of the quarterly survey"
    rows = [(i, f"http://h.com/{i}", f"<article><h2>{head}</h2><p>a{i} b{i}</p><p>Read this on our site</p></article>")
            for i in range(6)]
    rows += [(7, "http://a.com", '<div class="alert-content"><p>main text</p></div>'),
             (8, "http://b.com", '<div class="notice"><p>all there is</p></div><nav>Home</nav>'),
             (9, "http://c.com", '<div class="notice">n</div><p>text</p>'),
             (10, "http://d.com", "<article><h1>Only a heading</h1></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: f"{head}\n\na{i} b{i}" for i in range(6)} | {7: "main text", 8: "all there is", 9: "text", 10: "Only a heading"}
    for options in ({}, {"chunk_pages": 2}, {"chunk_pages": 2, "broadcast_hosts": 0, "broadcast_repeats": 0}):
        assert {r.page_id: r.text for r in hosttext.main_text(df, **options).collect()} == want


def test_pages_without_id_and_url_are_dealt(spark):
    rows = [(None, None, f"<p>a{i} b{i}</p><ul><li>One menu<li>of these pages</ul>") for i in range(40)]
    df = spark.createDataFrame(rows + rows[:1] * 3, "page_id long, url string, html string")
    got = Counter(r.text for r in hosttext.main_text(df, chunk_pages=4).collect())
    assert got == Counter([f"a{i} b{i}" for i in range(40)] + ["a0 b0"] * 3)
