import numpy as np
import pytest
from tokenizers import Tokenizer

from facetspark.llm import pieces
from facetspark.llm.bpe import read_spec
from facetspark.llm.queries import tokenizer
from tests.llm.test_tokens import ODD, texts


@pytest.mark.parametrize("special", [True, False])
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_library(spark, sf001, name, special):
    path = tokenizer(name)
    lib, want = pieces.Library(read_spec(path), special=special, bits=10), Tokenizer.from_file(path)
    want.encode_special_tokens = not special
    encode = lib.encode_bytes if name.startswith("byte") else lib.encode_words
    every = texts(spark, sf001) + ["a### É%%% x--y İ! don't. it's, 'll? ª. Ⅷ! \n\nb... \nc?! _d_ e_ 1. 2a! a1! (f) <|g|> h<|endoftext|>!",
                                   "ʰx! ŉ. ǆ, ß? ﬁ. Å. Å!", "<|endoftext|>.", "a\n!", "tail!\n"]
    for _ in range(2):  # the second time with a full table
        for k in range(0, len(every), 9):
            ids, n = encode(every[k:k + 9])
            parts = np.split(ids, np.cumsum(n)[:-1])
            for t, got in zip(every[k:k + 9], parts):
                assert got.tolist() == want.encode(t, add_special_tokens=False).ids, t[:80]
    assert encode([])[1].tolist() == [] and encode(["", ""])[1].tolist() == [0, 0]


def test_table_keeps_a_bounded_number_of_spans():
    asked = []

    def values(new):
        asked.extend(new)
        return [range(len(s)) for s in new]

    rng = np.random.default_rng(5)
    table = pieces.Table(bits=6)
    for _ in range(60):
        some = [bytes(rng.integers(97, 100, int(rng.integers(1, 45))).astype(np.uint8)) if rng.random() < 0.3
                else b"abcabc"[:int(rng.integers(1, 7))] for _ in range(80)]
        b = np.frombuffer(b"".join(some), dtype=np.uint8)
        end = np.cumsum([len(s) for s in some])
        ids, n = table.numbers(b, end - np.array([len(s) for s in some]), end, values)
        assert n.tolist() == [len(s) for s in some]
        assert ids.tolist() == [i for s in some for i in range(len(s))]
    assert (table.size > 0).sum() <= 64 and asked.count(b"abc") < 60


def test_spans_cover_the_texts():
    b, at = pieces.joined(ODD)
    start, end = pieces.pieces(b, at)
    assert start[0] == 0 and (start[1:] == end[:-1]).all() and end[-1] == len(b)
    assert set(at[:-1][np.diff(at) > 0].tolist()) <= set(start.tolist())
    start, end = pieces.words(b, at)
    got = b"".join(b[s:e].tobytes() for s, e in zip(start.tolist(), end.tolist()))
    assert got == bytes(x for x in b.tobytes() if x not in b" \t\n\r\x0b\x0c")


def test_marks_behind_a_word_ask_for_no_new_span():
    path = tokenizer("byte_bpe_50k.json")
    lib, want, asked = pieces.Library(read_spec(path)), Tokenizer.from_file(path), []
    values = lib.values
    lib.values = lambda spans: asked.extend(spans) or values(spans)
    some = ["A stonewort, stonewort!! stonewort&&& stonewort.", "stone_wort's <|endoftext|> wort<|endoftext|>, wort|> É&& wort's."]
    ids, n = lib.encode_bytes(some)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [want.encode(t).ids for t in some]
    assert sum(b"stonewort" in s for s in asked) == 1


def test_wide_white_space_is_found_by_its_bytes():
    every = ["", "é", " ", *(f"a{chr(i)}" for i in range(0x80, 0x20000) if not 0xD800 <= i < 0xE000), "x", ""]
    assert pieces.wide_texts(*pieces.joined(every)) == [i for i, t in enumerate(every) if pieces.wide_space(t)]
