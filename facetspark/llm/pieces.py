"""Byte spans of a batch of texts and the token ids that stand for them.

Texts are cut into short spans where a vocabulary never joins tokens across
the cut; the ids of a span depend on the span alone. A worker keeps the ids of
spans it has met in a set-associative table of fixed size: a span's place
follows from its bytes, a full set gives up one entry at a time, so the table
never starts anew. Looking up, finding new spans and putting the ids together
are array operations; only new spans reach a tokenizer, each once a batch.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True

_WIDE_SPACE = re.compile(r"[^\S\x00-\x7f]")
# its letters' bytes, the first one highest, with a zero behind those of two
_WIDE_BYTES = [int.from_bytes(x.encode("utf-8").ljust(3, b"\0"))
               for x in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x10000)]) if _WIDE_SPACE.match(x)]

# letters before this one are the same in every version of Unicode, and in normal form
_PLAIN = "\u0250"
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # without the apostrophe, which may begin a word

LONGEST = 32  # bytes of a span that the table keeps
WIDTH = 8  # ids of a span that the table keeps
WAYS = 4
_FIRST = np.arange(WIDTH) < np.arange(WIDTH + 1)[:, None]
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def byte_letters() -> list[str]:
    """The printable letter of every byte in byte-level vocabularies: the
    printable Latin-1 bytes stand for themselves, the others for the letters
    from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def wide_space(text: str) -> bool:
    """Whether a text has white space beyond ASCII, which pre-splitting may
    join with the spaces around it."""
    return not text.isascii() and _WIDE_SPACE.search(text) is not None


def wide_texts(b: np.ndarray, at: np.ndarray) -> list[int]:
    """The numbers of the texts with such white space, from their bytes."""
    data = np.append(b, np.zeros(2, dtype=np.uint8))
    lead = np.flatnonzero((b == 0xC2) | (b - np.uint8(0xE1) < 3))
    letter = data[lead].astype(np.int32) << 16 | data[lead + 1].astype(np.int32) << 8
    letter |= np.where(data[lead] == 0xC2, 0, data[lead + 2])
    found = lead[np.isin(letter, _WIDE_BYTES)]
    return np.unique(np.searchsorted(at, found, side="right") - 1).tolist()


def joined(texts: list[str], before: str = "") -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of the texts one after the other, ``before`` in front of
    each, and where each begins (with the end of the last)."""
    coded = [(before + t).encode("utf-8") for t in texts]
    at = np.zeros(len(coded) + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)), out=at[1:])
    return np.frombuffer(b"".join(coded), dtype=np.uint8), at


def white_bytes(b: np.ndarray) -> np.ndarray:
    """Which bytes are ASCII white space."""
    return (b == 32) | (b - np.uint8(9) < 5)


def lone_white(b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Single spaces and line feeds that touch no other white space nor a
    text's end; a text's first byte counts if the text goes on."""
    white = white_bytes(b)
    lone = (b == 32) | (b == 10)
    first = at[:-1][at[1:] > at[:-1]]
    last = at[1:][at[1:] > at[:-1]] - 1
    after, before = np.append(white[1:], False), np.append(False, white[:-1])
    after[last], before[first] = True, False
    return lone & ~after & ~before


def word_stops(b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A comma or full stop after an ASCII letter, before white space or a text's end."""
    stop = np.flatnonzero((b == 44) | (b == 46))
    stop = stop[stop > 0]
    stop = stop[_LETTER[b[stop - 1]]]
    ended = at[np.searchsorted(at, stop + 1)] == stop + 1
    out = np.zeros(len(b), dtype=bool)
    out[stop[ended | white_bytes(np.append(b, np.uint8(32))[stop + 1])]] = True
    return out


def words(b: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of maximal runs without ASCII white space; a stop or comma
    that ends a word is a span of its own."""
    white = white_bytes(b)
    begin = ~white & np.append(True, white[:-1])
    first = at[:-1][at[1:] > at[:-1]]
    begin[first] = ~white[first]
    begin |= word_stops(b, at)
    edge = white | begin
    edge[first] = True
    edges = np.flatnonzero(edge)
    starts = begin[edges]
    return edges[starts], np.append(edges[1:], len(b))[starts]


def letter_marks(b: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The places of ``marks`` (a flag per byte) after an ASCII letter."""
    letter = (b | np.uint8(32)) - np.uint8(97) < 26
    place = np.flatnonzero(letter[:-1] & ~letter[1:] & (b[1:] != 32)) + 1
    return place[marks[b[place]]]


def pieces(b: np.ndarray, at: np.ndarray, marks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of spans that cover all bytes: cut at every text's start,
    before single spaces and line feeds, and before stops that end a word or,
    if given, all ``marks`` after a letter."""
    border = lone_white(b, at)
    if marks is None:
        border |= word_stops(b, at)
    else:
        border[letter_marks(b, marks)] = True
    border[at[:-1][at[1:] > at[:-1]]] = True
    start = np.flatnonzero(border)
    return start, np.append(start[1:], len(b))


def ragged(flat: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The runs flat[start:start + n] one after the other."""
    return flat[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[3]
    return x ^ (x >> np.uint64(29))


class Table:
    """Ids of spans. Spans of up to 16 bytes are compared as they are, up to
    ``LONGEST`` by 128 bits of a hash and their size; longer ones and those of
    more than ``WIDTH`` ids are not kept."""

    def __init__(self, bits: int = 20, id_type=np.uint16):
        n = 1 << bits
        self.shift, self.turn = np.uint64(64 - bits), 0
        self.low, self.high = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        self.size, self.count = np.zeros(n, np.uint8), np.zeros(n, np.uint8)  # size 0: free
        self.ids = np.zeros((n, WIDTH), id_type)
        self.most = np.iinfo(id_type).max

    def _keys(self, b: np.ndarray, start: np.ndarray, size: np.ndarray):
        data = np.concatenate((b, np.zeros(LONGEST, dtype=np.uint8)))
        word = np.ndarray((len(b) + LONGEST - 7,), "<u8", data, strides=(1,))
        low, high = word[start] & _MASK[np.minimum(size, 8)], word[start + 8] & _MASK[np.clip(size - 8, 0, 8)]
        far = np.flatnonzero(size > 16)
        if len(far):
            s, k = start[far], size[far]
            c, d = word[s + 16] & _MASK[np.clip(k - 16, 0, 8)], word[s + 24] & _MASK[np.clip(k - 24, 0, 8)]
            low[far] ^= _mixed(c * _ODD[0] + d * _ODD[1])
            high[far] ^= _mixed(c * _ODD[2] + _mixed(d + _ODD[3]))
        return low, high, _mixed(low * _ODD[0] + _mixed(high * _ODD[1] + size.astype(np.uint64)))

    def _find(self, low, high, size, name):
        """The entry of each span, -1 without one."""
        base = (name >> self.shift).astype(np.int64) & ~np.int64(WAYS - 1)
        hit = (np.take(self.low, base) == low) & (np.take(self.high, base) == high) & (np.take(self.size, base) == size)
        found = np.where(hit, base, -1)
        left = np.flatnonzero(~hit)
        for way in range(1, WAYS):
            at = base[left] + way
            hit = (self.low[at] == low[left]) & (self.high[at] == high[left]) & (self.size[at] == size[left])
            found[left[hit]] = at[hit]
            left = left[~hit]
        return found, base

    def _keep(self, base, low, high, size, flat, start, n) -> None:
        """Entries for new spans; of those that meet in one place the last stays."""
        self.turn += 1
        free = self.size[base[:, None] + np.arange(WAYS)] == 0
        # a set's new spans take its free ways in order, or the next way in turn
        order = np.argsort(base, kind="stable")
        new = np.append(True, base[order][1:] != base[order][:-1]) if len(base) else np.zeros(0, bool)
        nth = np.empty(len(base), dtype=np.int64)
        run = np.flatnonzero(new)
        nth[order] = np.arange(len(base)) - np.repeat(run, np.diff(np.append(run, len(base))))
        full = nth >= free.sum(axis=1)
        way = np.where(full, (nth + self.turn) % WAYS, np.argmax(np.cumsum(free, axis=1) == (nth + 1)[:, None], axis=1))
        at, one = np.unique(base + way, return_index=True)
        self.low[at], self.high[at], self.size[at], self.count[at] = low[one], high[one], size[one], n[one]
        columns = np.arange(WIDTH)
        inside = columns < n[one][:, None]
        rows = np.zeros((len(at), WIDTH), self.ids.dtype)
        rows[inside] = ragged(flat, start[one], n[one])
        self.ids[at] = rows

    def numbers(self, data: np.ndarray | bytes, start: np.ndarray, end: np.ndarray,
                values: Callable[[list[bytes]], list[Sequence[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all spans (none empty) one after the other, and how many
        each has. ``values`` gives the ids of new spans."""
        if not len(start):
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        b = np.frombuffer(data, dtype=np.uint8)
        size = np.minimum(end - start, LONGEST + 1).astype(np.int64)
        low, high, name = self._keys(b, start, size)
        entry, base = self._find(low, high, size.astype(np.uint8), name)
        n = np.where(entry >= 0, np.take(self.count, entry, mode="clip"), np.uint8(0))
        kept = np.take(self.ids, entry, axis=0, mode="clip")[np.take(_FIRST, n, axis=0)]
        n = n.astype(np.int64)
        miss = np.flatnonzero(entry < 0)
        if not len(miss):
            return kept.astype(np.uint32), n
        short = miss[size[miss] <= LONGEST]
        _, one, same = np.unique(name[short], return_index=True, return_inverse=True)
        one = short[one]
        alike = (low[short] == low[one][same]) & (high[short] == high[one][same]) & (size[short] == size[one][same])
        # spans that are too long, or only share a name with another, are asked one by one
        rest = np.concatenate((miss[size[miss] > LONGEST], short[~alike]))
        ask = np.concatenate((one, rest))
        raw = b.tobytes()
        got = values([raw[s:e] for s, e in zip(start[ask].tolist(), end[ask].tolist())])
        count = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter(chain.from_iterable(got), np.uint32, int(count.sum()))
        if len(flat) and int(flat.max()) > self.most:
            raise ValueError("ids do not fit the table")
        begin = np.cumsum(count) - count
        answer = np.zeros(len(start), dtype=np.int64)
        answer[short], answer[rest] = same, len(one) + np.arange(len(rest))
        n[miss] = count[answer[miss]]
        k = np.flatnonzero((count[:len(one)] <= WIDTH) & (count[:len(one)] > 0))
        self._keep(base[one[k]], low[one[k]], high[one[k]], size[one[k]], flat, begin[k], count[k])
        known = np.repeat(entry >= 0, n)
        out = np.empty(len(known), dtype=np.uint32)
        out[known] = kept
        out[~known] = ragged(flat, begin[answer[miss]], n[miss])
        return out, n


def text_counts(start: np.ndarray, n: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many ids each text has: ``n`` per span (``start`` ascending), texts begin at ``at``."""
    return np.diff(np.append(0, np.cumsum(n))[np.searchsorted(start, at)])


def one_core() -> None:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core


def one_core() -> None:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core


def _latin(word: str) -> bool:
    return word.isalpha() and max(word) < _PLAIN


class Library:
    """The tokenizers library behind a worker's table of spans.

    A new span of Latin letters (for byte-level vocabularies with a space or
    line feed before them) is one pre-split word in normal form, and marks
    behind it are another, so they go to the library's model at once; other new
    spans go through the whole of it.
    """

    def __init__(self, spec: str, special: bool = True, bits: int = 20):
        one_core()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = not special
        self.model = self.tokenizer.model
        kinds = json.loads(spec)
        parts = kinds.get("normalizer") or {}
        self.lower = "Lowercase" in [p["type"] for p in parts.get("normalizers", [parts]) if p]
        self.byte_level = (kinds.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
        self.letters = dict(enumerate(byte_letters()))
        # a byte-level vocabulary's words end before these; none is in an added token
        self.marks = np.zeros(256, dtype=bool)
        self.marks[[m for m in _MARKS if not any(chr(m) in t["content"] for t in kinds["added_tokens"])]] = True
        self.wide = np.array([ord(x) for x in byte_letters()], dtype="<u2")
        self.feed = self.whole("\n") if self.byte_level else []
        self.table = Table(bits, np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _made(self, letters: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize(letters.decode("latin-1").translate(self.letters))]

    def _word(self, span: bytes) -> list[int] | None:
        """Ids of a span that is one word of letters, else None."""
        if self.lower:
            if span.isalpha():
                return self._made(span.lower())
            word = span.decode("utf-8").lower()  # which may part a letter from its mark
            if _latin(word):
                return self._made(word.encode("utf-8"))
        return None

    def _one(self, span: bytes) -> list[int]:
        head = span.rstrip(_MARKS)
        ids = self._word(head)
        if ids is None:
            return self.whole(span.decode("utf-8"))
        return ids + self._made(span[len(head):]) if len(head) < len(span) else ids

    def values(self, spans: list[bytes]) -> list[list[int]]:
        return self._byte_values(spans) if self.byte_level else [self._one(s) for s in spans]

    def _byte_values(self, spans: list[bytes]) -> list[list[int]]:
        # one letter a byte, made for all spans at once
        flat = np.take(self.wide, np.frombuffer(b"".join(spans), dtype=np.uint8)).tobytes().decode("utf-16-le")
        at, out, tokenize = 0, [], self.model.tokenize
        for span in spans:
            head, lead, begin = span.rstrip(_MARKS), span[:1], at
            word = head[1:] if lead == b" " or lead == b"\n" else head
            at += len(span)
            if not (word.isalpha() or _latin(word.decode("utf-8"))):
                out.append(self.whole(span.decode("utf-8")))
                continue
            middle = begin + len(head)
            ids = [t.id for t in tokenize(flat[begin + (lead == b"\n"):middle])]
            if lead == b"\n":
                ids = self.feed + ids
            if middle < at:
                ids += [t.id for t in tokenize(flat[middle:at])]
            out.append(ids)
        return out

    def encode_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other and how many each has, for
        vocabularies that drop white space."""
        b, at = joined(texts)
        start, end = words(b, at)
        ids, n = self.table.numbers(b, start, end, self.values)
        return ids, text_counts(start, n, at)

    def encode_bytes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for byte-level vocabularies, which keep white space. Texts
        with white space beyond ASCII are encoded as a whole."""
        b, at = joined(texts)
        wide = {i: self.whole(texts[i]) for i in wide_texts(b, at)}
        if wide:
            b, at = joined(["" if i in wide else t for i, t in enumerate(texts)])
        start, end = pieces(b, at, self.marks)
        ids, n = self.table.numbers(b, start, end, self.values)
        n = text_counts(start, n, at)
        if wide:
            parts = np.split(ids, np.cumsum(n)[:-1])
            for i, x in wide.items():
                parts[i], n[i] = np.array(x, dtype=np.uint32), len(x)
            ids = np.concatenate(parts)
        return ids, n
