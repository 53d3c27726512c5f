"""Main text of web pages, with the repeated strings of a host found by a
suffix array.

1. A page is cut into blocks of text by its tags; a block knows whether it is
   inside an article or main element (``inner``), inside an element that is
   never main text by its tag, role or class (``never``), or neither
   (``open``). Scripts, styles, comments and hidden machinery are no text.
2. The words of the blocks outside articles form the page's token stream. The
   streams of a host are concatenated and their suffixes sorted by prefix
   doubling down to ``long_words`` words: neighbours that agree so far are an
   interval of the array, and an interval met on two distinct streams marks its
   words as boilerplate. Every repeated string of ``long_words`` words or more is a
   union of such intervals' words. The pages of a larger host are dealt into
   chunks of about ``chunk_pages`` by a hash of the page and its input partition, each with an array of
   its own, so that no host is one group. What repeats across chunks is found
   by hashes of the strings of ``long_words`` words and of the whole blocks:
   their distinct pages are counted over the host, and each chunk is sent those
   of its own that a second page has and that decide one of its texts. How a host is dealt changes no result.
3. A page with an article keeps its inner blocks, but for runs of whole blocks
   that at least half of the host's distinct pages have; its headings stay. A page without one keeps the
   unique runs of its open blocks: words covered by the host's repeated strings
   go, and runs of whole blocks that are each repeated, ``least`` words or more
   together (menus, notices); the rest stays, phrases in common included.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facetspark.llm.bpe import slices
from facetspark.llm.common import col, on_arrow, small_batches, stored
from facetspark.llm.mixing import _mixed

LEAST = 4  # words of a run of repeated whole blocks
LONG = 20  # words of a string that is repeated wherever it stands
CHUNK_PAGES = 128
BROADCAST_HOSTS = 50_000  # rows of two short columns
BROADCAST_REPEATS = 1_000_000  # rows of two numbers

# fixed values: HTML elements without text, outside main text, and block-level
_SKIP = frozenset("script style noscript template svg math iframe object canvas head title select option textarea "
                  "button audio video map".split())
_NEVER = frozenset("nav header footer aside form menu dialog fieldset".split())
_INNER = frozenset("article main".split())
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre "
                   "section summary table tbody td tfoot th thead tr ul".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_FOREIGN = frozenset("math svg".split())  # these may close themselves
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# words of class and id values that mark an element as outside the main text
_MARKS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar "
                   "navigation menu breadcrumb breadcrumbs sidebar aside widget related recommended share sharing social "
                   "cookie cookies consent notice notices alert popup modal overlay newsletter subscribe subscription "
                   "signup login comment comments disqus respond reply replies footer header masthead toolbar pagination "
                   "copyright legal skip hidden".split())
# a mark counts as a whole value, or beside these only: in related-work or legal-analysis it names a subject
_CHROME = frozenset("area article articles bar block bottom box btn button buttons center cell col column container "
                    "desktop dropdown entry fixed form global group icon icons inner item items js label large layout "
                    "left link links list main message mobile nav outer page panel post posts primary right row "
                    "secondary section site slot small sticky stories strip tab tabs theme title toggle top ui unit "
                    "wp wrap wrapper".split())
_STORY = frozenset("article entry post story".split())  # their header is a part of the text
# a mark beside one of these names a state or a layout, as has-sidebar and comments-open do
_BEFORE = frozenset("has with without no not is non".split())
_AFTER = frozenset("open opened closed enabled disabled on off allowed".split())
_WHOLE = frozenset("html body main article".split())  # class marks do not reach these
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]{0,4000}"|'[^']{0,4000}'|["'])*+)(?:>|\Z)""", re.S | re.X)
_RAW_END = {t: re.compile(rf"</{t}\s*(?:>|\Z)", re.I)
            for t in ("script", "style", "textarea", "title", "noscript", "iframe")}
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


_SIZE = re.compile(r"[0-9]+(?:x[0-9]+)?")


def _is_mark(value: str) -> bool:
    for token in value.split():
        words = [w for w in re.split(r"[^a-z0-9]+", token) if w]
        if not words or words[0] in _BEFORE or words[-1] in _AFTER:
            continue
        if "header" in words and _STORY & set(words):
            continue
        if words[:2] == ["skip", "to"] or any(
                w in _MARKS and words[i - 1] not in _BEFORE for i, w in enumerate(words)) and all(
                w in _MARKS or w in _CHROME or _SIZE.fullmatch(w) for w in words):
            return True
    return False


def _marked(attrs: str) -> tuple[bool, bool, bool]:
    """(never main text by role or hidden, never by class or id, main text)."""
    if not attrs or attrs.isspace():
        return False, False, False
    never, mark, inner = bool(_HIDDEN.search(attrs)), False, False
    for name, a, b, c in _ATTR.findall(attrs):
        value = (a or b or c).lower()
        if name.lower() == "role":
            never |= value in _ROLES
            inner |= value == "main"
        else:
            mark |= _is_mark(value)
            words = set(re.split(r"[^a-z0-9]+", value))
            inner |= bool(words & {"article", "main"}) or "post-content" in value or "entry-content" in value
    return never, mark, inner


def blocks(html: str) -> list[tuple[str, str]]:
    """(kind, text) of the blocks of a page in order; kind is inner, open or never."""
    return [("inner" if k == "title" else k, t) for k, t in parsed(html)]


def parsed(html: str) -> list[tuple[str, str]]:
    """``blocks`` whose headings inside an article are of a kind ``title``.

    Markup may be broken: an end tag closes the nearest open element of its
    name and what is open inside it, or nothing. A class or id word around an
    article or main element decides only if the page has another article that
    no such word surrounds (as a list of comments beside the article has). If
    class and id words would leave a page without any text, they do not count.
    """
    out: list[tuple[str, str]] = []
    text: list[tuple[str, str]] = []  # (kind, text) since the last block border
    stack: list[tuple[str, int, int, int, int]] = []  # element, never, inner, marked, marked outside the article
    never = inner = skip = marks = around = 0
    heading = False

    def flush() -> None:
        for kind in dict.fromkeys(k for k, _ in text):
            t = " ".join("".join([t for k, t in text if k == kind]).split())
            if t:
                out.append(("title" if heading and kind == "inner" else kind, t))
        text.clear()

    def add(t: str) -> None:
        if not skip:
            kind = "inner" if inner else "open"
            if never:
                kind = "never"
            elif marks > around:
                kind = "marked"
            elif marks:
                kind = "held"
            text.append((kind, t))

    at, n = 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        end = m.start() if m else n
        if end > at:
            add(unescape(html[at:end]))
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name == "br":
            add(" ")
            continue
        if name in _BLOCK:
            flush()
            heading = name in _HEADINGS and not m[1]
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    for e, was_never, was_inner, was_mark, was_around in reversed(stack[i:]):
                        never, inner, skip = never - was_never, inner - was_inner, skip - (e in _SKIP)
                        marks, around = marks - was_mark, around - was_around
                    del stack[i:]
                    break
                if stack[i][2] and name not in ("body", "html") or (
                        stack[i][1] or stack[i][3]) and name not in _BLOCK:
                    break  # a stray end tag closes no article, an inline one no section
        elif name in _RAW_END:
            close = _RAW_END[name].search(html, at)
            at = close.end() if close else n
        elif name not in _VOID and not (name in _FOREIGN and m[3].endswith("/")):
            if name in ("p", "li") and stack and stack[-1][0] == name:
                _, was_never, was_inner, was_mark, was_around = stack.pop()
                never, inner, marks, around = never - was_never, inner - was_inner, marks - was_mark, around - was_around
            is_never, is_mark, is_inner = _marked(m[3])
            is_never |= name in _NEVER and not (name == "header" and inner)
            is_mark &= name not in _WHOLE
            is_inner = (is_inner or name in _INNER) and not is_never and not is_mark
            # the outermost article or main inside marked elements: their marks are around it
            is_around = marks if name in _INNER and not is_never and not inner and marks > around else 0
            stack.append((name, is_never, is_inner, is_mark, is_around))
            never, inner, skip = never + is_never, inner + is_inner, skip + (name in _SKIP)
            marks, around = marks + is_mark, around + is_around
    flush()
    free = any(k in ("inner", "title") for k, _ in out)
    bare = not any(k in ("inner", "title", "held", "open") for k, _ in out)
    what = {"held": "never" if free else "inner", "marked": "open" if bare else "never"}
    return [(what.get(k, k), t) for k, t in out]


def _article(kinds: str) -> bool:
    return "i" in kinds or "t" in kinds


def repeated(ids: np.ndarray, stream: np.ndarray, page: np.ndarray, least: int) -> np.ndarray:
    """Whether each word lies in a string of ``least`` words that two distinct
    streams share. ``page``: place of each word's page, ascending; ``stream``:
    number of the page's stream, equal for equal streams."""
    n = len(ids)
    hit = np.zeros(n, dtype=bool)
    if n < least:
        return hit
    end = np.searchsorted(page, page, side="right")
    rank, depth = ids.astype(np.int64), 1
    while depth < least:
        step = min(depth, least - depth)  # the last round overlaps
        ahead = np.arange(n) + step
        follow = np.where(ahead < end, rank[np.minimum(ahead, n - 1)] + 1, 0)
        rank = np.unique(rank * (int(rank.max()) + 2) + follow, return_inverse=True)[1]
        depth += step
    whole = np.flatnonzero(end - np.arange(n) >= least)
    if not len(whole):
        return hit
    order = whole[np.argsort(rank[whole], kind="stable")]
    first = np.flatnonzero(np.concatenate(([True], np.diff(rank[order]) != 0)))
    low, high = np.minimum.reduceat(stream[order], first), np.maximum.reduceat(stream[order], first)
    shared = order[np.repeat(low != high, np.diff(np.append(first, len(order))))]
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, shared, 1)
    np.add.at(edge, shared + least, -1)
    return np.cumsum(edge[:n]) > 0


def _chunk(streams: list[list[str]], least: int, numbers: list[int] | None = None) -> list[list[bool]]:
    """Which words of each stream are in strings that distinct streams share;
    ``numbers`` tell which pages are distinct, by default the streams do."""
    number: dict[str, int] = {}
    kinds: dict[tuple[str, ...], int] = {}
    size = [len(s) for s in streams]
    ids = np.array([number.setdefault(w, len(number)) for s in streams for w in s], dtype=np.int64)
    if numbers is None:
        numbers = [kinds.setdefault(tuple(s), len(kinds)) for s in streams]
    kind = np.array(numbers, dtype=np.int64)
    hit = repeated(ids, np.repeat(kind, size), np.repeat(np.arange(len(streams)), size), least)
    return [x.tolist() for x in np.split(hit, np.cumsum(size)[:-1])]


def _hash(*parts: str) -> int:
    """64 bits of the strings, the same in every process."""
    text = "\0".join(parts).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def _windows(host: str, words: list[str], size: int, known: dict[str, int]) -> np.ndarray:
    """A hash, by host, of each string of ``size`` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    for w in words:
        if w not in known:
            known[w] = _hash(w)
    ids = np.array([known[w] for w in words], dtype=np.int64).view(np.uint64)
    out = np.full(n, np.uint64(_hash("window", host) & (2**64 - 1)))
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + ids[i:i + n]
    return _mixed(out).view(np.int64)


def _packed(texts: list[str]) -> bytes:
    """Blocks for a shuffle, compressed; no block holds a line feed."""
    return zstandard.compress("\n".join(texts).encode("utf-8", "surrogatepass"), 3) if texts else b""


def _unpacked(data: bytes) -> list[str]:
    return zstandard.decompress(data).decode("utf-8", "surrogatepass").split("\n") if data else []


def _outside(blocks_: list[str], kinds: str) -> list[str]:
    return [w for b, k in zip(blocks_, kinds) if k not in "it" for w in b.split()]


def _runs(size: list[int], often: list[bool], least: int) -> list[bool]:
    """Which blocks are in runs of ``often`` ones of ``least`` words or more."""
    gone, i = [False] * len(size), 0
    while i < len(size):
        j = i
        while j < len(size) and often[j]:
            j += 1
        if sum(size[i:j]) >= least:
            gone[i:j] = [True] * (j - i)
        i = max(j, i + 1)
    return gone


def _inner_text(texts: list[str], kinds: str, times: list[int], pages: int, least: int) -> list[str]:
    """What stays of an article: not the runs of blocks that half of the host's
    distinct ``pages``, three at least, have too; headings always, and all of
    it if all else would go."""
    often = [k != "t" and 2 * n >= pages and n >= 3 for k, n in zip(kinds, times)]
    gone = _runs([len(t.split()) for t in texts], often, least)
    none = all(g or k == "t" for g, k in zip(gone, kinds))
    return [t for t, g in zip(texts, gone) if not g or none]


def _open_text(texts: list[str], kinds: str, times: list[int], hit: list[bool], least: int) -> list[str]:
    """What stays of the open blocks of a page without an article: neither runs
    of repeated whole blocks of ``least`` words or more, nor words of ``hit``.
    ``times``: on how many pages each block is."""
    size = [len(t.split()) for t in texts]
    kept, at = [], 0
    for t, k, g, n in zip(texts, kinds, _runs(size, [n > 1 for n in times], least), size):
        if k == "o" and not g:
            run = [w for w, h in zip(t.split(), hit[at:at + n]) if not h]
            if run:
                kept.append(" ".join(run))
        at += n
    return kept


def main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              least: int = LEAST, chunk_pages: int = CHUNK_PAGES, long_words: int = LONG,
              broadcast_hosts: int = BROADCAST_HOSTS, broadcast_repeats: int = BROADCAST_REPEATS) -> DataFrame:
    """One row (id, url, text, n_chars) per input row.

    Blocks are joined by two line feeds; white space inside a block is one
    space. A null or textless html has the empty text. Pages without a url are
    a host of their own; rows with equal or null ids are pages like any other,
    and pages with the same stream count once as evidence.
    """
    host = F.lower(F.regexp_extract(F.coalesce(col(url_col), F.lit("")),
                                    r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    pages = small_batches(df).select(col(id_col).alias("id"), col(url_col).alias("url"), col(html_col).alias("html"),
                      host.alias("host"), F.xxhash64(col(id_col), col(url_col), col(html_col),
                                                     F.spark_partition_id()).alias("deal"))
    large = stored(pages.groupBy("host").count().where(F.col("count") > chunk_pages).select(
        "host", F.ceil(F.col("count") / chunk_pages).alias("parts")))
    if large.count() <= broadcast_hosts:  # more hosts are joined by a shuffle
        large = F.broadcast(large)
    pages = pages.join(large, "host", "left").select(
        "id", "url", "html", "host", F.coalesce(F.pmod("deal", F.col("parts")), F.lit(0)).alias("chunk"),
        F.col("parts").isNotNull().alias("dealt"))
    schema = pages.select("id", "url").schema
    keys = ["host", "chunk"]

    def traces(batches):
        """Of each dealt page its number, the hashes of its whole blocks and long
        strings, and those of them that its own text depends on."""
        for batch in batches:
            known: dict[str, int] = {}
            for part in slices(batch, "html"):
                rows = []
                for html, name in zip(*(part.column(c).to_pylist() for c in ("html", "host"))):
                    found = parsed(html) if html else []
                    kinds, texts = "".join(k[0] for k, _ in found), [t for _, t in found]
                    own = np.array([_hash("page", name), *{_hash("block", name, t) for t in texts}], dtype=np.int64)
                    h = np.unique(np.concatenate([own, _windows(name, _outside(texts, kinds), long_words, known)]))
                    if _article(kinds):
                        needed = [_hash("page", name), *(_hash("block", name, t) for k, t in zip(kinds, texts) if k == "i")]
                        need = np.isin(h, needed)
                    else:
                        need = np.ones(len(h), dtype=bool)
                    rows.append((_hash(kinds, *texts), h[need], h[~need]))
                yield pa.RecordBatch.from_arrays([
                    pa.array([r[0] for r in rows], pa.int64()), part.column(1), part.column(2),
                    *(pa.array([r[i] for r in rows], pa.list_(pa.int64())) for i in (1, 2))],
                    names=["page", "host", "chunk", "need", "rest"])

    # counted over the whole host, and sent to the chunks that need one
    traced = stored(pages.where("dealt").select("html", "host", "chunk").mapInArrow(
        traces, "page long, host string, chunk long, need array<long>, rest array<long>"))
    twice = stored(traced.select("page", F.explode(F.concat("need", "rest")).alias("far")).distinct().groupBy("far").agg(
        F.count(F.lit(1)).alias("times")).where("times > 1"))
    if twice.count() <= broadcast_repeats:  # more are joined by a shuffle
        twice = F.broadcast(twice)
    sent = traced.select("host", "chunk", F.explode("need").alias("far")).join(twice, "far").distinct()

    def cut(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                found = [parsed(h) if h else [] for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), part.column(3), part.column(4),
                    pa.array([_packed([t for _, t in b]) for b in found], pa.binary()),
                    pa.array(["".join([k[0] for k, _ in b]) for b in found], pa.string()), part.column(5)],
                    names=["id", "url", "host", "chunk", "blocks", "kinds", "dealt"])

    def clean(t: pa.Table) -> pa.Table:
        key = list(zip(t["host"].to_pylist(), t["chunk"].to_pylist()))
        first = [i for i in range(len(key)) if not i or key[i] != key[i - 1]]
        hashes, counts = t["far"].to_pylist(), t["times"].to_pylist()
        packed, all_kinds, dealt = (t[c].to_pylist() for c in ("blocks", "kinds", "dealt"))
        rows, texts, known = [], [], {}
        for s, e in zip(first, [*first[1:], len(key)]):
            host = key[s][0]
            far = {hashes[i]: counts[i] for i in range(s, e) if hashes[i] is not None}
            at = [i for i in range(s, e) if hashes[i] is None]
            all_blocks = {i: _unpacked(packed[i]) for i in at}
            number: dict[tuple[str, ...], int] = {}
            numbers = [number.setdefault((all_kinds[i], *all_blocks[i]), len(number)) for i in at]
            times = Counter(b for page in number for b in set(page[1:]))
            n_pages = len(number)
            if at and dealt[at[0]]:
                n_pages = far.get(_hash("page", host), 1)
                times = {b: far.get(_hash("block", host, b), 1) for b in times}
            hits = [[]] * len(at)
            if any(not _article(all_kinds[i]) and "o" in all_kinds[i] for i in at):
                streams = [_outside(all_blocks[i], all_kinds[i]) for i in at]
                hits = _chunk(streams, long_words, numbers)
                if dealt[at[0]]:
                    marks = np.fromiter(far, np.int64, len(far))
                    for i, words in enumerate(streams):
                        for j in np.flatnonzero(np.isin(_windows(host, words, long_words, known), marks)):
                            hits[i][j:j + long_words] = [True] * long_words
            for i, hit in zip(at, hits):
                if _article(all_kinds[i]):
                    inner = [(b, k) for b, k in zip(all_blocks[i], all_kinds[i]) if k in "it"]
                    kept = _inner_text([b for b, _ in inner], "".join([k for _, k in inner]),
                                       [times[b] for b, _ in inner], n_pages, least)
                else:
                    kept = _open_text(all_blocks[i], all_kinds[i], [times[b] for b in all_blocks[i]], hit, least)
                rows.append(i)
                texts.append("\n\n".join(kept))
        t = t.select(["id", "url"]).take(pa.array(rows, pa.int64()))
        return pa.table([t["id"], t["url"], pa.array(texts, pa.string())], names=["id", "url", "text"])

    spec = T.StructType([schema["id"], schema["url"], T.StructField("host", T.StringType()),
                         T.StructField("chunk", T.LongType()),
                         T.StructField("blocks", T.BinaryType()), T.StructField("kinds", T.StringType()),
                         T.StructField("dealt", T.BooleanType())])
    done = pages.mapInArrow(cut, spec).unionByName(sent, allowMissingColumns=True).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        on_arrow(clean, keys), T.StructType([schema["id"], schema["url"], T.StructField("text", T.StringType())]))
    return done.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
                       F.length("text").cast("long").alias("n_chars"))
