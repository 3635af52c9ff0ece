"""Main text of web pages: page structure first, then long runs that repeat across all pages of a host (suffixes dealt by their beginnings)."""

from __future__ import annotations

import html
import itertools
import re
import uuid

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, map_rows, table
from .dedup import WordHashes, _MIX, _mixed

#: Pages that a task holds at once; the result doesn't depend on it.
PAGES = 128
#: Words whose seeds (about a third as many) one task sorts at once.
WORDS = 4_000_000
#: Tokens of a run that counts as repeated: a power of two, 8 at most.
RUN = 8

# Elements whose content is never text of the page.
SILENT = ("script", "style", "noscript", "template", "head", "svg", "iframe", "object", "canvas", "math", "title", "audio", "video")
# Elements around the page's main text.
CHROME = ("nav", "footer", "aside", "form", "button", "select", "option", "textarea", "input", "dialog", "menu", "label", "fieldset", "datalist", "map")
# Roles and name parts of such elements.
ROLES = ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu", "menubar", "toolbar", "status")
PARTS = (
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
    "cookie", "cookies", "disqus", "footer", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination",
    "popup", "promo", "promoted", "recommended", "related", "responses", "share", "sharing", "sidebar", "signup", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "widget",
)
# Elements that don't end a block of text.
INLINE = (
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
)
# Elements without content.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|iframe|template)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
MAIN, OTHER, AROUND = 2, 1, 0


def _around(tag: str, attributes: str, in_main: bool) -> bool:
    if tag in CHROME or tag in SILENT or tag == "header" and not in_main:
        return True
    if not attributes:
        return False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value = (a or b or c).lower()
        if name.lower() == "role" and value in ROLES or name.lower() == "hidden":
            return True
        if name.lower() in ("class", "id") and not set(re.split(r"[^a-z0-9]+", value)).isdisjoint(PARTS):
            return True
    return False


def blocks(page: str | None) -> list[tuple[int, str]]:
    """``kind, text`` of a page's blocks in order: MAIN within an article (without one, within main), AROUND in menus and the like, else OTHER.

    Character references are decoded, white space within a block is one space, empty blocks are left out. What is
    open at the end of a cut page ends there; an end tag closes what was left open within its element.
    """
    out: list[tuple[int, bool, bool, str]] = []
    if not page:
        return []
    stack: list[tuple[str, bool]] = []
    around = articles = mains = at = 0
    parts: list[str] = []

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((around > 0, articles > 0, mains > 0, text))
            parts.clear()

    def pop() -> None:
        nonlocal around, articles, mains
        tag, hides = stack.pop()
        around -= hides
        articles -= tag == "article"
        mains -= tag == "main"

    for m in TAG.finditer(page):
        if m.start() > at:
            parts.append(page[at : m.start()])
        at = m.end()
        if not (tag := (m[3] or "").lower()):
            continue
        if tag not in INLINE:
            flush()
        if m[2]:
            if any(t == tag for t, _ in stack):
                while stack[-1][0] != tag:
                    if stack[-1][0] not in INLINE and tag in INLINE:
                        break
                    pop()
                if stack[-1][0] == tag:
                    pop()
        elif tag not in VOID and not m[4].endswith("/"):
            if tag in ("p", "li", "td", "tr") and stack and stack[-1][0] == tag:
                pop()  # the one before ends where the next begins
            if tag in INLINE and not m[4]:
                continue
            hides = _around(tag, m[4], articles + mains > 0)
            if hides and tag in INLINE:
                flush()
            stack.append((tag, hides))
            around += hides
            articles += tag == "article"
            mains += tag == "main"
    rest = page[at:]
    if rest and not re.match(r"<[/a-zA-Z!?]", rest):
        parts.append(rest)
    flush()
    by_article, by_main = any(a and not x for x, a, _, _ in out), any(m and not x for x, _, m, _ in out)
    kinds = [AROUND if x else (MAIN if a else AROUND) if by_article else (MAIN if m else AROUND) if by_main else OTHER for x, a, m, _ in out]
    return [(kind, text) for kind, (_, _, _, text) in zip(kinds, out, strict=True)]


def repeated(tokens: np.ndarray, page: np.ndarray, run: int = RUN) -> np.ndarray:
    """True for the tokens within a run of at least ``run`` tokens that occurs on distinct pages.

    ``page`` numbers each token's page, in order. The suffix array is built by prefix doubling over ranks of 1, 2, 4 ... tokens,
    which end at their page's end; suffixes of one rank at ``run`` tokens share that long a beginning.
    """
    n = len(tokens)
    covered = np.zeros(n, bool)
    if n == 0:
        return covered
    rank = np.unique(tokens, return_inverse=True)[1].astype("i8")
    last = np.searchsorted(page, page, "right")
    width = 1
    while width < run:
        ahead = np.arange(n) + width
        inside = ahead < last
        follow = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank * (int(rank.max()) + 2) + follow
        rank = np.unique(key, return_inverse=True)[1].astype("i8")
        width *= 2
    whole = np.flatnonzero(np.arange(n) + run <= last)
    order = whole[np.lexsort((page[whole], rank[whole]))]  # the suffix array down to run tokens
    r, p = rank[order], page[order]
    starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]]) if len(order) else np.zeros(0, "i8")
    if not len(starts):
        return covered
    lengths = np.diff(np.r_[starts, len(order)])
    distinct = np.maximum.reduceat(p, starts) != np.minimum.reduceat(p, starts)
    return cover(order[np.repeat(distinct, lengths)], n, run)


def cover(hits: np.ndarray, n: int, run: int) -> np.ndarray:
    """True for those of ``n`` tokens that lie in a run that begins at one of ``hits``."""
    ends = np.zeros(n + 1, "i8")
    np.add.at(ends, hits, 1)
    np.add.at(ends, hits + run, -1)
    return np.cumsum(ends[:-1]) > 0


def seeds(hosts: list, pages: list[str], hashes: WordHashes, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``page, at, seed, around`` of the places by which runs of ``run`` words of a chunk's pages are found again on other pages.

    Of the windows of ``run / 2`` words in each run the one with the smallest hash (the host's in it) is its seed, the leftmost on
    ties: equal runs on two pages have equal seeds at equal places, and neighbouring runs share theirs, so that about a third of the
    suffixes is enough. ``around`` holds four bits for each of the ``run / 2`` words on either side, the left ones lowest; 0 is no word.
    """
    half = run // 2
    words = [page.encode().split() for page in pages]
    counts = np.array([len(w) for w in words], "i8")
    h = np.fromiter(map(hashes.__getitem__, itertools.chain.from_iterable(words)), "u8", int(counts.sum()))
    none = np.zeros(0, "i8")
    if len(h) < run:
        return none, none, none.astype("u8"), none.astype("u4")
    page, end = np.repeat(np.arange(len(pages)), counts), np.cumsum(counts)
    of_host = np.array([xxhash.xxh3_64_intdigest((host or "").encode()) for host in hosts], "u8")
    x = of_host[page][: len(h) - half + 1]
    for k in range(half):
        x = _mixed(x * _MIX + h[k : k + len(x)])
    begins = np.arange(len(h) - run + 1)
    begins = begins[begins + run <= end[page[begins]]]
    at = np.unique(begins + np.lib.stride_tricks.sliding_window_view(x, run - half + 1)[begins].argmin(1))
    page, marks, around = page[at], (h % np.uint64(15) + np.uint64(1)).astype("u4"), np.zeros(len(at), "u4")
    for k in range(half):
        for there, shift in ((at - half + k, 4 * k), (at + half + k, 4 * (half + k))):
            inside = (there >= (end - counts)[page]) & (there < end[page])
            around |= np.where(inside, marks[np.where(inside, there, 0)], np.uint32(0)) << np.uint32(shift)
    return page, at - (end - counts)[page], x[at], around


def entries(hosts: list, urls: list, pages: list[str], hashes: WordHashes, run: int) -> dict[str, np.ndarray]:
    """The seeds of a chunk of pages, ``page, at, entry``, and its entries ``seed, around, url``: each seed with the same words around once, or twice if it is on more than one url."""
    page, at, seed, around = seeds(hosts, pages, hashes, run)
    marks = np.array([xxhash.xxh3_64_intdigest((u or "").encode()) & 0xFFFFFFFF for u in urls], "u4")
    url = marks[page] if len(page) else np.zeros(0, "u4")
    order = np.lexsort((url, around, seed))
    page, at, seed, around, url = (v[order] for v in (page, at, seed, around, url))
    first = np.r_[True, (seed[1:] != seed[:-1]) | (around[1:] != around[:-1])] if len(seed) else np.zeros(0, bool)
    last = np.r_[first[1:], True] if len(seed) else first
    stay = first | last & np.r_[False, url[1:] != url[:-1]] if len(seed) else first
    entry = np.cumsum(stay) - 1
    entry = entry[np.maximum.accumulate(np.where(first, np.arange(len(seed)), 0))] if len(seed) else entry  # that of the first
    return {"page": page, "at": at, "entry": entry, "seed": seed[stay], "around": around[stay], "url": url[stay]}


def repeats(seed: np.ndarray, around: np.ndarray, url: np.ndarray, run: int = RUN) -> np.ndarray:
    """A byte for each entry; bit k is set if the run that begins k words before the seed is on more than one url."""
    half, out = run // 2, np.zeros(len(seed), "u1")
    for k in range(half + 1):
        mask = sum(0xF << (4 * t) for t in (*range(half - k, half), *range(half, 2 * half - k)))
        x = _mixed(seed * _MIX + (around & np.uint32(mask)))
        order = np.argsort(x, kind="stable")  # the suffixes from here on, by their first ``run`` words
        x, own = x[order], url[order]
        starts = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, "i8")
        if len(starts):
            distinct = np.maximum.reduceat(own, starts) != np.minimum.reduceat(own, starts)
            out[order[np.repeat(distinct, np.diff(np.r_[starts, len(x)]))]] |= np.uint8(1 << k)
    return out


def extract(pages: DataFrame, pages_at_once: int = PAGES, run: int = RUN, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars, n_repeated`` of every page; ``n_repeated`` counts the words of its text that lie in repeated runs.

    Runs of at least ``run`` words (8 at most) on distinct pages of a host are found over the whole host. Pages are parsed once, in
    chunks of ``pages_at_once``; menus, notices and the like are dropped by the page's structure. Of the word streams of what is
    left, the suffixes at their seeds (see ``seeds``) are dealt by hash of host and seed, so that equal beginnings of all
    chunks meet in one sort; a byte an entry goes back to its chunk. A chunk sends a seed with the same words around it twice
    at most, so a run on all pages of a host with any share of all pages is a few entries a chunk, and a host is spread over
    many tasks. Words around a seed are compared by four bits each: a run one word too short counts with a probability of 1/15.

    Where the page marks its article (or main element), that is the text and
    repeats within it stay: articles that quote each other are no boilerplate. On other pages blocks of which
    repeated runs cover more than half are boilerplate.

    A null or empty page has the empty text. A null url is a host of its own; repeated pages are pages of the same url and don't
    count as distinct. Null ids are kept; other columns are not carried.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", "url")]

    def parse():
        def function(columns):
            found = [[(kind, text) for kind, text in blocks(page) if kind != AROUND] for page in columns["html"]]
            words = sum(text.count(" ") + 1 for own in found for _, text in own)
            out = {"chunk": uuid.uuid4().hex, "words": words, "ids": columns["id"], "urls": columns["url"], "hosts": columns["host"]}
            # Blocks have no white space but spaces, so their ends can be line ends.
            texts = "\r".join("\n".join(text for _, text in own) for own in found)
            out |= {"marked": [any(kind == MAIN for kind, _ in own) for own in found], "texts": zstandard.compress(texts.encode("utf-8", "surrogatepass"))}
            return {name: [value] for name, value in out.items()}

        return function

    schema = f"chunk string, words bigint, ids array<{kinds[0]}>, urls array<{kinds[1]}>, hosts array<string>, marked array<boolean>, texts binary"
    parsed = table(map_rows(rows, schema, parse, pages_at_once), "parsed")
    parts = max(1, -(-(parsed.agg(F.sum("words")).first()[0] or 0) // WORDS))

    def own_entries(columns: dict, hashes: WordHashes):
        for chunk, urls, hosts, texts in zip(*(columns[c] for c in ("chunk", "urls", "hosts", "texts")), strict=True):
            pages_ = zstandard.decompress(texts).decode("utf-8", "surrogatepass").split("\r")
            own = entries(hosts, urls, pages_, hashes, run)
            part = (own["seed"] % np.uint64(parts)).astype("i8")
            order = np.lexsort((own["url"], part))  # by url, so that the urls compress
            yield chunk, pages_, own, order, np.searchsorted(part[order], np.arange(parts + 1))

    def deal():
        hashes = kept("word hashes", WordHashes)

        def function(columns):
            out = {"chunk": [], "part": [], "seeds": [], "around": [], "urls": []}
            for chunk, _, own, order, cuts in own_entries(columns, hashes):
                for k in np.flatnonzero(np.diff(cuts)):
                    at = order[cuts[k] : cuts[k + 1]]
                    at_part = (own["seed"][at] >> np.uint64(32)).astype("u4")  # the low bits tell the part
                    for name, value in zip(out, (chunk, int(k), at_part.tobytes(), own["around"][at].tobytes(), own["url"][at].tobytes()), strict=True):
                        out[name].append(value)
            return out

        return function

    def find(group: pd.DataFrame) -> pd.DataFrame:
        seed, around, url = (np.frombuffer(b"".join(group[c]), kind) for c, kind in (("seeds", "u4"), ("around", "u4"), ("urls", "u4")))
        hits = repeats(seed.astype("u8"), around, url, run).tobytes()
        ends = np.cumsum([0, *(len(u) // 4 for u in group["urls"])])
        back = [(chunk, part, hits[a:b]) for chunk, part, a, b in zip(group["chunk"], group["part"], ends[:-1], ends[1:], strict=True)]
        return pd.DataFrame(back, columns=["chunk", "part", "hits"])

    dealt = map_rows(parsed.select("chunk", "urls", "hosts", "texts"), "chunk string, part int, seeds binary, around binary, urls binary", deal, 1)
    hits = dealt.groupBy("part").applyInPandas(find, "chunk string, part int, hits binary")
    # Written first, so that its size is known when the join is planned: the parsed pages move only if it is too large to broadcast.
    hits = table(hits.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("part", "hits"))).alias("found")), "hits")

    def judge():
        hashes = kept("word hashes", WordHashes)

        def function(columns):
            out = {"id": [], "url": [], "text": [], "n_repeated": []}
            several = zip(own_entries(columns, hashes), *(columns[c] for c in ("ids", "urls", "marked", "found")), strict=True)
            for (_, texts, own, order, _), ids, urls, marked, found in several:
                mask = np.zeros(len(order), "u1")
                mask[order] = np.frombuffer(b"".join(bytes(f["hits"]) for f in found or []), "u1")
                mask = mask[own["entry"]]
                cuts = np.argsort(own["page"], kind="stable")
                bounds = np.searchsorted(own["page"][cuts], np.arange(len(texts) + 1))
                for k, (id_, url, main, text_) in enumerate(zip(ids, urls, marked, texts, strict=True)):
                    page = text_.split("\n") if text_ else []
                    here = cuts[bounds[k] : bounds[k + 1]]
                    ends = np.cumsum([0, *(text.count(" ") + 1 for text in page)])
                    n = int(ends[-1])
                    begins = np.concatenate([own["at"][here][(mask[here] >> back & 1) == 1] - back for back in range(run // 2 + 1)])
                    begins = np.unique(begins[(begins >= 0) & (begins + run <= n)])
                    covered = np.r_[0, np.cumsum(cover(begins, n, run))]
                    stay, repeated_words = [], 0
                    for b, text in enumerate(page):
                        hit = int(covered[ends[b + 1]] - covered[ends[b]])
                        if main or 2 * hit <= ends[b + 1] - ends[b]:
                            stay.append(text)
                            repeated_words += hit
                    for name, value in zip(out, (id_, url, " ".join(stay), repeated_words), strict=True):
                        out[name].append(value)
            return out

        return function

    met = parsed.join(hits, "chunk", "left").select("chunk", "ids", "urls", "hosts", "marked", "texts", "found")
    out = map_rows(met, f"id {kinds[0]}, url {kinds[1]}, text string, n_repeated bigint", judge, 1)
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")
