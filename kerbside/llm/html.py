"""Main text of web pages, with the runs that repeat on a host removed.

Each page is cut into blocks of text, in the tasks that read it: mark-up,
scripts, forms, menus, headers, footers, sidebars, notices, adverts and
reader comments are known by their elements, roles and class names; what
stands in ``article`` or ``main`` is marked as main text, an article's own
header with it.  A wrapper whose name sounds like boilerplate, a form or a
menu that holds the page's content is none.

A page is a stream of tokens.  The suffix array of a host has the suffixes of
all of its streams in order; it is cut after ``RUN`` tokens, as longer repeats
are chains of its intervals.  It is dealt by ranges of (host, suffix), so a
host of any size is sorted by many tasks, and neighbours with ``RUN`` tokens
in common form an interval: a run and the pages that have it.  A run on
distinct pages of its host that stands outside the main text of one of them
is boilerplate there; the tokens it covers are removed outside main text, and
the unique runs are the page's text.  They are removed from main text only if
the run stands in the main text of distinct pages and still more pages have it
outside: an article that other pages quote keeps the passage.  A passage that
repeats only inside the main text of pages is content.  An article under a
few addresses is content, too: on a page without main text, runs of fewer
than ``SPREAD`` classes of pages (64 by page digest) stay if they cover
``LONG`` tokens or more and most of what the wide-spread runs leave.

Only suffixes that can have an equal one are sorted.  Equal runs have equal
anchors (the least hash of their pieces of ``ANCHOR`` tokens), about one in
eight tokens is one: those on several pages are found first and kept as a bit
map, which may hold too much, never too little, so it does not change the
result; suffixes are compared as text.  The texts are dealt into chunks of some
MB of a host, a suffix is told once per chunk and batch with the pages that
have it, and each chunk gets its boilerplate runs: how a host is dealt does not
change the result either.

Defined results: a NULL or empty html has an empty text; a page without main
text gives its other blocks less the boilerplate; pages with equal streams
count as one page for repetition, so copies are kept; a stream shorter than
``RUN`` has no run; words of more than 32 characters are compared by a 128-bit
digest; very long texts and elements nested in thousands are read whole;
repeated rows are kept; a NULL url is a host of its own; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import _ODD, SPACE, mix64, small_batches, text_slices, written

#: Tokens of a repeated run at least; bytes of html of one chunk of a host.
RUN, CHUNK_BYTES = 20, 1 << 20
#: Runs on fewer classes of pages, of 64, are no boilerplate if they cover so many tokens and most of a page.
SPREAD, LONG = 10, 100
#: Shares of a host's chunks that tell a suffix on their own before it is sorted.
SHARES = 256
#: Tokens of an anchor; bits of the map of anchors at most, and of one page of it.
ANCHOR, MAX_BITS, PAGE_BITS = 6, 1 << 29, 1 << 18

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)

# fixed values: elements and class words of what is not main text
_RAW = {"script", "style", "template", "iframe", "textarea", "title", "svg", "math", "object", "canvas"}
_OUT = {"head", "button", "select", "dialog", "menu"}
#: Boilerplate unless they hold the page's article; a form also if it holds most of the page's text.
_FRAME, _FORM = {"nav", "header", "footer", "aside", "noscript"}, {"form", "fieldset"}
_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "banner",
          "sidebar", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "newsletter",
          "subscribe", "signup", "login", "share", "sharing", "social", "comment", "comments", "reply", "replies", "nav",
          "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "related",
          "recommended", "pagination", "pager", "widget", "toolbar", "search", "complementary", "contentinfo", "disclaimer"}
_COMMENT = {"comment", "comments", "reply", "replies"}
#: Words that make a class or id the state or the frame of a wrapper.
_STATE = {"has", "no", "not", "with", "without", "elementor"}
_HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
_VOID = {"br", "img", "hr", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
_BLOCK = {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "table", "tr", "thead", "tbody",
          "tfoot", "caption", "blockquote", "pre", "section", "article", "main", "figure", "figcaption", "address", "details",
          "summary", "body", "html", "hr", "center"} | _OUT | (_FRAME - {"noscript"}) | _FORM
_SPACED = {"br", "td", "th"}
_MAIN = {"article", "main"}


def _attributes(attrs: str) -> dict[str, str]:
    """Attributes by small name; of repeated ones the first counts."""
    out: dict[str, str] = {}
    for m in _ATTR.finditer(attrs):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def _hidden(attrs: dict[str, str]) -> bool:
    return attrs.get("hidden", "until-found").strip().lower() != "until-found" \
        or attrs.get("aria-hidden", "").strip().lower() == "true" or bool(_NO_DISPLAY.search(attrs.get("style", "")))


def _named(element: str, attrs: dict[str, str]) -> str:
    """"C" if a class, id or role names reader comments, "N" if other boilerplate, else "".
    A name that tells a state of a wrapper (has-sidebar) and the id of a heading name nothing."""
    kind = ""
    for a in ("class", "id", "role"):
        if a == "id" and element in _HEADING:
            continue
        for name in attrs.get(a, "").lower().split():
            words = set(re.split(r"[^a-z0-9]+", name))
            if words & _WORDS and not words & _STATE:
                if words & _COMMENT:
                    return "C"
                kind = "N"
    return kind


def _spared(kinds: list[str], parents: list[int], sizes: list[tuple[int, int]]) -> set[int]:
    """The marked elements that hold the page's content, so that their name doesn't count:
    those with a ``main`` element, with the page's only article, or with more text than
    stands outside boilerplate around them, and its largest article if there are articles.
    ``kinds`` and ``parents`` describe the tree of marked elements (a parent comes before
    its children, -1 is the page), ``sizes`` has (characters, innermost mark) of each block.
    A few passes over the tree, whatever its depth."""
    n = len(kinds)
    if not any(k in "NCE" for k in kinds):
        return set()
    # the last place is the page itself
    parent = [p if p >= 0 else n for p in parents]
    text = [0] * (n + 1)
    for c, at in sizes:
        text[at if at >= 0 else n] += c
    hard = [False] * (n + 1)
    for x in range(n):
        hard[x] = kinds[x] == "H" or hard[parent[x]]
    size, clean = [0 if hard[x] else text[x] for x in range(n + 1)], list(text)
    for x in range(n - 1, -1, -1):  # clean: text not inside further marks but articles
        size[parent[x]] += 0 if hard[x] else size[x]
        if kinds[x] in "AM":
            clean[parent[x]] += clean[x]
    article = [x < n and kinds[x] in "AM" and size[x] > 0 and not hard[x] for x in range(n + 1)]
    # articles inside each mark, the largest of them, and whether one is a main element
    count, largest, main = [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
    second, top = [0] * (n + 1), [-1] * (n + 1)
    for x in range(n - 1, -1, -1):
        p, own = parent[x], max(largest[x], size[x] if article[x] else 0)
        count[p] += count[x] + article[x]
        main[p] = main[p] or main[x] or article[x] and kinds[x] == "M"
        if own > largest[p]:
            largest[p], second[p], top[p] = own, largest[p], x
        else:
            second[p] = max(second[p], own)
    # on the way down: articles and scopes around, text and largest article beside the way
    around, scope, rest, beside = [0] * (n + 1), [False] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    rest[n] = clean[n]
    out = set()
    for x in range(n):
        p, kind = parent[x], kinds[x]
        around[x] = around[p] + article[x]
        scope[x] = scope[p] or kind in "AM"
        rest[x] = clean[x] + (0 if kind in "AM" else rest[p])
        beside[x] = max(beside[p], second[p] if top[p] == x else largest[p])
        if kind not in "NCE" or hard[x]:
            continue
        articles = count[n] - around[p]
        if articles and not count[x]:
            continue
        large = size[x] > rest[p] and (not articles or largest[x] >= beside[x])
        if main[x] or large and (articles or kind == "N") or kind in "NE" and not scope[p] and articles == 1:
            out.add(x)
    return out


def blocks(html: str) -> list[tuple[str, int]]:
    """(text, zone) of each block in page order: zone 2 main text, 1 other
    text, 0 boilerplate by its element, role or name.  The time grows with the
    length of the page, not with the depth of its elements."""
    out: list[tuple[str, int]] = []
    open_: list[str] = []
    places: dict[str, list[int]] = {}  # depths of the open elements by name
    nested: list[int] = []  # depths of the open block elements
    # elements that decide zones: H boilerplate by element or hidden, E by element, N and C by name, A article, M main
    kinds: list[str] = []
    parents: list[int] = []
    stack: list[tuple[int, int]] = []  # (depth, mark) of the open ones
    text: list[str] = []

    def end_block() -> None:
        if text:
            s = " ".join("".join(text).split())
            if s:
                out.append((s, stack[-1][1] if stack else -1))
            text.clear()

    def mark(kind: str) -> None:
        end_block()
        parents.append(stack[-1][1] if stack else -1)
        kinds.append(kind)
        stack.append((len(open_), len(kinds) - 1))

    def close(depth: int) -> None:
        if stack and stack[-1][0] >= depth:
            end_block()
            while stack and stack[-1][0] >= depth:
                stack.pop()
        while len(open_) >= depth:
            places[open_.pop()].pop()
        while nested and nested[-1] >= depth:
            nested.pop()

    pos, last = 0, html.rfind(">") + 1
    while True:
        m = _TAG.search(html, pos, last)
        piece = html[pos: m.start() if m else len(html)]
        if piece:
            text.append(unescape(piece) if "&" in piece else piece)
        if not m:
            break
        pos = m.end()
        if m[2] is None:
            if pos == last and m[0].startswith("<!--") and not m[0].endswith("-->"):
                break
            continue
        name = m[2].lower()
        if m[1]:
            if places.get(name):
                if name in _BLOCK:
                    end_block()
                elif name in _SPACED:
                    text.append(" ")
                close(places[name][-1])
            continue
        if name in _RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(html, pos)
            pos = end.end() if end else len(html)
            continue
        if name in _SPACED:
            text.append(" ")
        if name in _BLOCK:
            end_block()
            if name != "head" and places.get("head"):  # its end tag may be left out
                close(places["head"][-1])
        if places.get("p") and name == "p" and nested[-1] == places["p"][-1] or name == "li" and open_ and open_[-1] == "li":
            close(places[name][-1])
        if name in _VOID or m[3].rstrip().endswith("/") and name not in _BLOCK:
            continue
        open_.append(name)
        places.setdefault(name, []).append(len(open_))
        if name in _BLOCK:
            nested.append(len(open_))
        attrs = _attributes(m[3]) if m[3] and name not in ("body", "html") else {}
        if attrs and name not in _MAIN and _hidden(attrs) or name in _OUT or name == "label" and (places.get("form") or places.get("fieldset")):
            mark("H")
        elif name in _MAIN:
            mark("M" if name == "main" else "A")
        elif name in _FORM:
            mark("N")
        elif name in _FRAME and not (name == "header" and (places.get("article") or places.get("main"))):
            mark("E")
        elif attrs:
            kind = _named(name, attrs)
            if kind:
                mark(kind)
    end_block()
    spared = _spared(kinds, parents, [(len(b), x) for b, x in out])
    drop, main = [False] * (len(kinds) + 1), [False] * (len(kinds) + 1)  # the last place is the page
    for i, (k, p) in enumerate(zip(kinds, parents)):
        drop[i] = drop[p] or k == "H" or k in "NCE" and i not in spared
        main[i] = main[p] or k in "AM"
    return [(b, 0 if drop[x] else 2 if main[x] else 1) for b, x in out]


# ---------------------------------------------------------------- repeated runs

def _joined(parts: dict[int, np.ndarray], width: int) -> np.ndarray:
    """Hash of the ``width`` tokens from each position on (the last positions have none)."""
    size = 1
    while size * 2 <= width:
        if size * 2 not in parts:
            h = parts[size]
            parts[size * 2] = mix64(h[:-size] * _ODD + h[size:]) if len(h) > size else h[:0]
        size *= 2
    h = parts[size]
    if size == width:
        return h
    rest = _joined(parts, width - size)
    n = max(0, len(parts[1]) - width + 1)
    return mix64(h[:n] * _ODD + rest[size: size + n] + np.uint64(width))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of the ``width`` values from each position on."""
    n, size = max(0, len(x) - width + 1), 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:]) if len(x) > size else x[:0]
        size *= 2
    return np.minimum(x[:n], x[width - size: width - size + n])


class Runs:
    """Windows of ``run`` tokens of some pages, each wholly inside or wholly
    outside the main text of one page.  ``block``, ``page`` and ``main`` have one
    value a window; ``key`` is its hash with the host."""

    def __init__(self, pages: list[list[str]], zones: list[list[int]], hosts: np.ndarray, run: int):
        flat = [b for p in pages for b in p]
        of_page = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
        main = np.array([z == 2 for p in zones for z in p], bool)
        doc, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for i, _, x in text_slices(pa.array(flat, pa.string())):
            d, s, e = x.runs(~SPACE[x.buf])
            doc.append(d + i)
            hashes.append(x.hashes(s, e))
        self.flat, self.of_page, self.block = flat, of_page, np.concatenate(doc)
        self.parts = {1: np.concatenate(hashes)}
        n = max(0, len(self.block) - run + 1)
        stretch = np.zeros(len(flat), np.int64)
        if len(flat):
            stretch[1:] = np.cumsum((np.diff(of_page) != 0) | (main[1:] != main[:-1]))
        of = stretch[self.block]
        self.at = np.flatnonzero(of[:n] == of[run - 1:]) if n else np.zeros(0, np.int64)
        first = self.block[self.at]
        self.page, self.main = of_page[first], main[first]
        self.host, self.run = hosts[self.page], run

    def keys(self) -> np.ndarray:
        return mix64(_joined(self.parts, self.run)[self.at] ^ self.host)

    def anchors(self) -> np.ndarray:
        """Of each window the least hash of its short runs: equal windows have equal anchors."""
        short = min(ANCHOR, self.run)
        return mix64(_least(_joined(self.parts, short), self.run - short + 1)[self.at] + self.host)


def _digests(pages: list[list[str]]) -> np.ndarray:
    """Number of each page's stream: pages with equal streams are one page."""
    return np.array([int.from_bytes(hashlib.blake2b("\n".join(p).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little",
                                    signed=True) for p in pages], np.int64)


def _read(b: pa.RecordBatch) -> tuple[list[list[str]], list[list[int]], np.ndarray]:
    got = [blocks(h) if h else [] for h in b.column(b.schema.get_field_index("html")).to_pylist()]
    hosts = b.column(b.schema.get_field_index("host_key")).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return [[x for x, _ in g] for g in got], [[z for _, z in g] for g in got], hosts


def _anchors(run: int):
    """Anchors of each page: (anchor, digest, outside), once a batch."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pages, zones, hosts = _read(b)
            r, digest = Runs(pages, zones, hosts, run), _digests(pages)
            a, d, out = r.anchors(), digest[r.page], ~r.main
            change = np.ones(len(a), bool)  # neighbours mostly share their anchor
            change[1:] = (a[1:] != a[:-1]) | (d[1:] != d[:-1]) | (out[1:] != out[:-1])
            a, d, out = a[change], d[change], out[change]
            o = np.lexsort((out, d, a))
            a, d, out = a[o], d[o], out[o]
            last = np.ones(len(a), bool)
            last[:-1] = (a[1:] != a[:-1]) | (d[1:] != d[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(a[last].view(np.int64)), pa.array(d[last]), pa.array(out[last])],
                                             names=["anchor", "digest", "outside"])
    return emit


def _tokens(flat: list[str]) -> list[str]:
    """The words of some blocks as they are compared: long ones by their digest."""
    return [w if len(w) <= 32 else "\x01" + hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
            for b in flat for w in b.split()]


def _suffixes(run: int, bits, shift: int):
    """Suffixes whose anchor may be repeated, in order, cut after ``run`` tokens: (host_key,
    suffix, key, part, least and greatest digest, the same of the pages with it inside main
    text, classes of pages, pages with it outside and inside), once a batch and part."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(bits.value, np.uint8)
        for b in batches:
            pages, zones, hosts = _read(b)
            part = b.column(b.schema.get_field_index("part")).to_numpy(zero_copy_only=False).astype(np.int64)
            r, digest = Runs(pages, zones, hosts, run), _digests(pages)
            place = r.anchors() >> np.uint64(shift)
            hit = (seen[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            key, page, main, at = r.keys()[hit], r.page[hit], r.main[hit], r.at[hit]
            words = _tokens(r.flat) if len(at) else []
            suffix = np.array([" ".join(words[i: i + run]) for i in at.tolist()], object)
            rank = np.unique(suffix, return_inverse=True)[1] if len(at) else np.zeros(0, np.int64)
            o = np.lexsort((main, page, part[page], rank, hosts[page]))
            key, page, main, suffix, rank = key[o], page[o], main[o], suffix[o], rank[o]
            new = np.ones(len(key), bool)  # once a page and side
            new[1:] = (rank[1:] != rank[:-1]) | (page[1:] != page[:-1]) | (main[1:] != main[:-1])
            key, page, main, suffix, rank = key[new], page[new], main[new], suffix[new], rank[new]
            p, d, h = part[page], digest[page], hosts[page].view(np.int64)
            new = np.ones(len(key), bool)
            new[1:] = (rank[1:] != rank[:-1]) | (p[1:] != p[:-1]) | (h[1:] != h[:-1])
            first = np.flatnonzero(new)
            big = np.iinfo(np.int64)
            over = lambda f, x: f.reduceat(x, first) if len(first) else x
            kind = np.left_shift(np.int64(1), d & 63)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[first]), pa.array(suffix[first].tolist(), pa.string()), pa.array(key[first].view(np.int64)), pa.array(p[first]),
                 pa.array(over(np.minimum, d)), pa.array(over(np.maximum, d)), pa.array(over(np.minimum, np.where(main, d, big.max))),
                 pa.array(over(np.maximum, np.where(main, d, big.min))), pa.array(over(np.bitwise_or, kind)),
                 pa.array(over(np.add, (~main).astype(np.int64))), pa.array(over(np.add, main.astype(np.int64)))],
                names=["host_key", "suffix", "key", "part", *_SUMS])
    return emit


def _intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk over a range of the suffix array: neighbours that agree in the whole cut suffix
    are one interval; those that are boilerplate are told.  Holds one interval at a time."""
    def verdict(h: int, suffix: str, v: list[int]) -> tuple | None:
        lo, hi, main_lo, main_hi, classes, n_out, n_main = v
        if lo < hi and n_out > 0:
            return h, suffix, main_lo < main_hi and n_out > n_main, (classes & (1 << 64) - 1).bit_count() < SPREAD
        return None

    fold = (min, max, min, max, int.__or__, int.__add__, int.__add__)
    last, now = None, []
    for b in batches:
        out = []
        cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("host_key", "suffix", *_SUMS)]
        for h, suffix, *v in zip(*cols):
            if last == (h, suffix):
                now = [f(x, y) for f, x, y in zip(fold, now, v)]
                continue
            if last and (t := verdict(*last, now)):
                out.append(t)
            last, now = (h, suffix), v
        if out:
            yield _bad_runs(out)
    if last and (t := verdict(*last, now)):
        yield _bad_runs([t])


def _bad_runs(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.bool_(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=["host_key", "suffix", "inside", "few"])


_SUMS = ["lo", "hi", "main_lo", "main_hi", "classes", "n_out", "n_main"]


def _bits(pages: pa.Table) -> pa.Table:
    """One page of the bit map of anchors."""
    place = pages.column("place").to_numpy()
    out = np.zeros(PAGE_BITS, np.uint8)
    out[place % PAGE_BITS] = 1
    return pa.table([pa.array([int(place[0]) // PAGE_BITS], pa.int64()),
                     pa.array([np.packbits(out, bitorder="little").tobytes()], pa.binary())], names=["page", "bits"])


def _texts(run: int):
    def texts(t: pa.Table, bad: pa.Table) -> pa.Table:
        pages, zones = t.column("blocks").to_pylist(), t.column("zones").to_pylist()
        lost: dict[int, list[int]] = {}
        if bad.num_rows and pages:
            r = Runs(pages, zones, t.column("host_key").to_numpy().astype(np.int64).view(np.uint64), run)
            runs = {(h, x): (i, f) for h, x, i, f in zip(*(bad.column(c).to_pylist() for c in ("host_key", "suffix", "inside", "few")))}
            words, hosts = _tokens(r.flat), t.column("host_key").to_pylist()
            wide, few = np.zeros(len(words) + 1, np.int64), np.zeros(len(words) + 1, np.int64)
            for j in np.flatnonzero(np.isin(r.keys(), bad.column("key").to_numpy().astype(np.int64).view(np.uint64))).tolist():
                i = int(r.at[j])
                got = runs.get((hosts[r.page[j]], " ".join(words[i: i + run])))
                if got and (got[0] or not r.main[j]):
                    edge = few if got[1] else wide
                    edge[i] += 1
                    edge[i + run] -= 1
            wide, few = np.cumsum(wide[:-1]) > 0, np.cumsum(few[:-1]) > 0
            few &= ~wide
            page = r.of_page[r.block]
            main = np.array([2 in z for z in zones], bool)
            n_few, left = np.bincount(page[few], minlength=len(pages)), np.bincount(page[~wide], minlength=len(pages))
            article = ~main & (n_few >= LONG) & (2 * n_few > left)
            for w in np.flatnonzero(wide | few & ~article[page]).tolist():
                lost.setdefault(int(r.block[w]), []).append(w)
            first = np.searchsorted(r.block, np.arange(len(r.flat) + 1))
        out, k = [], 0
        for p, zone in zip(pages, zones):
            want, keep = 2 if 2 in zone else 1, []
            for b, z in zip(p, zone):
                if k in lost:
                    gone = set(lost[k])
                    b = " ".join(w for j, w in enumerate(b.split(), int(first[k])) if j not in gone)
                if z == want and b:
                    keep.append(b)
                k += 1
            out.append("\n\n".join(keep))
        return pa.table([t.column("page_id"), t.column("url"), pa.array(out, pa.string()),
                         pa.array([len(x) for x in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return texts


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks that a page's text can come from: of a page with main text only that, and
    an empty block where other text stood between."""
    for b in batches:
        pages, zones, _ = _read(b)
        for i, (p, zone) in enumerate(zip(pages, zones)):
            if 2 in zone:
                use = [j for j, z in enumerate(zone) if z == 2 or j and zone[j - 1] == 2]
                pages[i], zones[i] = [p[j] if zone[j] == 2 else "" for j in use], [zone[j] for j in use]
        cols = [b.column(b.schema.get_field_index(c)) for c in ("page_id", "url", "host_key", "part")]
        yield pa.RecordBatch.from_arrays(
            [*cols, pa.array(pages, pa.list_(pa.string())), pa.array(zones, pa.list_(pa.int32()))],
            names=["page_id", "url", "host_key", "part", "blocks", "zones"])


def repeated_runs(p: DataFrame, run: int = RUN) -> DataFrame:
    """(part, host_key, key, suffix, inside, few): of every part the runs that are boilerplate on
    their host; ``inside``: also where they stand in main text; ``few``: on few classes of pages."""
    # Anchors on several pages, one of them outside main text: a superset of the anchors of
    # boilerplate.  The bit map only spares windows; what is decided comes from their counts.
    anchors = written(p.select("host_key", "html").mapInArrow(_anchors(run), "anchor long, digest long, outside boolean")
                      .groupBy("anchor").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"), F.max("outside").alias("out"))
                      .where("lo < hi AND out").select("anchor"), "repeated-anchors")
    size = min(max(16 * anchors.count(), PAGE_BITS), MAX_BITS)
    log = (size - 1).bit_length()
    place = F.shiftrightunsigned("anchor", 64 - log).alias("place")
    bits = bytearray((1 << log) // 8)
    for r in anchors.select(place, (F.shiftrightunsigned("anchor", 64 - log) / F.lit(PAGE_BITS)).cast("long").alias("page")) \
            .groupBy("page").applyInArrow(_bits, "page long, bits binary").collect():
        bits[r["page"] * PAGE_BITS // 8: (r["page"] + 1) * PAGE_BITS // 8] = r["bits"]
    shared = p.sparkSession.sparkContext.broadcast(bytes(bits))
    found = written(p.select("host_key", "part", "html").mapInArrow(
        _suffixes(run, shared, 64 - log), "host_key long, suffix string, key long, part long, " + ", ".join(f"{c} long" for c in _SUMS)), "suffixes")
    # a run of a third of all pages is told by SHARES rows at most when it is sorted
    each = found.groupBy("host_key", "suffix", F.pmod("part", F.lit(SHARES)).alias("share")).agg(
        *[{"lo": F.min, "hi": F.max, "main_lo": F.min, "main_hi": F.max, "classes": F.bit_or}.get(c, F.sum)(c).alias(c) for c in _SUMS])
    bad = written(each.drop("share").repartitionByRange("host_key", "suffix").sortWithinPartitions("host_key", "suffix")
                  .mapInArrow(_intervals, "host_key long, suffix string, inside boolean, few boolean"), "boilerplate")
    return found.select("host_key", "suffix", "key", "part").join(bad, ["host_key", "suffix"]) \
        .select("part", "host_key", "key", "suffix", "inside", "few")


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", run: int = RUN,
            chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    small_batches(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    p = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
                     F.col(html).cast("string").alias("html"), F.xxhash64(host).alias("host_key"))
    # only hosts of several chunks, at most one row per chunk_bytes of input; stored, so that
    # the planner knows the table's size when it chooses the join
    size = p.groupBy("host_key").agg(F.sum(F.octet_length("html")).alias("b")).where(F.col("b") >= chunk_bytes) \
        .select("host_key", (F.floor(F.col("b") / chunk_bytes) + 1).alias("chunks"))
    chunk = F.pmod(F.xxhash64("page_id", "url", "html"), F.coalesce("chunks", F.lit(1)))
    p = p.join(written(size, "large-hosts"), "host_key", "left") \
        .withColumn("part", F.xxhash64("host_key", chunk)).drop("chunks")
    kind = pages.schema[page_id].dataType.simpleString()
    parsed = p.select("page_id", "url", "host_key", "part", "html").mapInArrow(
        _parse, f"page_id {kind}, url string, host_key long, part long, blocks array<string>, zones array<int>")
    return parsed.groupBy("part").cogroup(repeated_runs(p, run).groupBy("part")) \
        .applyInArrow(_texts(run), f"page_id {kind}, url string, text string, n_chars long")
