"""Main text of HTML pages by tag-path ratios.

A page is read into text blocks, each with its root-to-leaf tag path (tags with
class and id). Per path the text length, punctuation and link share of its
blocks are summed; a path's ratios are text and punctuation per block, fused by
their product and the share of text outside links. The fused ratios are smoothed
along the page, by a kernel over the next two blocks on either side weighed by
how much of its path a neighbour shares, and inside the container that holds the
best paths, by depth below it; so headings, lists and tables of an article get
part of its ratio. Paths over a threshold, relative to the page's best, are
content.

Tags alone bar only what holds no running text (scripts, styles, hidden parts,
form controls) and HTML's own page furniture: nav, aside, form, and header and
footer outside an article. A container whose class, id or role says nothing but
advert, notice, comments and the like gets its ratio weighed down by ``DOUBT``;
as the threshold is relative, such a name can't empty a page by itself.

One page is one call of a pure function, so work is spread by page and holds one
page at a time; reading a page takes time in proportion to its length.

Null or empty html gives empty text; a page without content blocks too. Broken
markup is read as far as it goes: a ``<`` that opens no tag is text, a tag
without end is text, a quote without partner is an ordinary character (and from
a tag on that its quotes would leave open to the page's end, all quotes are), an
open comment or script runs to the end of the page, as in a browser, and an
element without end tag is closed by its follower from at most ``LEVELS`` levels
up. Repeated rows give equal results.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of the page's best smoothed ratio that content paths reach.
THRESHOLD = 0.05
#: Weight of the blocks at distance 0, 1, 2 along the page.
KERNEL = (1.0, 0.6, 0.3)
#: What is left of the best ratio one level down in the container of the best paths.
DECAY = 0.7
#: Paths of at least this share of the best smoothed ratio mark that container.
BEST = 0.5
#: Least likeness of two paths with one parent.
SIBLINGS = 0.5
#: Levels up that paths are compared over; beyond, they count as apart.
LEVELS = 64
#: Weight of a path through a container that is named as something else than content.
DOUBT = 0.02

# Element names of the HTML standard.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("script style noscript template iframe object svg math canvas audio video head title textarea select datalist button dialog menu".split())
FURNITURE = set("nav aside form fieldset".split())
EDGES = set("header footer".split())
RAW = set("script style textarea title noscript iframe template".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = set("html body article section div ul ol dl table td th main aside nav header footer form blockquote".split())

#: Words that name something else than content, words that say nothing, and words that name content.
OTHER = set("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent notice notices alert popup modal overlay comment comments reply replies disqus sidebar side widget widgets nav navbar navigation menu breadcrumb breadcrumbs header masthead footer share sharing social related recommended newsletter subscribe signup login search pagination pager toolbar copyright complementary contentinfo".split())
PLAIN = set("bar box list item wrap wrapper container inner outer section area block top bottom left right link links button buttons icon icons group row col column site page global".split())
CONTENT = set("article content post entry story main body text".split())
#: Of OTHER, what may name a part of an article inside one.
OF_ARTICLE = set("header footer banner side".split())

ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
PUNCTUATION = re.compile(r"[.,;:!?…、。，]")


@dataclass
class Paths:
    """Tag paths as numbers: 0 is the root, each other has a parent, a label and a depth."""

    parent: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])
    label: list[str] = field(default_factory=lambda: [""])
    doubted: list[bool] = field(default_factory=lambda: [False])
    known: dict[tuple[int, str], int] = field(default_factory=dict)

    def child(self, path: int, label: str, doubted: bool) -> int:
        if (path, label) not in self.known:
            self.known[path, label] = len(self.parent)
            self.parent.append(path)
            self.depth.append(self.depth[path] + 1)
            self.label.append(label)
            self.doubted.append(doubted or self.doubted[path])
        return self.known[path, label]

    def joint(self, p: int, q: int) -> int:
        """The deepest path that both lie under, 0 if it is over LEVELS up."""
        for _ in range(2 * LEVELS):
            if p == q:
                return p
            if self.depth[p] >= self.depth[q]:
                p = self.parent[p]
            else:
                q = self.parent[q]
        return 0

    def likeness(self, p: int, q: int, root: int) -> float:
        if p == q:
            return 1.0
        shared = self.depth[self.joint(p, q)] - root
        return max(SIBLINGS * (self.parent[p] == self.parent[q]), shared / max(1, max(self.depth[p], self.depth[q]) - root))


@dataclass
class Block:
    path: int
    text: str
    linked: int  # characters in links
    barred: bool


def named_otherwise(names: list[str], inside: bool) -> bool:
    """Do a container's names say that it holds something else than content?"""
    other = False
    for name in names:
        words = {w.lower() for w in WORDS.findall(name)}
        if words & CONTENT:
            return False
        noted = words & OTHER - (OF_ARTICLE if inside else set())
        other |= bool(noted) and words <= noted | PLAIN
    return other


class _Reader:
    """A page's marks in order; the next place of a character is looked for once."""

    def __init__(self, page: str):
        self.page, self.next, self.quotes = page, {}, True

    def seek(self, what: str, at: int) -> int:
        """First place of ``what`` from ``at`` on, the page's end if there is none."""
        since, found = self.next.get(what, (0, -1))
        if not since <= at <= found:
            found = self.page.find(what, at)
            found = len(self.page) if found < 0 else found
            self.next[what] = (at, found)
        return found

    def tag_end(self, at: int) -> int:
        """Place after the ``>`` of a tag, quoted values skipped; 0 if there is none."""
        n, since = len(self.page), at
        while (end := self.seek(">", at)) < n:
            quote = min(self.seek('"', at), self.seek("'", at)) if self.quotes else n
            if quote > end:
                return end + 1
            shut = self.seek(self.page[quote], quote + 1)
            at = shut + 1 if shut < n and self.page[max(at, quote - 9) : quote].rstrip().endswith("=") else quote + 1
        self.quotes = self.quotes and at == since
        return 0 if at == since else self.tag_end(since)


def blocks(page: str, paths: Paths) -> Iterator[Block]:
    """Text blocks in page order."""
    reader, n = _Reader(page), len(page)
    stack: list[tuple[str, int, bool]] = []  # tag, path, barred
    opened: list[dict[str, int]] = [{}]  # open elements by tag, anew in each body
    articles = 0
    text: list[str] = []
    linked = anchors = at = 0

    def flush() -> Iterator[Block]:
        nonlocal linked
        joined = " ".join(entities.unescape("".join(text)).split())
        if joined:
            yield Block(stack[-1][1] if stack else 0, joined, linked, bool(stack) and stack[-1][2])
        text.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece:
            text.append(piece)
            linked += len(piece.strip()) * (anchors > 0)

    def shut(i: int) -> None:
        nonlocal articles
        for tag, _, _ in stack[i:]:
            opened[-1][tag] -= 1
            articles -= tag in ("article", "main")
        del stack[i:]

    while at < n:
        mark = reader.seek("<", at)
        add(page[at:mark])
        if mark == n:
            break
        if page.startswith("<!--", mark):
            at = min(n, reader.seek("-->", mark + 2) + 3)
            continue
        closing = page.startswith("/", mark + 1)
        name = NAME.match(page, mark + 1 + closing)
        if page[mark + 1 : mark + 2] in ("!", "?"):
            end = reader.seek(">", mark)
            at = end + 1
            add(page[mark:] if end == n else "")
            continue
        end = reader.tag_end(name.end()) if name else 0
        if not end:
            add("<")
            at = mark + 1
            continue
        at, tag = end, name[0].lower()
        if tag in RAW and not closing:
            last = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = last.end() if last else n
            text.append(" ")
            continue
        if tag in INLINE:
            anchors = max(0, anchors + (-1 if closing else 1)) if tag == "a" else anchors
            continue
        if tag == "br":
            text.append(" ")
            continue
        yield from flush()
        if closing:
            if tag not in ("html", "body") and opened[-1].get(tag):
                shut(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
            anchors = 0 if tag in SCOPES else anchors
            continue
        ends = CLOSES.get(tag, ()) or (("p",) if tag in CLOSES_P else ())
        if any(opened[-1].get(t) for t in ends):
            for i in range(len(stack) - 1, max(-1, len(stack) - 1 - LEVELS), -1):
                if stack[i][0] in ends:
                    shut(i)
                elif stack[i][0] in SCOPES:
                    break
        inner = page[name.end() : end - 1]
        if tag in VOID or inner.endswith("/"):
            continue
        given = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(inner)} if inner else {}
        names = [w for k in ("class", "id", "role") for w in given.get(k, "").split()]
        inside = articles > 0
        barred = bool(stack) and stack[-1][2] or tag in HIDDEN or tag in FURNITURE or tag in EDGES and not inside
        barred = barred or "hidden" in given or given.get("aria-hidden", "").lower() == "true" or bool(re.search(r"display\s*:\s*none", given.get("style", ""), re.I))
        doubted = tag not in ("html", "body") and named_otherwise(names, inside)
        stack.append((tag, paths.child(stack[-1][1] if stack else 0, " ".join([tag, *names]), doubted), barred))
        if tag in ("html", "body"):
            opened.append({})
        else:
            opened[-1][tag] = opened[-1].get(tag, 0) + 1
        articles += tag in ("article", "main")
    yield from flush()


def ratios(found: list[Block], paths: Paths) -> dict[int, float]:
    """Smoothed and fused ratio of every path."""
    sums: dict[int, list[int]] = {}
    root = found[0].path
    for b in found:
        root = paths.joint(root, b.path)
        s = sums.setdefault(b.path, [0, 0, 0, 0])
        for i, v in enumerate((1, len(b.text), len(PUNCTUATION.findall(b.text)), min(b.linked, len(b.text)))):
            s[i] += v
    level = min(paths.depth[root], min(paths.depth[p] for p in sums) - 1) if len(sums) > 1 else 0
    fused = {p: length / k * (1 + marks) / k * (1 - linked / length) for p, (k, length, marks, linked) in sums.items()}
    best: dict[int, float] = {}
    for i, b in enumerate(found):
        near = ((j, found[j].path) for j in range(max(0, i - 2), min(len(found), i + 3)))
        smooth = sum(KERNEL[abs(i - j)] * paths.likeness(b.path, p, level) * fused[p] for j, p in near)
        best[b.path] = max(best.get(b.path, 0.0), smooth)
    weigh = lambda p, x: x * (DOUBT if paths.doubted[p] else 1.0)
    top = max(weigh(p, x) for p, x in best.items())
    tops = [p for p, x in best.items() if weigh(p, x) >= BEST * top]
    main = reduce(paths.joint, tops) if len(tops) > 1 else paths.parent[tops[0]]
    if paths.label[main] not in ("", "html", "body"):
        for p in best:
            if paths.joint(p, main) == main:
                best[p] = max(best[p], max(fused[t] for t in tops) * DECAY ** (paths.depth[p] - paths.depth[main]))
    return {p: weigh(p, x) for p, x in best.items()}


def main_text(page: str | None) -> str:
    paths = Paths()
    found = [b for b in blocks(page or "", paths) if not b.barred]
    if not found:
        return ""
    best = ratios(found, paths)
    least = THRESHOLD * max(best.values())
    return " ".join(b.text for b in found if best[b.path] >= least)


def extract(pages: DataFrame, *, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with the main text of each page's html."""

    @F.arrow_udf("string")
    def extracted(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(x) for x in pages.to_pylist()], pa.string())

    return pages.withColumn(out_col, extracted(F.col(html_col)))


def op3_tag_path_extract(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
