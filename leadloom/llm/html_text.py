"""Main text of web pages: site templates removed by counted subtree hashes, page structure for the rest.

Each page is read once into blocks of text and the elements that hold them. Every element's subtree (its tag and the
text of its blocks) has a hash; Spark counts, for each host, on how many different pages a hash occurs, and a subtree
that is on at least LEAST_PAGES and on SHARE of the host's different pages is the site's template and goes. Copies of
one page count once, so an article that is mirrored on a host isn't taken for a template.

What differs from page to page is told by structure. Elements for menus, footers, sidebars and dialogs go. Elements
whose class, id or role names a part that isn't the article go as well, and so do forms, unless they hold most of the
page's other text: then they are a wrapper. A name counts as a whole ("sidebar", not "with-sidebar"), by its last part
("site-footer", unless the first says no or with) or, of reader comments, by its first ("comment-body"). Where articles
(or else main elements) hold at least a third of what is left, only they count.

A host's templates are few (each is on a quarter of its pages, so there are at most four times a page's subtrees); they
come back to the pages by a join on the host, broadcast if there are at most BROADCAST of them in all, else by host and
a salt, so that no host is one task.

Defined results: null or empty html gives an empty text; a null url counts as a host of its own; markup cut off at the
end of a page is dropped; repeated rows give repeated results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

SHARE, LEAST_PAGES, BROADCAST, SALTS = 0.25, 5, 100_000, 32
#: Share of the other text from which on a marked element is a wrapper, characters that it needs then, and share of the
#: text that articles need to stand for the page.
WRAPPER, WRAPPED, ARTICLE = 0.5, 200, 1 / 3

_TAG = re.compile(r"<!--(?s:.*?)(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/a-zA-Z][^<>]*+(?:>|\Z|(?=<))|<\Z")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
#: Modulus and base of the rolling hash over a page's blocks.
_PRIME, _BASE = (1 << 61) - 1, 0x5BD1E995_9E3779B1 % ((1 << 61) - 1)
_SPAN = re.compile(r"<(/?)span\b[^>]*>", re.I)
_RAW = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in ("script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object", "select", "button", "canvas", "audio", "video")}
#: Elements that are no article text, elements that hold blocks, and other blocks.
_ASIDE = frozenset("nav footer aside head menu dialog".split())
_HOLDERS = frozenset("div section article main header table ul ol dl blockquote figure details body form fieldset".split())
_BLOCKS = _ASIDE | _HOLDERS | frozenset("p h1 h2 h3 h4 h5 h6 li tr dt dd pre hr figcaption summary address caption html".split())
#: Blocks that the start of another one ends.
_ENDED_BY = {"p": _BLOCKS, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr"}), **{f"h{k}": frozenset(f"h{n}" for n in range(1, 7)) for k in range(1, 7)}}
#: Names, as a class, id or role has them, of what isn't the article.
_MARKS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert "
    "comment comments disqus respond reply replies share sharing social related recommended newsletter subscribe subscription signup popup modal overlay pagination pager footer masthead topbar toolbar skip widget "
    "search searchbox login contentinfo complementary".split()
)
_COMMENTS = frozenset("comment comments reply replies".split())
_NOT = frozenset("no not non with without has have is hide show".split())


def _marked(attributes: str) -> bool:
    for m in _NAMES.finditer(attributes):
        for name in m[1].lower().strip("\"'").split():
            parts = [x for x in re.split(r"[-_]+", name) if x]
            if parts and (name in _MARKS or parts[0] not in _NOT and (parts[-1] in _MARKS or parts[0] in _COMMENTS)):
                return True
    return False


class Element:
    """A block element: its tag, whether its names mark it, its first block and the block after its last."""

    __slots__ = ("tag", "marked", "first", "stop", "outer")

    def __init__(self, tag: str, marked: bool, first: int, outer: bool):
        self.tag, self.marked, self.first, self.stop, self.outer = tag, marked, first, -1, outer


class KeptSizes:
    """Sizes of a page's blocks, of which runs are dropped: each block goes once, and what is left of a run is a difference
    of Fenwick sums."""

    def __init__(self, size: list[int]):
        n = len(size)
        self.size, self.total, self.next, self.tree = size, sum(size), list(range(n + 1)), [0, *size]
        for k in range(1, n + 1):
            if (up := k + (k & -k)) <= n:
                self.tree[up] += self.tree[k]

    def _first_kept(self, k: int) -> int:
        root = k
        while self.next[root] != root:
            root = self.next[root]
        while self.next[k] != root:
            self.next[k], k = root, self.next[k]
        return root

    def drop(self, first: int, stop: int) -> None:
        k = self._first_kept(first)
        while k < stop:
            self.next[k] = k + 1
            self.total -= self.size[k]
            at = k + 1
            while at < len(self.tree):
                self.tree[at] -= self.size[k]
                at += at & -at
            k = self._first_kept(k)

    def _before(self, k: int) -> int:
        total = 0
        while k:
            total, k = total + self.tree[k], k & (k - 1)
        return total

    def left(self, first: int, stop: int) -> int:
        return self._before(stop) - self._before(first) if stop > first else 0

    def kept(self) -> list[bool]:
        return [self.next[k] == k for k in range(len(self.size))]


class Page:
    """Blocks of a page, its elements, its subtrees as (hash, first block, block after the last), and which blocks
    structure leaves. Time is in proportion to the page, but for a logarithm, however deep its elements are nested."""

    def __init__(self, source: str):
        self.blocks: list[str] = []
        self.elements: list[Element] = []
        self.subtrees: list[tuple[int, int, int]] = []
        self._read(source)
        self.kept = self._kept()

    def _read(self, source: str) -> None:
        from xxhash import xxh3_64_intdigest

        blocks, open_, text = self.blocks, [], []
        at, tag_of_text, articles = 0, "", 0
        last_ends: dict[str, int] = {}
        open_tags: dict[str, int] = {}
        open_asides: dict[str, list[Element]] = {t: [] for t in _ASIDE}
        spans: dict[int, int] | None = None
        rolled, power = [0], [1]  # of the hashes of the blocks so far

        def last_end(tag: str) -> int:
            if tag not in last_ends:
                last_ends[tag] = source.lower().rfind(f"</{tag}")
            return last_ends[tag]

        def end() -> None:
            if text:
                words = " ".join(entities.unescape("".join(text)).split())
                text.clear()
                if words:
                    own = xxh3_64_intdigest(f"{tag_of_text}\0{words}")
                    self.subtrees.append((own - (1 << 63), len(blocks), len(blocks) + 1))
                    blocks.append(words)
                    rolled.append((rolled[-1] * _BASE + xxh3_64_intdigest(words)) % _PRIME)
                    power.append(power[-1] * _BASE % _PRIME)

        def close(depth: int) -> None:
            nonlocal articles
            while len(open_) > depth:
                x = open_.pop()
                open_tags[x.tag] -= 1
                articles -= x.tag in ("article", "main")
                if x.stop < 0:
                    x.stop = len(blocks)
                    if x.tag in _ASIDE:
                        open_asides[x.tag].pop()
                if x.stop - x.first > 1 and x.tag in _HOLDERS | _ASIDE:
                    inner = (rolled[x.stop] - rolled[x.first] * power[x.stop - x.first]) % _PRIME
                    self.subtrees.append((xxh3_64_intdigest(f"{x.tag}\0{x.stop - x.first}\0{inner}") - (1 << 63), x.first, x.stop))

        while at < len(source):
            m = _TAG.search(source, at)
            if m is None:
                break
            if m.start() > at:
                text.append(source[at : m.start()])
            at = m.end()
            tag = m[2] and m[2].lower()
            if not tag:
                continue
            closing, alone = bool(m[1]), m[3].endswith("/")
            if tag in _RAW:
                if not closing and not alone:
                    stop = _RAW[tag].search(source, at)
                    at = stop.end() if stop else len(source)
                continue
            if tag in ("br", "td", "th"):
                text.append(" ")
            elif tag == "span":
                if not closing and not alone and _marked(m[3]):
                    spans = self._spans(source) if spans is None else spans
                    at = spans.get(at, at)
            elif tag in _BLOCKS:
                end()
                tag_of_text = tag
                if closing:
                    if open_tags.get(tag):
                        depth = len(open_) - 1
                        while open_[depth].tag != tag:
                            depth -= 1
                        close(depth)
                    continue
                if open_ and tag in _ENDED_BY.get(open_[-1].tag, ()):
                    close(len(open_) - 1)
                if tag in ("article", "main"):  # a part that was left open before the article
                    for aside, some in open_asides.items():
                        if some and last_end(aside) < at:
                            for x in some:
                                x.stop = len(blocks)
                            some.clear()
                if not alone and tag != "hr":
                    x = Element(tag, _marked(m[3]), len(blocks), not articles)
                    open_.append(x)
                    open_tags[tag] = open_tags.get(tag, 0) + 1
                    articles += tag in ("article", "main")
                    if tag in _ASIDE:
                        open_asides[tag].append(x)
                    self.elements.append(x)
        if at < len(source):
            text.append(source[at:])
        end()
        close(0)

    @staticmethod
    def _spans(source: str) -> dict[int, int]:
        """Where each span begins -> the place behind its end; spans that don't end are left out."""
        open_, out = [], {}
        for m in _SPAN.finditer(source):
            if not m[1]:
                open_.append(m.end())
            elif open_:
                out[open_.pop()] = m.end()
        return out

    def _kept(self) -> list[bool]:
        sizes = KeptSizes([len(x) for x in self.blocks])
        articles = sorted((x for x in self.elements if x.tag in ("article", "main") and x.stop > x.first), key=lambda x: x.first)
        starts, least = [x.first for x in articles], [(len(self.blocks) + 1, None)] * 2
        ends = [least]  # from each article on, the two that end first
        for x in reversed(articles):
            least = sorted([*least, (x.stop, x)], key=lambda p: p[0])[:2]
            ends.append(least)
        ends.reverse()

        def has_article(x: Element) -> bool:
            return any(stop <= x.stop and y is not x for stop, y in ends[bisect_left(starts, x.first)])

        for x in self.elements:
            if x.tag in _ASIDE or x.tag == "header" and x.outer and not has_article(x):
                sizes.drop(x.first, x.stop)
        for x in self.elements:
            if x.tag in ("form", "fieldset") or x.marked and x.tag not in ("body", "html"):
                own = sizes.left(x.first, x.stop)
                if not (own > WRAPPER * sizes.total and (own >= WRAPPED or has_article(x))):
                    sizes.drop(x.first, x.stop)
        kept = sizes.kept()
        for tag in ("article", "main"):
            edges = [0] * (len(kept) + 1)
            for x in self.elements:
                if x.tag == tag and x.stop > x.first:
                    edges[x.first] += 1
                    edges[x.stop] -= 1
            inside = [k and d > 0 for k, d in zip(kept, accumulate(edges), strict=False)]
            own = sum(n for n, i in zip(sizes.size, inside, strict=True) if i)
            if own and own >= ARTICLE * sizes.total:
                return inside
        return kept

    def text(self, templates: frozenset[int] | set[int]) -> str:
        kept = self.kept
        if templates:
            edges = [0] * (len(kept) + 1)
            for h, a, b in self.subtrees:
                if h in templates:
                    edges[a] += 1
                    edges[b] -= 1
            kept = [k and not d for k, d in zip(kept, accumulate(edges), strict=False)]
        return "\n\n".join(x for x, k in zip(self.blocks, kept, strict=True) if k)


def site_templates(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(host, templates): hashes of the subtrees that recur; pages has host and key columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted({h for h, _, _ in Page(t.as_py()).subtrees}) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.int64()))], ["host", "key", "hashes"])

    each = pages.select("host", "key", html_col).mapInArrow(run, "host string, key bigint, hashes array<bigint>")
    # the page itself counts as a subtree (null), for the host's number of different pages
    rows = each.select("host", "key", F.explode(F.concat(F.array(F.lit(None).cast("long")), "hashes")).alias("hash"))
    counts = rows.distinct().groupBy("host", "hash").agg(F.count("*").alias("n")).where((F.col("n") >= LEAST_PAGES) | F.col("hash").isNull())
    size = counts.where("hash is null").select("host", F.col("n").alias("pages"))
    often = counts.where("hash is not null").join(size, "host").where(F.col("n") >= SHARE * F.col("pages"))
    return often.groupBy("host").agg(F.collect_list("hash").alias("templates"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    host = F.lower(F.coalesce(F.regexp_extract(url_col, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    source = F.coalesce(html_col, F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), source.alias("html"))
    templates = cut(site_templates(rows.withColumn("key", F.xxhash64("html"))))
    few = (templates.agg(F.sum(F.size("templates"))).first()[0] or 0) <= BROADCAST
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [Page(t.as_py()).text(set(x.as_py() or ())) for t, x in zip(b.column(2), b.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.string()), pa.array([len(x) for x in got], pa.int64())], ["page_id", "url", "text", "n_chars"])

    if few:
        known = rows.join(F.broadcast(templates), "host", "left")
    else:
        salted = templates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        known = rows.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    known = known.select("page_id", "url", "html", "templates")
    return known.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
