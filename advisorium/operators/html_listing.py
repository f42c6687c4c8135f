"""Entries of listing pages, found by the repetition of cards around their detail links.

A card is the largest subtree that holds one detail address.  Where the parts of an entry are
siblings without a wrapper, the card is the run of siblings of one period, from one detail link to the
next.  The walk gives the texts of each card; code, date, severity and counts are read from them by
expressions, so they always come from one card.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.severity import LEVEL_WORDS, severity_normalize
from ..functions.text import url_resolve
from ..functions.times import date_iso
from .html_tables import VOID, walked
from .html_walk import Walk

HIDDEN = frozenset("script style template noscript".split())
ENTRY_TAGS = frozenset("a article dl li section tr".split())  # where an only entry's card ends
CLOSED_BY = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
HOLDERS = frozenset("dl ol table tbody thead tfoot tr ul".split())
HELD_BY = {tag: HOLDERS - ends for tag, ends in CLOSED_BY.items()}
HEADINGS = frozenset(f"h{k}" for k in range(1, 7))
LABEL = re.compile(r"\b(?:tag|badge|label|status)\b")
DATED = ("data-date", "datetime")
LISTING = "struct<text:string,cards:array<struct<href:string,title:string,pieces:array<string>>>>"
ARROW = pa.struct([("text", pa.string()), ("cards", pa.list_(pa.struct([("href", pa.string()), ("title", pa.string()), ("pieces", pa.list_(pa.string()))])))])


class _Node:
    """An element; its subtree is a run of the tree's nodes, texts and pieces, from the first numbers to the last ones."""

    __slots__ = ("tag", "attrs", "parent", "kids", "details", "links", "first", "last")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: _Node | None, first: tuple[int, int, int]):
        self.tag, self.attrs, self.parent, self.first, self.last = tag, attrs, parent, first, first
        self.kids: list[_Node | str] = []
        self.details: set[str] = set()  # detail addresses in this subtree
        self.links: set[str] = set()  # all addresses in it


class _Tree(Walk):
    """A light tree; end tags that fit nothing are ignored, and li, tr, td, p, dt and dd end where the next one begins."""

    def __init__(self) -> None:
        super().__init__()
        self.nodes, self.texts, self.pieces = 1, [], []  # in document order; pieces are texts and dates of attributes
        self.marked, self.tags, self.links = [], [], []  # titles and headings, labels, links
        self.root = self.at = _Node("", {}, None, (0, 0, 0))
        self.hidden = 0

    def _climb(self, node: _Node) -> None:
        """The open elements below ``node`` end here."""
        here, at = (self.nodes, len(self.texts), len(self.pieces)), self.at
        while at is not node:
            at.last = here
            at = at.parent
        self.at = node

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in HIDDEN:
            self.hidden += 1
        if ends := CLOSED_BY.get(tag):
            node, holders, to = self.at, HELD_BY[tag], self.at
            while node.parent and node.tag not in holders:
                if node.tag in ends:
                    to = node.parent
                node = node.parent
            self._climb(to)
        node = _Node(tag, dict(attrs), self.at, (self.nodes, len(self.texts), len(self.pieces)))
        self.nodes += 1
        self.at.kids.append(node)
        if tag in HEADINGS or attrs:
            self._note(node)
        if tag not in VOID:
            self.at = node
        else:
            node.last = (self.nodes, len(self.texts), len(self.pieces))

    def _note(self, node: _Node) -> None:
        attrs = node.attrs
        style = attrs.get("class") or ""
        if node.tag in HEADINGS or "title" in style:
            self.marked.append(node)
        if style and LABEL.search(style.replace("-", " ")):
            self.tags.append(node)
        if node.tag == "a" and attrs.get("href"):
            self.links.append(node)
        if date := next((attrs[k] for k in DATED if attrs.get(k)), None):
            self.pieces.append(date)

    def handle_endtag(self, tag: str) -> None:
        if tag in HIDDEN and self.hidden:
            self.hidden -= 1
        node = self.at
        while node.parent and node.tag != tag:
            node = node.parent
        if node.parent:
            self._climb(node.parent)

    def handle_data(self, data: str) -> None:
        if not self.hidden and (text := " ".join(data.split())):
            self.at.kids.append(text)
            self.texts.append(text)
            self.pieces.append(text)

    def close(self) -> None:
        super().close()
        self._climb(self.root)
        self.root.last = (self.nodes, len(self.texts), len(self.pieces))

    def inside(self, nodes: list[_Node], first: int, last: int) -> list[_Node]:
        """Those of ``nodes`` whose number lies from ``first`` up to ``last``."""
        number = lambda n: n.first[0]
        return nodes[bisect_left(nodes, first, key=number) : bisect_left(nodes, last, key=number)]

    def text_of(self, node: _Node) -> str:
        """The texts in an element without those of labels in it."""
        found, at = [], node.first[1]
        for tag in self.inside(self.tags, node.first[0] + 1, node.last[0]):
            found += self.texts[at : tag.first[1]]
            at = max(at, tag.last[1])
        return " ".join(found + self.texts[at : node.last[1]])


def _title(tree: _Tree, link: _Node, nodes: tuple[int, int], pieces: list[str], alone: bool) -> str:
    """The part that is marked as title or heading, else the link, else the first text; a tag marked as label or status is no part of it."""
    for node in [*tree.inside(tree.marked, *nodes), link]:
        text = tree.text_of(node)
        if text and (node is not link or not alone):
            return text
    return pieces[0] if pieces else ""


def _starts(around: list[_Node | str]) -> tuple[list[int], int]:
    """(places where the run of an entry begins, least distance of two) among siblings."""
    starts = [i for i, x in enumerate(around) if isinstance(x, _Node) and x.details]
    firsts = [i for n, i in enumerate(starts) if not n or around[i].details != around[starts[n - 1]].details]
    return firsts, min((b - a for a, b in zip(firsts, firsts[1:])), default=1)


def _cards(html: str | None, detail: re.Pattern) -> tuple[str, list[tuple[str, str, list[str]]]]:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    links = [x for x in tree.links if detail.search(x.attrs["href"])]
    for link in links:
        href, node = link.attrs["href"], link
        while node and href not in node.details:  # what holds an address holds it up to the root
            node.details.add(href)
            node = node.parent
    alone = len(tree.root.details) == 1
    for link in tree.links if alone else ():
        href, node = link.attrs["href"], link
        while node and href not in node.links:
            node.links.add(href)
            node = node.parent
    out, done, seen = [], set(), {}
    for link in links:
        href, node = link.attrs["href"], link
        if href in done:
            continue
        done.add(href)
        whole = link.last[2] - link.first[2] > 1  # the link is a card by itself
        while node.parent and len(node.parent.details) == 1:
            if alone and (len(node.parent.links) > 1 or node.tag in ENTRY_TAGS and (whole or node is not link)):
                break  # no other entry says where this one ends
            node = node.parent
        around = node.parent.kids if node.parent else [node]
        if id(around) not in seen:
            seen[id(around)] = (around, *_starts(around), {id(x): i for i, x in enumerate(around) if isinstance(x, _Node)})
        _, firsts, period, places = seen[id(around)]
        at = places[id(node)]
        after = bisect_right(firsts, at)
        card = around[at : firsts[after] if after < len(firsts) else at + period]
        end = next(i for i in range(len(card) - 1, -1, -1) if isinstance(card[i], _Node))
        last = card[end].last
        pieces = tree.pieces[node.first[2] : last[2] + len(card) - 1 - end]
        out.append((href, _title(tree, link, (node.first[0], last[0]), pieces, len(card) == 1 and node is link), pieces))
    return " ".join(tree.pieces), out


def listing(html: Column | str, detail: str) -> Column:
    """struct(text, cards): all text of a listing page, and for each address that ``detail`` finds its card's title and texts."""
    pattern = re.compile(detail)

    @F.arrow_udf(LISTING)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield walked(pages, lambda html: _cards(html, pattern), ARROW)

    return run(html)


def _number(c: Column) -> Column:
    return F.replace(F.nullif(c, F.lit("")), F.lit(","), F.lit("")).try_cast("long")


def listing_totals_of(text: Column, html: Column, shown: Column) -> tuple[Column, Column]:
    """(records, pages) of a listing: what the page says of itself, else its largest page link, else as many pages as full ones of this size hold."""
    records = F.coalesce(_number(F.regexp_extract(text, r"共\s*([\d,]+)\s*条", 1)), _number(F.regexp_extract(text, r"(?i)\b(?:total|of)\s*:?\s*([\d,]+)\s+(?:records|results|entries|items)", 1)))
    pages = F.coalesce(_number(F.regexp_extract(text, r"(?:/|共)\s*([\d,]+)\s*页", 1)), _number(F.regexp_extract(text, r"(?i)\bpage\s+\d+\s+of\s+([\d,]+)", 1)))
    linked = F.array_max(F.transform(F.regexp_extract_all(html, F.lit(r"[?&;]page=(\d+)"), F.lit(1)), lambda x: x.try_cast("long")))
    return records, F.coalesce(pages, linked, F.when(shown > 0, F.ceil(records / shown)))


def listing_entries(pages: DataFrame, detail: str, base: str) -> DataFrame:
    """pages(page_id, html) -> page_id, pos, code, href, title, date, severity, counts, total_records, total_pages.

    ``detail`` is a pattern for the addresses of entries; its first group, if it has one, is the code,
    else the last part of the path is.  ``date`` is the first date in the card, ``severity`` the
    first text that names a level, ``counts`` all whole numbers in order.  Missing parts are null, or
    no counts.  Pages without entries give no row.
    """
    p = pages.select("page_id", "html", listing("html", detail).alias("l"))
    records, total = listing_totals_of(F.col("l.text"), F.col("html"), F.size("l.cards"))
    rows = p.select("page_id", records.alias("total_records"), total.alias("total_pages"), F.posexplode("l.cards").alias("pos", "c"))
    group = re.compile(detail).groups
    code = F.regexp_extract("c.href", detail, 1) if group else F.regexp_extract(F.regexp_replace("c.href", r"[?#].*$|/+$", ""), r"([^/]+)/*$", 1)
    value = F.transform("c.pieces", lambda x: F.trim(F.regexp_replace(x, r"^[^:：]{1,24}[:：]\s*", "")))
    dated = F.get(F.filter("c.pieces", lambda x: x.rlike(r"\d{4}[-/.]\d{1,2}[-/.]\d{1,2}")), F.lit(0))
    rows = rows.select("*", value.alias("value"), dated.alias("dated"))
    value = F.col("value")
    levels = F.filter(F.transform(F.filter(value, lambda x: x.rlike(LEVEL_WORDS) & ~x.rlike(r"\d")), severity_normalize), lambda x: x != "Unknown")
    counts = F.transform(F.filter(value, lambda x: x.rlike(r"^\d[\d,]*$")), _number)
    return rows.select(
        "page_id", "pos", F.nullif(code, F.lit("")).alias("code"), url_resolve(F.col("c.href"), base).alias("href"), F.nullif(F.col("c.title"), F.lit("")).alias("title"),
        date_iso(F.col("dated")).alias("date"), F.get(levels, F.lit(0)).alias("severity"), counts.alias("counts"), "total_records", "total_pages",
    )
