"""Main text of web pages by inferred wrappers.

A wrapper is a union-free regular expression over a host's pages: a tree of elements in which every
node is required, optional ``( )?`` or repeated ``( )+``, and every text is a constant or a slot.
It starts as the first page; each further page is aligned with it level by level: equal elements
pair off in order, what only one side has becomes optional, equal neighbours fold into a repeated
group, and texts that differ become slots.  Tasks fold their own pages, partial wrappers are aligned
in two more steps, so a host with a third of all pages is spread like any other.  Pages of a host
with article, with main, with both and with neither are templates of their own, each with its
wrapper.  The wrapper then tells which text slots are the article; pages are read with those paths.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

BROADCAST_BYTES = 4_000_000
FOLDS = 32

# Elements and attribute words of the HTML language and of common page furniture.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = ("script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "head", "textarea")
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split())
FURNITURE_TAGS = frozenset("nav footer aside form menu button select dialog label input".split())
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer "
    "footer header masthead menu modal nav navbar navigation newsletter notice notification pagination popup promo promoted promotion related "
    "replies reply respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
ROOT_TAGS = ("article", "main")
ROOT_SHARE = 0.5  # an element is the article if it holds this share of the free text outside links
CONSTANT_PAGES = 3  # pages from which a text that never differs is part of the template
DEEPEST = 256  # elements within each other that are told apart
LONG_TEXT = 200  # longer constants are held as digests
P_ENDERS = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SAME_ENDERS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

# A quote means something at the beginning of a value only.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}


def scan(page: str) -> Iterator[tuple[str, str]]:
    """('+', label), ('-', tag) and ('', text) in page order; raw elements and comments are left out, unclosed elements are closed.

    What lies deeper than ``DEEPEST`` elements counts as part of the element at that depth; blocks there are still apart.
    """
    at, stack = 0, []

    def closed() -> tuple[str, str]:
        tag = stack.pop()
        return ("-", tag) if len(stack) < DEEPEST else ("", "" if tag in INLINE else " ")

    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            yield "", page[at:]
            break
        if m.start() > at:
            yield "", page[at : m.start()]
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in stack:
                while stack[-1] != tag:
                    yield closed()
                yield closed()
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        while stack and (stack[-1] == "p" or (stack[-1] in INLINE and "p" in stack)) and tag in P_ENDERS:
            yield closed()
        if stack and tag in SAME_ENDERS and stack[-1] in SAME_ENDERS[tag]:
            yield closed()
        marks = " ".join(x for a in _ATTRIBUTE.findall(m[3]) for x in a if x).lower().split() if m[3] else []
        deep = len(stack) >= DEEPEST
        yield ("", "" if tag in INLINE else " ") if deep else ("+", tag + "".join("." + w for w in sorted(set(marks))))
        stack.append(tag)
        if tag in VOID or (m[3] or "").endswith("/"):
            yield closed()
    while stack:
        yield closed()


@dataclass
class Node:
    label: str  # "#" for text
    optional: bool = False
    repeated: bool = False
    text: str | None = None  # constant text, None for a slot
    chars: int = 0
    pages: int = 1
    children: list[Node] = field(default_factory=list)

    def dump(self) -> list:
        return [self.label, self.optional, self.repeated, self.text, self.chars, self.pages, [c.dump() for c in self.children]]

    @staticmethod
    def load(x: list) -> Node:
        return Node(*x[:6], [Node.load(c) for c in x[6]])

    def __str__(self) -> str:
        if self.label == "#":
            body = "#TEXT" if self.text is None or self.text[:1] == "\0" else self.text
        else:
            body = f"<{self.label}>{''.join(map(str, self.children))}</>"
        return f"({body})+" if self.repeated else f"({body})?" if self.optional else body


def page_tree(page: str) -> Node:
    """The wrapper of a single page: neighbours with equal labels are already one repeated group."""
    root = Node("")
    path = [root]
    for kind, value in scan(page):
        if kind == "+":
            node = Node(value)
            path[-1].children.append(node)
            path.append(node)
        elif kind == "-":
            done = path.pop()
            done.children = fold_neighbours(done.children)
        elif value and not value.isspace():
            value = " ".join(value.split())
            path[-1].children.append(Node("#", text=value if len(value) <= LONG_TEXT else "\0" + xxhash.xxh3_128_hexdigest(value.encode("utf-8", "surrogatepass")), chars=len(value)))
    root.children = fold_neighbours(root.children)
    return root


def fold_neighbours(nodes: list[Node]) -> list[Node]:
    """Equal neighbours, alone or in alternating pairs, become repeated groups."""
    out: list[Node] = []
    for node in nodes:
        if out and out[-1].label == node.label:
            out[-1] = align(out[-1], node, same_page=True)
            out[-1].repeated |= node.label != "#"
        elif len(out) > 1 and out[-2].label == node.label and node.label != "#":
            out[-2] = align(out[-2], node, same_page=True)
            out[-2].repeated = True
            out[-1].repeated |= out[-1].label != "#"
        else:
            out.append(node)
    return out


def align(a: Node, b: Node, same_page: bool = False) -> Node:
    """The least common wrapper of two nodes with one label."""
    pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    if a.label == "#":
        text = a.text if a.text == b.text else None
        return Node("#", a.optional or b.optional, False, text, a.chars + b.chars, pages)
    return Node(a.label, a.optional or b.optional, a.repeated or b.repeated, None, 0, pages, align_lists(a.children, b.children, same_page))


def align_lists(a: list[Node], b: list[Node], same_page: bool) -> list[Node]:
    if [x.label for x in a] == [x.label for x in b]:
        return [align(x, y, same_page) for x, y in zip(a, b)]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i].label == b[j].label else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i].label == b[j].label:
            out.append(align(a[i], b[j], same_page))
            i, j = i + 1, j + 1
        elif j >= m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            a[i].optional = True
            out.append(a[i])
            i += 1
        else:
            b[j].optional = True
            out.append(b[j])
            j += 1
    return fold_neighbours(out)


def _is_furniture(label: str, in_root: bool) -> bool:
    tag, *marks = label.split(".")
    if tag in FURNITURE_TAGS or (tag == "header" and not in_root):
        return True
    return any(w in FURNITURE_WORDS for mark in marks for w in re.split(r"[^a-z]+", mark))


def path_choices(wrapper: Node) -> list[list[str]]:
    """Sets of paths of the text slots that are the article, the likeliest first; a page is read with the first one that gives it a text.

    That is what lies under article, else under main, where they hold most of the free text, else
    under the element that does; then the same without that condition.  Free are slots and what
    too few pages show to call it constant.  Under article and main a constant counts as well, under another
    element only inside a block with free text.
    """
    slots: list[tuple[tuple[str, ...], Node]] = []

    def walk(node: Node, path: tuple[str, ...], in_root: bool) -> None:
        for c in node.children:
            if c.label == "#":
                slots.append((path, c))
            elif not _is_furniture(c.label, in_root):
                walk(c, (*path, c.label), in_root or c.label.split(".")[0] in ROOT_TAGS)

    walk(wrapper, (), False)
    tags = lambda p: {x.split(".")[0] for x in p}
    free = [(p, s) for p, s in slots if s.text is None or s.pages < CONSTANT_PAGES] or slots  # pages that are copies of one page have no template to tell
    weight: dict[tuple[str, ...], int] = {}
    under = dict.fromkeys(ROOT_TAGS, 0)
    for p, s in free:
        if "a" not in tags(p):
            for k in range(len(p) + 1):
                weight[p[:k]] = weight.get(p[:k], 0) + s.chars
            for tag in tags(p) & under.keys():
                under[tag] += s.chars
    block = lambda p: p[: max((k + 1 for k, x in enumerate(p) if x.split(".")[0] not in INLINE), default=0)]
    varied = {block(p) for p, _ in free}
    inside = lambda ok, every=True: sorted({"/".join(p) for p, _ in slots if ok(p) and (every or block(p) in varied)})
    total = weight.get((), 0)
    found = {tag: inside(lambda p, tag=tag: tag in tags(p)) for tag in ROOT_TAGS}
    choices = [found[tag] for tag in ROOT_TAGS if under[tag] >= ROOT_SHARE * total]
    if weight:
        blocks = [p for p in weight if not p or p[-1].split(".")[0] not in INLINE | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li"}]
        root = max((p for p in blocks if weight[p] >= 0.6 * total), key=len, default=())
        choices.append(inside(lambda p: p[: len(root)] == root, every=False))
    choices += found.values()
    return [c for k, c in enumerate(choices) if c and c not in choices[:k]]


def content_paths(wrapper: Node) -> list[str]:
    """The likeliest paths of the article's text slots."""
    return next(iter(path_choices(wrapper)), [])


def main_text(page: str | None, paths: frozenset[str]) -> str:
    """Texts at the given paths: references decoded, white space inside a block made one space, blocks joined by one space."""
    if not page:
        return ""
    blocks, block, path, here = [], [], [], ""
    for kind, value in scan(page):
        if kind:
            tag = value.split(".")[0]
            if tag not in INLINE and block:
                blocks.append("".join(block))
                block = []
            if kind == "+":
                path.append(here)
                here = f"{here}/{value}" if here else value
            else:
                here = path.pop()
        elif here in paths:
            block.append(entities.unescape(value))
    blocks.append("".join(block))
    return " ".join(x for b in blocks if (x := " ".join(b.split())))


def _fold_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    found: dict[tuple[str, str], Node] = {}
    for pdf in batches:
        for host, variant, page in zip(pdf["host"], pdf["variant"], pdf["html"]):
            tree, key = page_tree(page), (host, variant)
            found[key] = align(found[key], tree) if key in found else tree
    if found:
        yield pd.DataFrame({"host": [h for h, _ in found], "variant": [v for _, v in found], "wrapper": [json.dumps(n.dump(), ensure_ascii=False) for n in found.values()]})


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """pages(url, html) -> host, variant, wrapper (text of the expression), paths (of the article's text slots), others (less likely ones); from every page."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        nodes = [Node.load(json.loads(w)) for w in sorted(pdf["wrapper"])]
        total = nodes[0]
        for n in nodes[1:]:
            total = align(total, n)
        return pd.DataFrame({"host": pdf["host"].iloc[:1], "variant": pdf["variant"].iloc[:1], "wrapper": [json.dumps(total.dump(), ensure_ascii=False)]})

    def final(pdf: pd.DataFrame) -> pd.DataFrame:
        one = merge(pdf)
        node = Node.load(json.loads(one["wrapper"].iloc[0]))
        choices = path_choices(node) or [[]]
        return pd.DataFrame({"host": one["host"], "variant": one["variant"], "wrapper": [str(node)], "paths": [choices[0]], "others": [choices[1:]]})

    schema = "host string, variant string, wrapper string"
    rows = pages.where("html is not null").select(host_of("url").alias("host"), variant_of("html").alias("variant"), "html")
    parts = rows.mapInPandas(_fold_pages, schema)
    parts = parts.groupBy("host", "variant", F.pmod(F.xxhash64("wrapper"), F.lit(FOLDS)).alias("part")).applyInPandas(lambda key, pdf: merge(pdf), schema)
    return parts.groupBy("host", "variant").applyInPandas(final, schema + ", paths array<string>, others array<array<string>>")


def variant_of(html: str):
    """Which of the root elements a page has, as text."""
    return F.concat_ws("+", *[F.when(F.col(html).rlike(rf"(?i)<{tag}[\s/>]"), tag) for tag in ROOT_TAGS])


def host_of(url: str):
    """Lower-case host of an address; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) -> page_id, url, text.

    Null or empty html gives an empty text; pages without a host share the host ''.  Repeated rows
    come back repeated; an empty table gives an empty result; other columns are not read.  The
    wrapper table is broadcast only if it was measured to be under BROADCAST_BYTES, else joined by
    shuffle (a hot host is then split by AQE).  A page on which the likeliest slots hold no text is
    read with the next likely ones.
    """
    small_batches()
    pages = pages.select("page_id", "url", "html")
    wrappers = written(infer_wrappers(pages), "wrappers").select("host", "variant", F.concat(F.array("paths"), "others").alias("choices"))
    size = wrappers.agg(F.sum(F.length("host") + F.length(F.array_join(F.flatten("choices"), ""))).alias("n")).first().n or 0
    keyed = pages.withColumn("host", host_of("url")).withColumn("variant", variant_of("html"))
    joined = keyed.join(F.broadcast(wrappers) if size < BROADCAST_BYTES else wrappers, ["host", "variant"], "left")

    @F.pandas_udf("string")
    def extract(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for page, choices in batches:
            yield pd.Series([next(filter(None, (main_text(h, frozenset(p)) for p in c)), "") if c is not None else "" for h, c in zip(page, choices)], dtype=object)

    return joined.select("page_id", "url", extract("html", "choices").alias("text"))
