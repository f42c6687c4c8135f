"""Landed HTML pages: visible text, sections, label pairs and tables.

One parser walk per page runs in an Arrow UDF; everything behind it is native.  Tables are also
found in the texts of JSON payloads, however deep they lie.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import key_slug, text_clean, url_canonical
from .html_walk import Walk

# Element groups.
SKIPPED = frozenset("script style nav template noscript".split())
BLOCKS = frozenset("address article aside blockquote br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main ol p pre section table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset(f"h{k}" for k in range(10))
SEEN = SKIPPED | BLOCKS | HEADINGS | {"a"}  # no other tag changes anything
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
LABEL_CHARS = 16
MOST_COLUMNS = 1000  # the HTML standard's limit of a column span

PAIRS = "array<struct<label:string,value:string>>"
SECTIONS = "array<struct<title:string,text:string>>"
GRID = "array<array<array<string>>>"
CELLS = "array<array<array<struct<text:string,head:boolean,link:string>>>>"
_TEXT = pa.string()
ARROW = {
    "string": _TEXT, PAIRS: pa.list_(pa.struct([("label", _TEXT), ("value", _TEXT)])), GRID: pa.list_(pa.list_(pa.list_(_TEXT))), SECTIONS: pa.list_(pa.struct([("title", _TEXT), ("text", _TEXT)])),
    CELLS: pa.list_(pa.list_(pa.list_(pa.struct([("text", _TEXT), ("head", pa.bool_()), ("link", _TEXT)])))),
}
WALKED = 256  # pages whose Python objects a worker holds at a time
Cell = tuple[str, int, int, bool, str | None]  # text, columns, rows, header, first link


def _clean(x: str) -> str:
    return " ".join(x.replace("﻿", " ").split())


class _Page(Walk):
    """Lines of visible text, headings with what follows, label pairs, and tables with spans."""

    def __init__(self) -> None:
        super().__init__()
        self.skip = 0
        self.line: list[str] = []
        self.lines: list[str] = []
        self.heads: list[tuple[int, str, int]] = []  # level, title, first line behind it
        self.head: int | None = None
        self.tables: list[list[list[Cell]]] = []
        self.open: list[dict] = []
        self.terms: list[tuple[str, str]] = []
        self.term: list[str] | None = None

    def _flush(self) -> None:
        if not self.line:
            return
        text = _clean("".join(self.line))
        if text:
            self.lines.append(text)
        self.line = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in SEEN:
            return
        if tag in SKIPPED:
            self.skip += 1
        if tag in BLOCKS:
            self._flush()
        if tag in HEADINGS:
            self.head = int(tag[1])
        if tag == "table":
            self.open.append({"rows": [], "cell": None})
        elif self.open:
            t = self.open[-1]
            if tag == "tr":
                self._end_cell()
                t["rows"].append([])
            elif tag in ("td", "th"):
                self._end_cell()
                if not t["rows"]:
                    t["rows"].append([])
                if attrs:
                    a = dict(attrs)
                    span = lambda k: int(v) if (v := (a.get(k) or "1").strip()).isdigit() else 1
                    t["cell"] = ([], max(1, span("colspan")), span("rowspan"), tag == "th")
                else:
                    t["cell"] = ([], 1, 1, tag == "th")
                t["link"] = None
            elif tag == "a" and t["cell"] and not t["link"]:
                t["link"] = dict(attrs).get("href")
        if tag in ("dt", "dd"):
            self.term = []

    def _end_cell(self) -> None:
        t = self.open[-1]
        if t["cell"]:
            text, cols, rows, th = t["cell"]
            t["rows"][-1].append((_clean(" ".join(text)), cols, rows, th, t["link"]))
            t["cell"] = None

    def handle_endtag(self, tag: str) -> None:
        if tag not in SEEN:
            return
        if tag in SKIPPED and self.skip:
            self.skip -= 1
        if tag in HEADINGS and self.head is not None:
            title = _clean("".join(self.line))
            self.line = []
            self.lines.append(title)
            self.heads.append((self.head, title, len(self.lines)))
            self.head = None
        if tag in BLOCKS:
            self._flush()
        if self.open and tag in ("td", "th", "tr"):
            self._end_cell()
        if tag == "table" and self.open:
            self._end_cell()
            done = self.open.pop()["rows"]
            self.tables.append([r for r in done if r])
        if tag in ("dt", "dd") and self.term is not None:
            self.terms.append((tag, _clean("".join(self.term))))
            self.term = None

    def handle_data(self, data: str) -> None:
        if self.skip:
            return
        self.line.append(data)
        if self.open and self.open[-1]["cell"]:
            self.open[-1]["cell"][0].append(data)
        if self.term is not None:
            self.term.append(data)


def _parse(html: str | None) -> _Page:
    page = _Page()
    page.feed(html or "")
    page.close()
    while page.open:  # a table that nothing ends goes to the end of the page
        page.handle_endtag("table")
    page._flush()
    return page


def _cells(rows: list[list[Cell]]) -> list[list[tuple[str, bool, str | None]]]:
    """Spans filled in, short rows padded; a row span of 0 reaches the end, a cell goes to the first place where all of its columns are free."""
    taken: list[dict[int, tuple[str, bool, str | None]]] = [{} for _ in rows]
    for r, row in enumerate(rows):
        c = 0
        for text, cols, down, head, link in row:
            cols = min(cols, MOST_COLUMNS)
            here = taken[r]
            if cols == 1:
                while c in here:
                    c += 1
                if down == 1:
                    here[c] = (text, head, link)
                    c += 1
                    continue
            else:
                c = next(x for x in count(c) if here.keys().isdisjoint(range(x, x + cols)))
            for below in taken[r : None if down == 0 else r + down]:
                below.update((x, (text, head, link)) for x in range(c, c + cols) if x not in below)
            c += cols
    width = max((max(row, default=-1) for row in taken), default=-1) + 1
    places, blank = range(width), ("", False, None)
    return [[row.get(x, blank) for x in places] for row in taken]


def _grid(rows: list[list[Cell]]) -> list[list[str]]:
    return [[text for text, *_ in row] for row in _cells(rows)]


def _fragments(payload: str | None) -> list[str]:
    """The texts of a JSON payload that hold a table, in document order; a payload that is no JSON is one text."""
    if not payload or payload.lstrip()[:1] not in ("{", "[", '"'):
        return [payload or ""]
    try:
        waiting, found = [json.loads(payload)], []
    except (ValueError, RecursionError):
        return [payload]
    while waiting:
        value = waiting.pop()
        if isinstance(value, str) and "<table" in value.casefold():
            found.append(value)
        elif isinstance(value, (dict, list)):
            waiting += reversed(list(value.values()) if isinstance(value, dict) else value)
    return found


def _pairs(page: _Page) -> list[tuple[str, str]]:
    """Two-cell and longer even rows, dt/dd, and 'label: value' lines; the first of a label wins."""
    found = []
    for rows in page.tables:
        for row in rows:
            texts = [t for t, *_ in row]
            if len(texts) == 2 or (len(texts) >= 4 and len(texts) % 2 == 0):
                found += list(zip(texts[::2], texts[1::2]))
    for (a, x), (b, y) in zip(page.terms, page.terms[1:]):
        if (a, b) == ("dt", "dd"):
            found.append((x, y))
    for line in page.lines:
        label, colon, value = line.partition(":")
        if colon and 0 < len(label.strip()) <= LABEL_CHARS and value.strip():
            found.append((label, value))
    out: dict[str, str] = {}
    for label, value in found:
        label = _clean(label).rstrip(":： ")
        if label and _clean(value):
            out.setdefault(label, _clean(value))
    return list(out.items())


def _sections(page: _Page) -> list[tuple[str, str]]:
    """Title and text up to the next heading of the same or a higher level."""
    out = []
    for i, (level, title, first) in enumerate(page.heads):
        last = next((h[2] - 1 for h in page.heads[i + 1 :] if h[0] <= level), len(page.lines))
        out.append((title, "\n".join(page.lines[first:last])))
    return out


def walked(pages: pa.Array, f: Callable[[str | None], object], kind: pa.DataType) -> pa.Array:
    """``f`` of each page, ``WALKED`` pages at a time, so that a worker holds the Python objects of these only."""
    parts = [pa.array([f(h) for h in pages.slice(at, WALKED).to_pylist()], kind) for at in range(0, len(pages), WALKED)]
    return pa.concat_arrays(parts or [pa.array([], kind)])


def _udf(kind: str, f: Callable[[str | None], object]) -> Callable[[Column | str], Column]:
    def make(html: Column | str) -> Column:
        @F.arrow_udf(kind)
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for pages in batches:
                yield walked(pages, f, ARROW[kind])

        return run(html)

    return make


def _of_tables(f: Callable[[list[list[Cell]]], list]) -> Callable[[str | None], list]:
    return lambda payload: [f(t) for html in _fragments(payload) for t in _parse(html).tables]


html_text = _udf("string", lambda html: "\n".join(_parse(html).lines))
html_label_pairs = _udf(PAIRS, lambda html: _pairs(_parse(html)))
html_sections = _udf(SECTIONS, lambda html: _sections(_parse(html)))
html_tables_grid = _udf(GRID, _of_tables(_grid))
html_tables_cells = _udf(CELLS, _of_tables(_cells))


def pair_value(pairs: Column, labels: list[str]) -> Column:
    """The value of the first label that matches wholly, else of the first that is part of a label."""
    whole = [F.get(F.filter(pairs, _equals(label)), F.lit(0)).value for label in labels]
    part = [F.get(F.filter(pairs, _holds(label)), F.lit(0)).value for label in labels]
    return F.coalesce(*whole, *part)


def _equals(label: str) -> Callable[[Column], Column]:
    return lambda p: F.lower(p.label) == label.lower()


def _holds(label: str) -> Callable[[Column], Column]:
    return lambda p: F.lower(p.label).contains(label.lower())


def section_map(sections: Column, aliases: dict[str, list[str]]) -> Column:
    """map of canonical key to the text of the first section whose title is one of its names."""
    entries = [F.struct(F.lit(k).alias("key"), F.get(F.filter(sections, _named(names)), F.lit(0))["text"].alias("value")) for k, names in aliases.items()]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e.value.isNotNull()))


def _named(names: list[str]) -> Callable[[Column], Column]:
    return lambda s: F.lower(s["title"]).isin(*[n.lower() for n in names])


def html_meta(html: Column) -> Column:
    """struct(title, canonical, description, lang)."""
    one = lambda p: F.nullif(F.trim(F.regexp_extract(html, p, 1)), F.lit(""))
    return F.struct(
        one(r"(?is)<title[^>]*>(.*?)</title>").alias("title"), F.coalesce(one(r'(?i)<link[^>]+rel="canonical"[^>]+href="([^"]*)"'), one(r'(?i)<meta[^>]+property="og:url"[^>]+content="([^"]*)"')).alias("canonical"),
        one(r'(?i)<meta[^>]+name="description"[^>]+content="([^"]*)"').alias("description"), one(r'(?i)<html[^>]+lang="([^"]*)"').alias("lang"),
    )


def html_links(pages: DataFrame, base: str) -> DataFrame:
    """page_id, pos, href, text: absolute, each address once, without fragments, scripts and mail."""
    anchor = r'(?is)<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>'
    both = F.arrays_zip(F.regexp_extract_all("html", F.lit(anchor), F.lit(1)).alias("href"), F.regexp_extract_all("html", F.lit(anchor), F.lit(2)).alias("text"))
    rows = pages.select("page_id", F.posexplode(both).alias("pos", "a")).select("page_id", "pos", F.trim("a.href").alias("raw"), text_clean(F.regexp_replace("a.text", "<[^>]*>", " ")).alias("text"))
    rows = rows.where(~F.col("raw").rlike("(?i)^(#|javascript:|mailto:)") & (F.col("raw") != "")).withColumn("href", url_canonical(F.col("raw"), base))
    w = Window.partitionBy("page_id", "href").orderBy("pos")
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("page_id", "pos", "href", "text")


def tables_long(pages: DataFrame) -> DataFrame:
    """page_id, table_no, row_no, col_no, value."""
    t = pages.select("page_id", F.posexplode(html_tables_grid("html")).alias("table_no", "t"))
    r = t.select("page_id", "table_no", F.posexplode("t").alias("row_no", "r"))
    return r.select("page_id", "table_no", "row_no", F.posexplode("r").alias("col_no", "value"))


def _names(row: Column) -> Column:
    """Keys of a header row: slugs, column_n where there is none, repeated ones numbered."""
    slugs = F.transform(row, lambda c, i: F.coalesce(F.nullif(key_slug(c["text"]), F.lit("")), F.concat(F.lit("column_"), (i + 1).cast("string"))))

    def numbered(names: Column) -> Column:
        nth = lambda k, i: F.size(F.filter(F.slice(names, F.lit(1), i + 1), lambda x: x == k))
        plain = F.transform(names, lambda k, i: F.when(nth(k, i) > 1, F.concat_ws("_", k, nth(k, i).cast("string"))).otherwise(k))
        return F.when(F.size(F.array_distinct(names)) == F.size(names), names).otherwise(plain)

    once = numbered(slugs)
    return F.when(F.size(F.array_distinct(once)) == F.size(once), once).otherwise(F.transform(once, lambda k, i: F.concat(k, F.lit("_column_"), (i + 1).cast("string"))))


def _header_rows(t: Column, known: list[str], first: bool) -> Column:
    """Numbers of the header rows: rows whose filled cells are all header cells, else the first row with two known names, else the first row or none."""
    filled = lambda r: F.filter(r, lambda c: c["text"] != "")
    marked = lambda r: F.exists(r, lambda c: c["head"]) & F.forall(filled(r), lambda c: c["head"])
    named = lambda r: F.size(F.array_intersect(F.transform(r, lambda c: F.lower(c["text"])), F.array(*[F.lit(k.lower()) for k in known]).cast("array<string>"))) >= 2
    rows = lambda test: F.filter(F.transform(t, lambda r, i: F.when(test(r), i)), lambda i: i.isNotNull())
    none = F.array().cast("array<int>")
    by_name = F.slice(rows(named), 1, 1) if known else none
    fallback = F.array(F.lit(0)) if first else none
    return F.when(F.size(rows(marked)) > 0, rows(marked)).when(F.size(by_name) > 0, by_name).otherwise(fallback)


def tables_records(pages: DataFrame, known: list[str] | None = None, first_row: bool = True, base: str = "") -> DataFrame:
    """pages(page_id, html) -> page_id, table_no, row_no, record: a map of header key to text of every row below a header row.

    A header row holds nothing but header cells; a table may have several, each for the rows below
    it.  Without one the first row with two ``known`` names counts, else the first row, or with
    ``first_row=False`` none, so that all keys are column_n.  Blank rows go, blank cells are null, a
    cell's first link is kept as <key>_url, a rooted one behind ``base``.  One walk over each page in Python; rows
    and headers never meet in a join.
    """
    t = pages.select("page_id", F.posexplode(html_tables_cells("html")).alias("table_no", "t")).withColumn("heads", _header_rows(F.col("t"), known or [], first_row))
    t = t.withColumn("keys", F.transform("heads", lambda i: _names(F.get(F.col("t"), i)))).withColumn("plain", _names(F.transform(F.get(F.col("t"), F.lit(0)), lambda c: F.struct(F.lit("").alias("text")))))
    above = lambda i: F.size(F.filter("heads", lambda h: h < i))
    body = F.filter(F.transform("t", lambda r, i: F.struct(i.alias("row_no"), r.alias("cells"), above(i).alias("head"))), lambda x: ~F.array_contains("heads", x["row_no"]) & F.exists(x["cells"], lambda c: c["text"] != ""))
    r = t.select("page_id", "table_no", "keys", "plain", F.explode(body).alias("r"))
    keys = F.when(F.col("r.head") > 0, F.get(F.col("keys"), F.col("r.head") - 1)).otherwise(F.col("plain"))
    r = r.select("page_id", "table_no", F.col("r.row_no").alias("row_no"), keys.alias("keys"), F.col("r.cells").alias("cells"))
    link = lambda c: F.when(c["link"].startswith("/"), F.concat(F.lit(base), c["link"])).otherwise(c["link"])
    pair = lambda k, v: F.struct(k.alias("key"), v.alias("value"))
    texts = F.zip_with("keys", "cells", lambda k, c: pair(k, F.nullif(c["text"], F.lit(""))))
    links = F.filter(F.zip_with("keys", "cells", lambda k, c: pair(F.concat(k, F.lit("_url")), link(c))), lambda e: e["value"].isNotNull() & ~F.array_contains("keys", e["key"]))
    return r.select("page_id", "table_no", "row_no", F.map_from_entries(F.concat(texts, links)).alias("record"))


def table_classify(records: DataFrame, kinds: dict[str, list[str]]) -> DataFrame:
    """records with ``kind``: the first whose required headers are all there, else 'other'."""
    keys = F.map_keys("record")
    out = F.lit("other")
    for kind, need in reversed(kinds.items()):
        out = F.when(F.size(F.array_except(F.array(*[F.lit(n) for n in need]), keys)) == 0, kind).otherwise(out)
    return records.withColumn("kind", out)


def timeline_rows(rows: DataFrame, text: str) -> DataFrame:
    """id, pos, day, event of 'date: event' lines."""
    lines = rows.select("id", F.posexplode(F.split(text, r"\r?\n")).alias("pos", "line"))
    pattern = r"^\s*(\d{4}-\d{1,2}-\d{1,2})\s*[:：]\s*(.+)$"
    return lines.where(F.col("line").rlike(pattern)).select("id", "pos", F.to_date(F.regexp_extract("line", pattern, 1), "yyyy-M-d").alias("day"), F.trim(F.regexp_extract("line", pattern, 2)).alias("event"))


def package_pairs(text: Column) -> Column:
    """map of name to version of 'name -> version' lines; the last of a name counts."""
    pattern = F.lit(r"(?m)^\s*([A-Za-z0-9._ #-]+?)\s*->\s*(\S+)\s*$")
    pairs = F.arrays_zip(F.regexp_extract_all(text, pattern, F.lit(1)).alias("k"), F.regexp_extract_all(text, pattern, F.lit(2)).alias("v"))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q.k == p.k))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p.k, p.v)))


def listing_cards(pages: DataFrame, base: str) -> DataFrame:
    """page_id, code, title, pages: entries of a listing from its links, and the number of pages from its largest page link or its total."""
    links = html_links(pages, base)
    total = F.ceil(F.regexp_extract("html", r"共\s*(\d+)\s*条", 1).try_cast("long") / 20)
    linked = F.array_max(F.transform(F.regexp_extract_all("html", F.lit(r"[?&]page=(\d+)"), F.lit(1)), lambda x: x.try_cast("long")))
    count = pages.select("page_id", F.greatest(total, linked, F.lit(1)).alias("pages"))
    code = F.regexp_extract("href", r"/([^/]+)$", 1)
    return links.select("page_id", code.alias("code"), F.col("text").alias("title")).where("code <> ''").join(count, "page_id")


def register_html_cells(spark) -> None:
    """The SQL face of the table grid: ``SELECT * FROM html_cells('<table>...')`` or a lateral join over pages."""

    @F.udtf(returnType="table_no int, row_no int, col_no int, value string")
    class HtmlCells:
        def eval(self, html: str):
            for t, grid in enumerate(_of_tables(_grid)(html)):
                for r, row in enumerate(grid):
                    for c, value in enumerate(row):
                        yield t, r, c, value

    spark.udtf.register("html_cells", HtmlCells)
