"""Tables in nested payloads, header rows, listing cards and addresses: literal cases."""

import json
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from advisorium.functions import text as X
from advisorium.operators import html_listing as L
from advisorium.operators import html_tables as T


def grids(spark, payload):
    return spark.createDataFrame([(payload,)], "h string").select(T.html_tables_grid("h")).first()[0]


NESTED = "<p>Detail</p><table><tr><td>Nested</td><td>HTML</td></tr></table>"


@pytest.mark.parametrize(
    "payload,want",
    [
        ("<table> <tr><th> Name </th><th>Notes</th></tr> <tr><td>Product   One</td><td></td></tr> <tr><td>Product Two</td></tr> </table> <table><tr><td>Second</td></tr></table>", [[["Name", "Notes"], ["Product One", ""], ["Product Two", ""]], [["Second"]]]),
        ('<table><tr><th rowspan="2">Product</th><th colspan="2">Versions</th></tr><tr><th>Affected</th><th>Fixed</th></tr><tr><td>Widget</td><td colspan="2">1.2.3</td></tr></table>', [[["Product", "Versions", "Versions"], ["Product", "Affected", "Fixed"], ["Widget", "1.2.3", "1.2.3"]]]),
        (json.dumps({"data": {"content": NESTED, "title": "No table here"}}), [[["Nested", "HTML"]]]), (json.dumps({"data": {"content": "<p>Plain detail</p>"}}), []), (json.dumps([["x", [NESTED]], {"b": NESTED.upper(), "a": "<table><tr><td>1"}]), [[["Nested", "HTML"]], [["NESTED", "HTML"]], [["1"]]]),
        (json.dumps(NESTED), [[["Nested", "HTML"]]]), ("{broken " + NESTED, [[["Nested", "HTML"]]]), ("[" * 5000 + NESTED, [[["Nested", "HTML"]]]), (None, []), ("", []), ("{}", []), ("<table><tr><td>a<br>b<b>c</b></td></tr></table>", [[["a b c"]]]),
    ],
)
def test_tables_anywhere_in_a_payload(spark, payload, want):
    assert grids(spark, payload) == want


def records(spark, html, **options):
    return [(r.row_no, r.record) for r in T.tables_records(spark.createDataFrame([(1, html)], "page_id int, html string"), **options).collect()]


@pytest.mark.parametrize(
    "html,options,want",
    [
        ("<tr><th>Fixed in</th><th>Link</th></tr><tr><td>1</td><td><a href='/x'>go</a><a href='/y'>no</a></td></tr><tr><td> </td><td></td></tr>", {"base": "https://b"}, [(1, {"fixed_in": "1", "link": "go no", "link_url": "https://b/x"})]),
        ("<tr><td>a</td><td>b</td></tr><tr><td>1</td><td></td></tr>", {}, [(1, {"a": "1", "b": None})]), ("<tr><td>a</td><td>b</td></tr>", {"first_row": False}, [(0, {"column_1": "a", "column_2": "b"})]),
        ("<tr><td>note</td><td></td></tr><tr><td>Package</td><td>CVE</td></tr><tr><td>p</td><td>c</td></tr>", {"known": ["package", "cve"], "first_row": False}, [(0, {"column_1": "note", "column_2": None}), (2, {"package": "p", "cve": "c"})]),
        ("<tr><th>row</th><td>1</td></tr><tr><th>head</th><td>2</td></tr>", {}, [(1, {"row": "head", "1": "2"})]), ("<tr><th>A</th></tr><tr><td>1</td></tr><tr><th>B</th></tr><tr><td>2</td></tr>", {}, [(1, {"a": "1"}), (3, {"b": "2"})]),
        ("<tr><th>A</th><th>A</th><th>A 2</th><th>!</th></tr><tr><td>1</td><td>2</td><td>3</td><td>4</td></tr>", {}, [(1, {"a_column_1": "1", "a_2_column_2": "2", "a_2_column_3": "3", "column_4_column_4": "4"})]),
        ("<tr><th>A</th><th>A_url</th></tr><tr><td><a href=x>1</a></td><td>2</td></tr>", {}, [(1, {"a": "1", "a_url": "2"})]), ("<tr><th>A</th></tr>", {}, []), ("", {}, []),
    ],
)
def test_records(spark, html, options, want):
    assert records(spark, f"<table>{html}</table>", **options) == want


def test_records_walk_a_page_once_and_join_nothing(spark):
    plan = T.tables_records(spark.createDataFrame([(1, "")], "page_id int, html string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan and "Join" not in plan


TABLE = """<nav><ul><li><a href="/x">2020-01-01</a></li></ul></nav><table><tr><th>id</th></tr><tr><td><a href="/flaw/show/CNVD-2026-1">T one</a></td><td>高</td><td>1,234</td><td>5</td><td>2026-1-2</td></tr>
<tr><td><a href="/flaw/show/CNVD-2026-2" title=q>T two</a><td>Low<td>7<td>8<td>2026-01-03</table><p>共 <b>41</b> 条</p>"""
CARDS = """<div><a href="/b/aa/"><div class="card__title"><span class="cat-tag">Update</span>Title A</div><div>Release Date: 2026-06-12</div><div>Severity: High</div></a><a href="/b/bb?x=1"><div class="card__title">Title B</div>
<time datetime="2026-06-13"></time></a><a href="/b/aa/">again</a></div><a href="?a=1&amp;page=9">9</a><p>99</p>"""
SIBLINGS = "<h3><a href='/d/1'>One</a></h3><p>2026-01-01</p><ul><li>low</li></ul><h3><a href='/d/2'>Two</a></h3><p>2026-01-02</p><ul><li>x</li></ul><footer>3 high</footer>"


@pytest.mark.parametrize(
    "html,detail,want",
    [
        (TABLE, r"/flaw/show/(CNVD-\d+-\d+)", [(0, "CNVD-2026-1", "T one", "2026-01-02", "High", [1234, 5], 41, 21), (1, "CNVD-2026-2", "T two", "2026-01-03", "Low", [7, 8], 41, 21)]),
        (CARDS, "^/b/", [(0, "aa", "Title A", "2026-06-12", "High", [], None, 9), (1, "bb", "Title B", "2026-06-13", None, [], None, 9)]),
        (SIBLINGS, "^/d/", [(0, "1", "One", "2026-01-01", "Low", [], None, None), (1, "2", "Two", "2026-01-02", None, [], None, None)]),
        ("<div><ul><li><a href='/d/1'>One</a> <b>2026-01-01</b></li></ul><p>noise 9</p></div>", "/d/", [(0, "1", "One", "2026-01-01", None, [], None, None)]),
        ("<p>nothing</p>", "/d/", []), ("", "/d/", []), (None, "/d/", []), ("<a href='/d/1'></a></b></p>", "/d/", [(0, "1", None, None, None, [], None, None)]), ("<div>" * 3000 + "<a href='/d/1'>deep</a>", "/d/", [(0, "1", "deep", None, None, [], None, None)]),
    ],
)
def test_listing_entries(spark, html, detail, want):
    pages = spark.createDataFrame([(1, html, "x")], "page_id int, html string, title string")
    got = L.listing_entries(pages, detail, "https://b.example.org/l").orderBy("pos").collect()
    assert [(r.pos, r.code, r.title, r.date, r.severity, r.counts, r.total_records, r.total_pages) for r in got] == want


@pytest.mark.parametrize("text", ["/x/../y/./z", "//h/x", "../a", "./a/..", "../../../..", "?q", "#f", "", "a/b?x=../y", "http://o/../x", "..", ".", "/..", "/a//b/../c", "g;x=1/../y", "mailto:x"])
def test_references_resolve_as_the_standard_says(spark, text):
    from urllib.parse import urljoin

    base = "https://h.example.org/p/q/r?s=1"
    got = spark.createDataFrame([(text,)], "r string").select(X.url_resolve(F.col("r"), base)).first()[0]
    assert got == (urljoin(base, text) if text else base)


@pytest.mark.parametrize("address,kept", [("/adv/1", True), ("/other/1", False), ("//x.org/adv/1", False), ("../../adv/2?x", True), ("https://h.org/adv", False)])
def test_path_list(spark, address, kept):
    got = spark.createDataFrame([(address,)], "r string").select(X.url_canonical(F.col("r"), "https://h.org/a/b/c", ["h.org"], ["/adv/"])).first()[0]
    assert (got is not None) == kept


ODD = ["<a", "&", "a &amp; b", "&lt", "</ td>", "<TD ROWSPAN=2>", "<td colspan='2'>", '<a href="/d/1?x&amp;y">', "</a>", "<script>a<b></ script>c</script>", "<style>x</style>", "<title>a<b></title>", "<!-- <td> -->", "<br/>", "<th\n>", "x: y", "<dt>", "<dd>", "</table>", "<table>", "<tr>", "<h2>", "</h2>", "< b", "<?p?>", "</>", '<i a="b>c">', "<p class='title'>"]


def test_the_short_way_reads_as_the_full_parser():
    class Full(T._Page):
        feed = HTMLParser.feed

    draw = random.Random(1)
    for _ in range(2000):
        html = "".join(draw.choice(ODD) for _ in range(draw.randint(0, 40)))
        pages = [T._Page(), Full()]
        for page in pages:
            page.feed(html)
            page.close()
        one, two = ({k: v for k, v in vars(p).items() if k in ("line", "lines", "heads", "tables", "open", "terms", "skip")} for p in pages)
        assert one == two, html


def test_plain_markup_does_not_reach_the_full_parser(monkeypatch):
    monkeypatch.setattr(HTMLParser, "parse_starttag", lambda *a: pytest.fail("full parser"))
    html = '<div class="x">' + '<table><tr><td rowspan="2">a &amp; b</td><td><a href="/d/1?a&amp;b">One</a></td></tr></table>' * 3 + "</div>"
    assert T._of_tables(T._grid)(html) == [[["a & b", "One"]]] * 3
    assert L._cards(html, L.re.compile("/d/"))[1][0][:2] == ("/d/1?a&b", "One")


def test_a_worker_holds_few_walked_pages_at_a_time():
    held = [0, 0]

    class Live(str):
        def __init__(self, *_):
            held[0] += 1
            held[1] = max(held)

        def __del__(self):
            held[0] -= 1

    assert len(T.walked(T.pa.array(["x"] * 2000), Live, T.pa.string())) == 2000
    assert held[1] <= T.WALKED + 1


def test_siblings_of_a_listing_are_looked_through_once(monkeypatch):
    calls, starts = [], L._starts
    monkeypatch.setattr(L, "_starts", lambda around: calls.append(1) or starts(around))
    html = "".join(f'<h3><a href="/d/{k}">Flaw {k}</a></h3><p>low</p>' for k in range(500))
    assert [x[1:] for x in L._cards(html, L.re.compile("/d/"))[1]] == [(f"Flaw {k}", [f"Flaw {k}", "low"]) for k in range(500)] and len(calls) == 1


def test_a_label_hides_only_its_own_text():
    html = "<ul><li><a href='/d/1'><span class='tag'>5</span><b>5</b></a><i>x</i></li><li><a href='/d/2'>b</a></li></ul>"
    assert L._cards(html, L.re.compile("/d/"))[1][0] == ("/d/1", "5", ["5", "5", "x"])
