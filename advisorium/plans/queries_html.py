"""Queries over HTML pages; pages with tables are rendered from customers and their orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import html_listing as L
from ..operators import html_tables as T
from .registry import query, table

C = F.col
BASE = "https://base.example.org"


def region_pages(spark, d):
    """One page a customer with orders: a caption pair, a table of the orders with a row-spanned customer cell, a column-spanned total row, and sections."""
    n = table(spark, d, "orders").groupBy(C("o_custkey").alias("page_id")).agg(F.sort_array(F.collect_list(F.struct(C("o_orderkey").alias("n_nationkey"), C("o_orderpriority").alias("n_name")))).alias("v"))
    r = table(spark, d, "customer").select(C("c_custkey").alias("page_id"), C("c_name").alias("r_name"))
    rows = F.transform("v", lambda x, i: F.concat(F.lit("<tr>"), F.when(i == 0, F.concat(F.lit('<td rowspan="'), F.size("v").cast("string"), F.lit('">'), C("r_name"), F.lit("</td>"))).otherwise(""), F.lit("<td> "), x.n_nationkey.cast("string"), F.lit("</td><td>"), x.n_name, F.lit(" &amp; co</td></tr>")))
    html = F.concat(
        F.lit("<html><head><title>Region "), C("r_name"), F.lit('</title></head><body><nav>menu</nav><script>x()</script><h1>Overview</h1><p>About <b>'), C("r_name"), F.lit("</b></p><h2>Details</h2><p>Code: R"), C("page_id").cast("string"),
        F.lit("</p><h1>Next</h1><p>Steps</p><dl><dt>Owner</dt><dd>"), C("r_name"), F.lit("</dd></dl><table><tr><th>Region</th><th>Nation Key</th><th></th></tr>"), F.array_join(rows, ""),
        F.lit('<tr><td colspan="2">Total</td><td>'), F.size("v").cast("string"), F.lit("</td></tr><tr><td> </td></tr></table></body></html>"),
    )
    return r.join(n, "page_id").select("page_id", "r_name", html.alias("html"))


#: The names that the SQL below uses, over customers and orders.
_PAGES = "nation AS (SELECT o_custkey AS n_regionkey, o_orderkey AS n_nationkey, o_orderpriority AS n_name FROM orders), region AS (SELECT c_custkey AS r_regionkey, c_name AS r_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders))"
_LONG = _PAGES + """,
    n AS (SELECT n_regionkey AS page_id, n_nationkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS i, count(*) OVER (PARTITION BY n_regionkey) AS c, r_name FROM nation JOIN region ON r_regionkey = n_regionkey),
    body AS (SELECT page_id, i AS row_no, 0 AS col_no, r_name AS value FROM n UNION ALL SELECT page_id, i, 1, CAST(n_nationkey AS VARCHAR) FROM n UNION ALL SELECT page_id, i, 2, n_name || ' & co' FROM n),
    foot AS (SELECT DISTINCT page_id, c + 1 AS row_no, k AS col_no, CASE WHEN k < 2 THEN 'Total' ELSE CAST(c AS VARCHAR) END AS value FROM n, range(0, 3) AS t(k) UNION ALL SELECT DISTINCT page_id, c + 2, k, '' FROM n, range(0, 3) AS t(k)),
    head AS (SELECT r_regionkey AS page_id, 0 AS row_no, k AS col_no, (['Region', 'Nation Key', ''])[k + 1] AS value FROM region, range(0, 3) AS t(k)),
    long AS (SELECT * FROM head UNION ALL SELECT * FROM body UNION ALL SELECT * FROM foot)"""


@query("html_text", f"""WITH {_PAGES}, t AS (SELECT n_regionkey AS page_id, string_agg(CASE WHEN i = 1 THEN r_name || chr(10) ELSE '' END || n_nationkey || chr(10) || n_name || ' & co', chr(10) ORDER BY i) AS body, count(*) AS c FROM
    (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS i FROM nation JOIN region ON r_regionkey = n_regionkey) GROUP BY 1)
    SELECT r_regionkey AS page_id, 'Region ' || r_name || chr(10) || 'Overview' || chr(10) || 'About ' || r_name || chr(10) || 'Details' || chr(10) || 'Code: R' || r_regionkey || chr(10) || 'Next' || chr(10) || 'Steps' || chr(10) || 'Owner' || chr(10) || r_name || chr(10) || 'Region' || chr(10) || 'Nation Key' || chr(10) || body || chr(10) || 'Total' || chr(10) || c AS body
    FROM region JOIN t ON page_id = r_regionkey""")
def _(spark, d):
    return region_pages(spark, d).select("page_id", T.html_text("html").alias("body"))


@query("html_meta", r"""SELECT page_id, nullif(trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)), '') AS title, nullif(regexp_extract(html, '(?i)<html[^>]+lang="([^"]*)"', 1), '') AS lang FROM pages""")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", T.html_meta(C("html")).alias("m")).select("page_id", "m.title", "m.lang")


@query("html_links", f"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS h, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS t, generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">'), 1) - 1 AS pos FROM pages),
    b AS (SELECT page_id, pos, regexp_replace(regexp_replace('{BASE}' || h, '[?#].*$', ''), '/+$', '') AS href, trim(regexp_replace(t, '\\s+', ' ', 'g')) AS text FROM a)
    SELECT page_id, CAST(pos AS INTEGER) AS pos, href, text FROM b QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY pos) = 1""")
def _(spark, d):
    return T.html_links(table(spark, d, "pages"), BASE)


@query("html_sections", f"""WITH {_PAGES} SELECT r_regionkey AS page_id, 'About ' || r_name || chr(10) || 'Details' || chr(10) || 'Code: R' || r_regionkey AS overview, 'Code: R' || r_regionkey AS details FROM region""")
def _(spark, d):
    m = T.section_map(T.html_sections("html"), {"overview": ["Summary", "Overview"], "details": ["details"], "gone": ["x"]})
    return region_pages(spark, d).select("page_id", m.alias("m")).select("page_id", C("m")["overview"].alias("overview"), C("m")["details"].alias("details"))


@query("html_label_pairs", f"WITH {_PAGES} SELECT r_regionkey AS page_id, 'R' || r_regionkey AS code, r_name AS owner, (SELECT CAST(count(*) AS VARCHAR) FROM nation WHERE n_regionkey = r_regionkey) AS total FROM region")
def _(spark, d):
    p = region_pages(spark, d).select("page_id", T.html_label_pairs("html").alias("p"))
    return p.select("page_id", T.pair_value(C("p"), ["Code"]).alias("code"), T.pair_value(C("p"), ["absent", "own"]).alias("owner"), T.pair_value(C("p"), ["total"]).alias("total"))


@query("html_tables_grid", f"WITH {_PAGES} SELECT r_regionkey AS page_id, 1 AS tables, CAST((SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) + 3 AS INTEGER) AS height, 3 AS width FROM region")
def _(spark, d):
    g = region_pages(spark, d).select("page_id", T.html_tables_grid("html").alias("g"))
    return g.select("page_id", F.size("g").alias("tables"), F.size(C("g")[0]).alias("height"), F.array_max(F.transform(C("g")[0], lambda r: F.size(r))).alias("width"))


@query("html_tables_long", f"WITH {_LONG} SELECT page_id, CAST(row_no AS INTEGER) AS row_no, CAST(col_no AS INTEGER) AS col_no, value FROM long")
def _(spark, d):
    return T.tables_long(region_pages(spark, d)).select("page_id", "row_no", "col_no", "value")


@query("html_tables_records", f"WITH {_LONG} SELECT page_id, CAST(row_no AS INTEGER) AS row_no, max(CASE WHEN col_no = 0 THEN value END) AS region, max(CASE WHEN col_no = 1 THEN value END) AS nation_key, max(CASE WHEN col_no = 2 THEN value END) AS third FROM long WHERE row_no > 0 GROUP BY 1, 2 HAVING max(value) <> ''")
def _(spark, d):
    r = T.tables_records(region_pages(spark, d))
    return r.select("page_id", "row_no", C("record")["region"].alias("region"), C("record")["nation_key"].alias("nation_key"), C("record")["column_3"].alias("third"))


def _nested(spark, d):
    """A JSON payload an order: tables in texts at several depths, in any case of the tag, and texts that hold none."""
    k = C("o_orderkey").cast("string")
    grid = lambda name: F.concat(F.lit(f"<p>x</p><TABLE class=\"t\"><tr><td>{name}"), k, F.lit("</td><td>\u00e9 &amp; y</td></tr></TABLE>"))
    deep = F.struct(F.struct(F.array(F.lit("plain"), grid("c")).alias("z")).alias("y"), F.when(C("o_orderkey") % 3 == 0, F.concat(grid("d"), grid("e"))).alias("a"))
    payload = F.struct(grid("b").alias("zz"), F.struct(deep.alias("content"), F.lit("No table here, only <tables").alias("title")).alias("data"), F.lit(7).alias("n"), F.lit(None).cast("string").alias("gone"))
    html = F.when(C("o_orderkey") % 5 == 0, grid("h")).when(C("o_orderkey") % 5 == 1, '{"data": {"content": "<p>Plain detail</p>"}}').otherwise(F.to_json(payload))
    return table(spark, d, "orders").select(C("o_orderkey").alias("page_id"), html.alias("html"))


@query("html_tables_nested", """SELECT o_orderkey AS page_id, t.n - 1 AS table_no, t.name || o_orderkey || '|' || 'é & y' AS cells FROM orders, (VALUES ('h', 1), ('b', 1), ('c', 2), ('d', 3), ('e', 4)) AS t(name, n)
    WHERE CASE WHEN o_orderkey % 5 = 0 THEN name = 'h' WHEN o_orderkey % 5 = 1 THEN false ELSE name IN ('b', 'c') OR name IN ('d', 'e') AND o_orderkey % 3 = 0 END""")
def _(spark, d):
    return _nested(spark, d).select("page_id", F.posexplode(T.html_tables_grid("html")).alias("table_no", "t")).select("page_id", "table_no", F.array_join(C("t")[0], "|").alias("cells"))


def _fix_pages(spark, d):
    """Tables with header cells, with two known names, with neither, and with two header rows; package cells hold links."""
    k = C("o_orderkey")
    row = lambda link, *cells: F.concat(F.lit("<tr><td>"), F.lit(link), *[x for c in cells for x in (c, F.lit("</td><td>"))][:-1], F.lit("</td></tr>"))
    head = lambda tag, *names: F.lit("<tr>" + "".join(f"<{tag}>{n}</{tag}>" for n in names) + "</tr>")
    body = row('<a href="/p/x">', F.concat(F.lit("pkg "), k.cast("string"), F.lit("</a>")), C("o_orderpriority"))
    second = F.concat(head("th", "Product", "Product"), row("", F.lit("w"), F.lit("")))
    shown = F.when(k % 4 == 0, F.concat(head("th", "Package", "Fixed in"), body)).when(k % 4 == 1, F.concat(head("td", " PACKAGE ", "Remediation"), body)).when(k % 4 == 2, body).otherwise(F.concat(head("th", "Package", ""), body, F.lit("<tr><td> </td></tr>"), second))
    return table(spark, d, "orders").select(k.alias("page_id"), F.concat(F.lit("<table>"), shown, F.lit("</table>")).alias("html"))


@query("html_table_headers", """WITH r AS (SELECT o_orderkey AS page_id, CASE WHEN o_orderkey % 4 = 2 THEN 0 ELSE 1 END AS row_no, CASE WHEN o_orderkey % 4 = 2 THEN 'column_1' ELSE 'package' END AS one,
    CASE o_orderkey % 4 WHEN 0 THEN 'fixed_in' WHEN 1 THEN 'remediation' ELSE 'column_2' END AS two, 'pkg ' || o_orderkey AS a, o_orderpriority AS b FROM orders)
    SELECT page_id, row_no, '{"' || one || '":"' || a || '","' || two || '":"' || b || '","' || one || '_url":"https://base.example.org/p/x"}' AS record FROM r
    UNION ALL SELECT o_orderkey, 4, '{"product":"w","product_2":null}' FROM orders WHERE o_orderkey % 4 = 3""")
def _(spark, d):
    r = T.tables_records(_fix_pages(spark, d), known=["package", "remediation"], first_row=False, base=BASE)
    return r.select("page_id", "row_no", F.to_json("record", {"ignoreNullFields": "false"}).alias("record"))


@query("table_classify", f"WITH {_LONG} SELECT page_id, 'product' AS kind, count(*) AS n FROM (SELECT DISTINCT page_id, row_no FROM long WHERE row_no > 0 AND value <> '') GROUP BY 1")
def _(spark, d):
    r = T.tables_records(region_pages(spark, d))
    return T.table_classify(r, {"package": ["region", "package"], "product": ["nation_key", "region"], "cvss": ["region"]}).groupBy("page_id", "kind").agg(F.count("*").alias("n"))


@query("listing_cards", r"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS h, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS t, generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">'), 1) AS pos FROM pages),
    b AS (SELECT page_id, regexp_replace(regexp_replace(h, '[?#].*$', ''), '/+$', '') AS href, trim(regexp_replace(t, '\s+', ' ', 'g')) AS title, pos FROM a),
    c AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY pos) = 1) SELECT page_id, regexp_extract(href, '/([^/]+)$', 1) AS code, title, CAST(greatest(CASE WHEN page_id % 2 = 0 THEN CAST(ceil((page_id + 1) / 20.0) AS BIGINT) END, page_id % 9 + 1) AS BIGINT) AS pages FROM c WHERE regexp_extract(href, '/([^/]+)$', 1) <> ''""")
def _(spark, d):
    more = F.concat(F.lit('<i data="?page='), (C("page_id") % 9 + 1).cast("string"), F.lit('"></i>'), F.when(C("page_id") % 2 == 0, F.concat(F.lit("共 "), (C("page_id") + 1).cast("string"), F.lit(" 条"))).otherwise(""))
    return T.listing_cards(table(spark, d, "pages").select("page_id", F.concat("html", more).alias("html")), BASE)


def _listing_pages(spark, d):
    """A listing a customer with an entry for each order, in three layouts: table rows, whole-link cards, and headings with a line below; around it a menu, page links and a footer."""
    k = C("o_orderkey")
    key, day, level = k.cast("string"), F.date_format("o_orderdate", "yyyy-M-d"), F.element_at(F.array(F.lit("高危"), F.lit("Medium"), F.lit("low"), F.lit("n/a")), (k % 4 + 1).cast("int"))
    href = F.concat(F.lit("/adv/show/ADV-"), key, F.lit("?from=list"))
    rows = F.concat(F.lit('<tr><td><a href="'), href, F.lit('">Flaw '), key, F.lit("</a></td><td>"), level, F.lit("</td><td>1,"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit("</td><td>"), (k % 7).cast("string"), F.lit("</td><td>"), day, F.lit("</td></tr>"))
    cards = F.concat(F.lit('<a class="card" href="'), href, F.lit('"><div class="card__title"><span class="cat-tag">Update</span>Flaw '), key, F.lit("</div><div>Release Date: "), day, F.lit("</div><div>Severity: "), level, F.lit("</div><div>"), (k % 7).cast("string"), F.lit("</div></a>"))
    heads = F.concat(F.lit('<h3><a href="'), href, F.lit('">Flaw '), key, F.lit("</a></h3><p>"), day, F.lit(" by x</p>"))
    c = C("o_custkey")
    entry = F.when(c % 3 == 0, rows).when(c % 3 == 1, cards).otherwise(heads)
    lists = table(spark, d, "orders").groupBy(c.alias("page_id")).agg(F.sort_array(F.collect_list(F.struct(k.alias("k"), entry.alias("e")))).alias("v"))
    inner = F.array_join(F.transform("v", lambda x: x.e), "\n")
    c = C("page_id")
    body = F.when(c % 3 == 0, F.concat(F.lit("<table><tr><th>Title</th><th>Level</th></tr>"), inner, F.lit("</table>"))).otherwise(F.concat(F.lit("<div>"), inner, F.lit("</div>")))
    foot = F.when(c % 3 == 0, F.concat(F.lit("<p>共 <b>1,"), F.lpad((c % 1000).cast("string"), 3, "0"), F.lit("</b> 条</p>"))).when(c % 3 == 1, '<a href="?page=3">3</a> <a href="?page=12">12</a>').otherwise("Page 2 of 40")
    return lists.select("page_id", F.concat(F.lit('<nav><ul><li><a href="/home">Home</a></li><li><a href="/adv/list">2020-01-01 High 5</a></li></ul></nav>'), body, foot, F.lit("<footer>99 high</footer>")).alias("html"))


@query("listing_entries", """WITH e AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS t, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
    SELECT c AS page_id, CAST(pos AS INTEGER) AS pos, 'ADV-' || k AS code, 'https://base.example.org/adv/show/ADV-' || k || '?from=list' AS href, 'Flaw ' || k AS title, strftime(t, '%Y-%m-%d') AS date,
    CASE WHEN c % 3 < 2 THEN CASE k % 4 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' WHEN 2 THEN 'Low' END END AS severity, CASE c % 3 WHEN 0 THEN (1000 + k % 1000) || '|' || (k % 7) WHEN 1 THEN CAST(k % 7 AS VARCHAR) ELSE '' END AS counts,
    CASE WHEN c % 3 = 0 THEN 1000 + c % 1000 END AS total_records, CAST(CASE c % 3 WHEN 0 THEN ceil((1000 + c % 1000) / n) WHEN 1 THEN 12 ELSE 40 END AS BIGINT) AS total_pages FROM e""")
def _(spark, d):
    found = L.listing_entries(_listing_pages(spark, d), r"/adv/show/(ADV-\d+)", BASE)
    return found.withColumn("counts", F.array_join("counts", "|"))


@query("timeline_rows", "SELECT user_id AS id, strftime(ts, '%Y-%m-%d') AS day, event_type AS event, count(*) AS n FROM events GROUP BY 1, 2, 3")
def _(spark, d):
    line = F.concat(F.date_format("ts", "yyyy-M-d"), F.lit(": "), C("event_type"))
    logs = table(spark, d, "events").groupBy(C("user_id").alias("id"), F.to_date("ts").alias("g")).agg(F.array_join(F.collect_list(line), "\n").alias("t"))
    rows = T.timeline_rows(logs.withColumn("t", F.concat(F.lit("intro\n"), "t")), "t")
    return rows.groupBy("id", F.date_format("day", "yyyy-MM-dd").alias("day"), "event").agg(F.count("*").alias("n"))


@query("package_pairs", "SELECT p_partkey, p_name || '=' || p_size || '|x=2.0' AS pairs FROM part")
def _(spark, d):
    t = F.concat(F.lit("Packages\nx -> 1.0\n"), C("p_name"), F.lit(" -> "), C("p_size").cast("string"), F.lit("\nnothing\nx ->  2.0"))
    m = F.array_join(F.transform(F.array_sort(F.map_entries(T.package_pairs(t))), lambda e: F.concat_ws("=", e.key, e.value)), "|")
    return table(spark, d, "part").select("p_partkey", m.alias("pairs"))
