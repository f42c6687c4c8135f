"""Queries over nested documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import nested as N
from ..functions import text as X
from ..functions.severity import severity_normalize
from . import adapters as A
from .registry import query, table

C = F.col


def _lines(spark, d):
    """Line items by order, in order."""
    cols = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus"]
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("v"))


_L = "SELECT l_orderkey, list({0} ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus) AS v FROM lineitem GROUP BY l_orderkey"


@query("compact_doc", """SELECT l_orderkey, CAST(count(*) AS BIGINT) AS kept, count(*) FILTER (WHERE l_returnflag <> 'N') AS named, CAST(count(*) FILTER (WHERE l_quantity > 25) = 0 AS BOOLEAN) AS no_tags FROM lineitem GROUP BY 1""")
def _(spark, d):
    doc = F.struct(
        F.transform("v", lambda x: F.struct(F.when(x.l_returnflag == "N", " ").otherwise(x.l_returnflag).alias("flag"), F.lit(0).alias("zero"), F.lit(False).alias("no"))).alias("items"),
        F.struct(F.lit("").alias("a"), F.array(F.lit(" ")).alias("b")).alias("gone"), F.transform(F.filter("v", lambda x: x.l_quantity > 25), lambda x: x.l_returnflag).alias("tags"),
    )
    rows = _lines(spark, d).select("l_orderkey", doc.alias("doc"))
    c = N.compact(C("doc"), rows.schema["doc"].dataType)
    out = rows.select("l_orderkey", c.alias("c")).where("c.gone is null")
    return out.select("l_orderkey", F.size("c.items").cast("long").alias("kept"), F.size(F.filter("c.items", lambda x: x.flag.isNotNull())).cast("long").alias("named"), C("c.tags").isNull().alias("no_tags"))


@query("compact_json", """SELECT c_custkey, '{"id":' || c_custkey || ',"keep":[false,0],"name":"' || c_name || '"}' AS doc FROM customer""")
def _(spark, d):
    doc = F.concat(F.lit('{"name":" '), C("c_name"), F.lit(' ","x":{"y":[null,"",{}]},"keep":[false,0,""],"id":'), C("c_custkey").cast("string"), F.lit("}"))
    return table(spark, d, "customer").select("c_custkey", N.compact_json(doc).alias("doc"))


def _customer_doc(prefix=""):
    return F.to_json(F.struct(C("c_name").alias("name"), F.struct(C("c_mktsegment").alias("segment"), F.lit(" ").alias("blank")).alias("info"), F.lit("z").alias("raw_html"), C("c_acctbal").cast("string").alias("balance")))


@query("path_get", "SELECT c_custkey, c_mktsegment AS segment, c_name AS first_of, '{\"name\":\"' || c_name || '\"}' AS without FROM customer")
def _(spark, d):
    doc = _customer_doc()
    flat = F.to_json(F.struct(C("c_name").alias("name"), C("c_mktsegment").alias("segment"), F.lit("z").alias("raw_html"), F.lit("").alias("none")))
    return table(spark, d, "customer").select("c_custkey", N.path_get(doc, "info.segment").alias("segment"), N.path_first(doc, ["info.blank", "missing.x", "name"]).alias("first_of"), N.drop_keys(flat, "segment").alias("without"))


@query("path_delete", "SELECT c_custkey, '{\"name\":\"' || c_name || '\",\"info\":{\"blank\":\" \"}}' AS doc FROM customer")
def _(spark, d):
    return table(spark, d, "customer").select("c_custkey", N.path_delete(_customer_doc(), "info.segment", "raw_html", "balance", "name.first", "gone.x").alias("doc"))


@query("detail_clean", f"""WITH {A.ADV} SELECT k, '{{' || CASE WHEN k % 3 = 0 THEN '' ELSE '"ref":"R-' || k || '",' END || '"vendor":"v' || (k % 7) || '"}}' AS cleaned FROM adv""")
def _(spark, d):
    from ..functions.times import parse_hk
    from ..operators.documents import detail_clean

    details = F.create_map(
        F.lit("cve_id"), F.upper(F.concat(F.lit("cve-"), X.cve_normalize(C("cve_raw")))), F.lit("title"), F.upper("title"), F.lit("severity"), F.lower("severity_raw"), F.lit("published_at"), C("published_raw"),
        F.lit("detail_url"), C("detail_url"), F.lit("vuln_status"), F.lit("x"), F.lit("raw_tables"), F.lit("y"), F.lit("ref"), F.when(C("k") % 3 == 0, " ").otherwise(F.concat(F.lit("R-"), C("k").cast("string"))),
        F.lit("vendor"), F.concat(F.lit("v"), (C("k") % 7).cast("string")),
    )
    rows = A.adv(spark, d).withColumn("provider", F.lit("nvd")).withColumn("details", details).withColumn("_published", parse_hk(C("published_raw")))
    return rows.select("k", detail_clean(rows).alias("m")).select("k", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("m")))).alias("cleaned"))


@query("detail_flatten", f"WITH {A.ADV} SELECT k, CASE WHEN k % 2 = 0 THEN 'own' ELSE 'plain' END AS v FROM adv")
def _(spark, d):
    own, plain = F.create_map(F.lit("x"), F.lit("own")), F.create_map(F.lit("x"), F.lit("plain"))
    details = F.when(C("k") % 2 == 0, F.map_from_arrays(F.array("provider"), F.array(own))).otherwise(F.create_map(F.lit("*"), plain))
    return A.adv(spark, d).select("k", N.detail_flatten(details, C("provider"))["x"].alias("v"))


@query("source_clean", f"WITH {A.ADV} SELECT k, provider, CASE WHEN url <> detail_url THEN url END AS url, detail_url FROM adv")
def _(spark, d):
    return A.adv(spark, d).select("k", N.source_clean(C("provider"), C("url"), C("detail_url")).alias("s")).select("k", "s.provider", "s.url", "s.detail_url")


@query("change_type", f"WITH {A.ADV} SELECT k, CASE WHEN k % 5 = 0 THEN 'new' WHEN k % 5 < 3 THEN 'updated' END AS change, CASE WHEN k % 5 > 2 AND k % 7 > 0 THEN status END AS kept FROM adv")
def _(spark, d):
    details = F.create_map(F.lit("note"), F.when(C("k") % 7 == 0, F.lower("status")).otherwise("n"))
    return A.adv(spark, d).select("k", N.change_type(C("status")).alias("change"), N.source_status(C("status"), severity_normalize(C("severity_raw")), details).alias("kept"))


@query("containers_merge", f"WITH l AS ({_L.format('l_returnflag')}) SELECT l_orderkey, array_to_string(v, '') AS affected, CASE WHEN len(v) > 1 THEN v[2] END AS title FROM l")
def _(spark, d):
    box = lambda x, t: F.struct(F.array(x.l_returnflag).alias("affected"), t.alias("title"))
    first = box(F.get(C("v"), F.lit(0)), F.lit(" "))
    others = F.transform(F.slice("v", F.lit(2), F.size("v")), lambda x: box(x, x.l_returnflag))
    titles = F.filter(F.transform(F.concat(F.array(first), others), lambda c: F.trim(c.title)), lambda t: t != "")
    return _lines(spark, d).select("l_orderkey", F.array_join(N.merge_containers(first, others, "affected"), "").alias("affected"), F.get(titles, F.lit(0)).alias("title"))


@query("dedupe_by_key", f"""WITH l AS ({_L.format('l_returnflag')}), u AS (SELECT l_orderkey, unnest(v) AS f, generate_subscripts(v, 1) AS i FROM l), m AS (SELECT l_orderkey, f, min(i) AS i FROM u GROUP BY 1, 2)
    SELECT l_orderkey, string_agg(f || (i % 10), '|' ORDER BY i) AS refs FROM m GROUP BY 1""")
def _(spark, d):
    refs = F.transform("v", lambda x, i: F.struct(F.when(x.l_returnflag != "N", x.l_returnflag).alias("url"), F.lit("n").alias("name"), F.when(x.l_returnflag != "N", i + 1).alias("at")))
    got = N.dedupe_by_key(refs, lambda x: x.url, "struct<url:string,name:string,at:int>")
    rows = _lines(spark, d).withColumn("first_n", F.array_position(F.transform("v", lambda x: x.l_returnflag), "N")).select("l_orderkey", "first_n", got.alias("r"))
    shown = F.transform("r", lambda x: F.concat(F.coalesce(x.url, F.lit("N")), (F.coalesce(x.at.cast("long"), C("first_n")) % 10).cast("string")))
    return rows.select("l_orderkey", F.array_join(shown, "|").alias("refs"))


@query("pick_language", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang ELSE 'second' END AS picked FROM documents")
def _(spark, d):
    entry = lambda lang, v: F.struct(lang.alias("lang"), v.alias("value"))
    texts = F.array(entry(F.lit("en"), F.lit("  ")), entry(F.lit("xx"), C("lang")), entry(F.when(C("doc_id") % 2 == 1, "EN-us").otherwise("yy"), F.lit("second")))
    return table(spark, d, "documents").select("doc_id", N.pick_language(texts).alias("picked"))


@query("metric_preference", f"""WITH l AS ({_L.format("{'n': l_linenumber, 'q': l_quantity, 'f': l_returnflag}")}),
    p AS (SELECT l_orderkey, list_filter(v, lambda x: x.n % 2 = 0) AS v31, list_filter(v, lambda x: x.n % 2 = 1) AS v30 FROM l),
    c AS (SELECT l_orderkey, CASE WHEN len(v31) > 0 THEN '3.1' ELSE '3.0' END AS version, CASE WHEN len(v31) > 0 THEN v31 ELSE v30 END AS m FROM p)
    SELECT l_orderkey, version, coalesce(list_filter(m, lambda x: x.f = 'A')[1].q, m[1].q) AS score FROM c""")
def _(spark, d):
    from ..operators.documents import metric_preference

    m = F.transform("v", lambda x: F.struct(F.when(x.l_returnflag == "A", "Primary").otherwise("Secondary").alias("type"), x.l_quantity.alias("score"), F.lit("HIGH").alias("severity"), F.lit("AV:N").alias("vector"), x.l_linenumber.alias("n")))
    none = F.array().cast("array<struct<type:string,score:double,severity:string,vector:string,n:int>>")
    rows = _lines(spark, d).select("l_orderkey", F.filter(m, lambda x: x.n % 2 == 0).alias("v31"), F.filter(m, lambda x: x.n % 2 == 1).alias("v30"))
    return rows.select("l_orderkey", metric_preference({"4.0": none, "3.1": C("v31"), "3.0": C("v30"), "2.0": none}).alias("m")).select("l_orderkey", "m.version", "m.score")


@query("metrics_regroup", """SELECT l_orderkey, count(*) FILTER (WHERE l_linenumber % 3 = 0) AS v31, count(*) FILTER (WHERE l_linenumber % 3 = 1) AS v30, count(*) FILTER (WHERE l_linenumber % 3 = 2) AS other,
    CAST(coalesce(sum(CASE WHEN l_linenumber % 3 = 0 THEN l_quantity END), 0) AS BIGINT) AS sum31 FROM lineitem GROUP BY 1""")
def _(spark, d):
    from ..operators.documents import metrics_regroup

    score = lambda x, r: F.when(x.l_linenumber % 3 == r, F.struct(x.l_quantity.alias("score")))
    metrics = F.transform("v", lambda x: F.struct(score(x, 0).alias("cvssV3_1"), score(x, 1).alias("cvssV3_0"), F.when(x.l_linenumber % 3 == 2, x.l_returnflag).alias("other")))
    rows = _lines(spark, d).select("l_orderkey", metrics_regroup(metrics, {"cvss_v31": "cvssV3_1", "cvss_v30": "cvssV3_0"}, ["other"]).alias("m"))
    n = lambda c: F.size(c).cast("long")
    total = F.aggregate("m.cvss_v31", F.lit(0.0), lambda acc, x: acc + x.score)
    return rows.select("l_orderkey", n("m.cvss_v31").alias("v31"), n("m.cvss_v30").alias("v30"), n("m.other").alias("other"), total.cast("long").alias("sum31"))


@query("cpe_products", """WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus, 'v' || (l_suppkey % 5) || ':p' || (l_partkey % 3) AS p FROM lineitem),
    a AS (SELECT l_orderkey, p, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus) AS i FROM t), f AS (SELECT l_orderkey, p, min(i) AS i FROM a GROUP BY 1, 2)
    SELECT l_orderkey, string_agg(p, '|' ORDER BY i) || '|x:y' AS products FROM f GROUP BY 1""")
def _(spark, d):
    from ..operators.documents import cpe_products

    cpe = lambda x: F.concat(F.lit("cpe:2.3:a:v"), (x.l_suppkey % 5).cast("string"), F.lit(":p"), (x.l_partkey % 3).cast("string"), F.lit(":*"))
    nodes = F.transform("v", lambda x: F.struct(F.array(F.struct(cpe(x).alias("criteria"))).alias("cpeMatch")))
    config = F.array(F.struct(nodes.alias("nodes")))
    affected = F.array(F.struct(F.lit("x").alias("vendor"), F.lit("y").alias("product")))
    return _lines(spark, d).select("l_orderkey", F.array_join(cpe_products(config, affected), "|").alias("products"))


@query("cvrf_explode", """SELECT strftime(o_orderdate, '%Y-%m') AS document, 'CVE-2024-' || (o_orderkey + 1000) AS cve, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m') ELSE 'T' || o_orderkey END AS title, o_orderpriority AS vuln_type
    FROM orders WHERE o_orderkey % 7 > 0""")
def _(spark, d):
    from ..operators.documents import cvrf_explode

    k = C("o_orderkey")
    v = F.struct(
        F.when(k % 7 == 0, "none").otherwise(F.concat(F.lit("cve-2024-"), (k + 1000).cast("string"))).alias("CVE"), F.when(k % 3 > 0, F.concat(F.lit("T"), k.cast("string"))).alias("Title"), F.array(F.lit(" "), C("o_orderpriority")).alias("Threats")
    )
    docs = table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("document")).agg(F.collect_list(v).alias("Vulnerability"))
    return cvrf_explode(docs).select("document", "cve", "title", "vuln_type")


@query("product_tree", "SELECT 's' || s_suppkey AS id, 'S ' || s_name AS name, 3 AS depth FROM supplier UNION ALL SELECT 'n' || n_nationkey, n_name, 2 FROM nation UNION ALL SELECT 'r' || r_regionkey, r_name, 1 FROM region")
def _(spark, d):
    from ..operators.documents import product_tree

    node = lambda i, parent, name: (i.alias("id"), parent.alias("parent"), name.alias("name"))
    key = lambda p, c: F.concat(F.lit(p), C(c).cast("string"))
    nodes = table(spark, d, "region").select(*node(key("r", "r_regionkey"), F.lit(None).cast("string"), C("r_name")))
    nodes = nodes.unionByName(table(spark, d, "nation").select(*node(key("n", "n_nationkey"), key("r", "n_regionkey"), C("n_name"))))
    nodes = nodes.unionByName(table(spark, d, "supplier").select(*node(key("s", "s_suppkey"), key("n", "s_nationkey"), F.concat(F.lit("S "), C("s_name")))))
    return product_tree(nodes).select("id", "name", "depth")


@query("product_names_join", """WITH t AS (SELECT l_orderkey, p_name, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_partkey % 5 > 0)
    SELECT l_orderkey, string_agg(p_name, '|' ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus) AS names FROM t GROUP BY 1""")
def _(spark, d):
    from ..operators.documents import product_names_join

    names = table(spark, d, "part").where("p_partkey % 5 > 0").select(C("p_partkey").alias("product_id"), C("p_name").alias("name"))
    sets = _lines(spark, d).select(C("l_orderkey").alias("key"), F.transform("v", lambda x: x.l_partkey).alias("product_ids"))
    return product_names_join(sets, names).select(C("key").alias("l_orderkey"), F.array_join("names", "|").alias("names")).where("names <> ''")


@query("merge_detail", """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'd' ELSE 'l' END || o_orderkey AS title, CASE WHEN o_orderkey % 3 = 0 THEN 'u|' ELSE '' END || 'a|b|c' AS links, CASE WHEN o_orderkey % 11 = 0 THEN 'id_mismatch' END AS error FROM orders""")
def _(spark, d):
    from ..operators.documents import merge_detail

    k = C("o_orderkey")
    o = table(spark, d, "orders")
    listing = o.select(k.alias("id"), k.cast("string").alias("code"), F.concat(F.lit("l"), k.cast("string")).alias("title"), F.array(F.lit("b"), F.lit("c")).alias("links"))
    detail = o.select(k.alias("id"), F.when(k % 11 == 0, "other").otherwise(k.cast("string")).alias("code"), F.when(k % 2 == 0, F.concat(F.lit("d"), k.cast("string"))).otherwise(" ").alias("title"), F.array(F.lit("a"), F.lit("b")).alias("links"), F.when(k % 3 == 0, "u").alias("url"))
    return merge_detail(listing, detail, "id").select(C("id").alias("o_orderkey"), "title", F.array_join("links", "|").alias("links"), "error")


@query("merge_identifiers", f"""WITH {A.ADV_TEXT} SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'CVE-1999-0001' WHEN doc_id % 5 < 3 THEN 'CVE-2024-' || (doc_id + 1000) || '|CVE-1999-0001' ELSE 'CVE-2024-' || (doc_id + 1000) || '|CVE-2023-' || (doc_id + 2000) || '|CVE-1999-0001' END AS ids FROM adv_text""")
def _(spark, d):
    table_ids = F.array(F.lit("CVE-1999-0001"), F.get(X.cve_extract(C("text"), X.CVE_BOUNDED), F.lit(0)))
    merged = F.array_compact(F.array_union(X.cve_extract(C("text"), X.CVE_BOUNDED), table_ids))
    return A.adv_text(spark, d).select("doc_id", F.array_join(merged, "|").alias("ids"))


@query("legacy_shape_upgrade", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name || '|' || p_type ELSE p_name END AS products, CASE WHEN p_partkey % 2 = 0 THEN 'old' ELSE 'new' END AS intro FROM part")
def _(spark, d):
    from ..operators.documents import legacy_shape_upgrade

    k = C("p_partkey")
    old = F.to_json(F.struct(F.concat_ws(", ", "p_name", "p_type").alias("vulnerable_products"), F.lit("old").alias("intro_tables")))
    new = F.to_json(F.struct(F.array("p_name").alias("affected_products"), F.lit("new").alias("introduction")))
    return table(spark, d, "part").select("p_partkey", legacy_shape_upgrade(F.when(k % 2 == 0, old).otherwise(new)).alias("u")).select("p_partkey", F.array_join("u.affected_products", "|").alias("products"), C("u.introduction").alias("intro"))


@query("list_view", f"WITH {A.OBSERVATIONS} SELECT identity, arg_max(event_id, (CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END, observed_at, event_id)) AS event_id FROM observations GROUP BY 1")
def _(spark, d):
    from ..operators.select import best_per_key

    o = A.observations(spark, d)
    return best_per_key(o, ["identity"], [(C("event_type") == "purchase").cast("int"), C("observed_at"), C("event_id")]).select("identity", "event_id")
