"""Queries over sources and sinks: payloads are rendered from the tables and read back."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from ..functions.times import stamp
from ..sources import landing as L
from ..sources import payloads as P
from . import adapters as A
from .registry import query, table

C = F.col


@query("src_landing", r"SELECT page_id, lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)) AS provider, url, length(html) AS n_body FROM pages")
def _(spark, d):
    path = L.shared_path(spark, "landing")
    table(spark, d, "pages").select(
        L.landing_host(C("url")).alias("provider"), "url", C("page_id").alias("page"), F.lit("text/html").alias("content_type"), C("html").alias("body"), F.lit("2024-01-01").cast("timestamp_ntz").alias("fetched_at")
    ).write.parquet(path)
    return L.read_landing(spark, path).select(C("page").alias("page_id"), "provider", "url", F.length("body").cast("long").alias("n_body"))


def nvd_payloads(spark, d):
    """Pages of 50; in each the 49th entry is blank and the 50th repeats the first."""
    k = C("k")
    cve = F.struct(
        F.when(k % 50 == 48, "").when(k % 50 == 49, F.concat(F.lit("cve-"), (k - 49).cast("string"))).otherwise(F.concat(F.lit("CVE-"), k.cast("string"))).alias("id"), C("published_raw").alias("published"), C("status").alias("vulnStatus")
    )
    pages = A.adv(spark, d).groupBy(F.floor(k / 50).alias("page")).agg(F.array_sort(F.collect_list(F.struct("k", cve.alias("cve")))).alias("v"), F.count("*").alias("n"))
    shown = F.struct(F.lit(50).alias("resultsPerPage"), (C("page") * 50).cast("int").alias("startIndex"), (C("n") * 7).cast("int").alias("totalResults"), F.transform("v", lambda x: F.struct(x.cve.alias("cve"))).alias("vulnerabilities"))
    return pages.select("page", F.to_json(shown).alias("body"))


@query("src_nvd_json", f"WITH {A.ADV}, p AS (SELECT k // 50 AS page, count(*) AS n FROM adv GROUP BY 1) SELECT CAST(k // 50 AS BIGINT) AS page, 'CVE-' || k AS code, status, CAST(ceil(n * 7 / 50.0) AS BIGINT) AS total_pages FROM adv JOIN p ON p.page = k // 50 WHERE k % 50 < 48")
def _(spark, d):
    return P.nvd_entries(nvd_payloads(spark, d)).select("page", "code", "status", "total_pages")


@query("src_ghsa_json", "SELECT 'GHSA-' || c_custkey AS code, c_name AS summary FROM customer WHERE c_custkey % 9 <> 0")
def _(spark, d):
    k = C("c_custkey")
    one = F.struct(F.when(k % 9 == 0, F.concat(F.lit("X-"), k.cast("string"))).otherwise(F.concat(F.lit("GHSA-"), k.cast("string"))).alias("ghsa_id"), C("c_name").alias("summary"))
    rows = table(spark, d, "customer").select(k.alias("page"), one.alias("a"))
    body = F.when(k % 4 == 0, F.to_json(F.array("a"))).when(k % 4 == 1, F.to_json(F.struct(F.array("a").alias("advisories")))).when(k % 4 == 2, F.to_json(F.struct(F.array("a").alias("items")))).otherwise(F.to_json("a"))
    return P.ghsa_entries(rows.withColumn("c_custkey", C("page")).select("page", body.alias("body"))).select("code", "summary")


@query("src_msrc_index", """WITH m AS (SELECT strftime(o_orderdate, '%Y-%b') AS month, count(*) AS n FROM orders GROUP BY 1)
    SELECT CASE WHEN n % 2 = 0 THEN month ELSE 'alias ' || month END AS code, CASE WHEN n % 3 = 0 THEN 'Updates ' || month WHEN n % 2 = 0 THEN month ELSE 'alias ' || month END AS title FROM m""")
def _(spark, d):
    m = table(spark, d, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MMM").alias("month")).agg(F.count("*").alias("n"))
    v = F.struct(F.when(C("n") % 2 == 0, C("month")).otherwise(" ").alias("ID"), F.concat(F.lit("alias "), C("month")).alias("Alias"), F.when(C("n") % 3 == 0, F.concat(F.lit("Updates "), C("month"))).alias("DocumentTitle"))
    landed = m.select(C("n").alias("page"), F.to_json(F.struct(F.array(v).alias("value"))).alias("body"))
    return P.msrc_entries(landed).select("code", "title")


def delta_payloads(spark, d):
    """One batch an hour; each event is an entry, error events are deletions."""
    e = table(spark, d, "events")
    entry = F.struct(
        F.when(C("event_id") % 17 == 0, "bad").otherwise(F.concat(F.lit("CVE-2024-"), (C("user_id") + 1000).cast("string"))).alias("cveId"), F.when(C("event_id") % 5 > 0, F.concat(F.lit("https://g/"), C("event_id").cast("string"))).alias("githubLink"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("dateUpdated"),
    )
    pick = lambda cond: F.transform(F.filter("v", cond), lambda x: x.entry)
    batches = e.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.array_sort(F.collect_list(F.struct("event_id", "event_type", entry.alias("entry")))).alias("v"))
    batch = F.struct(
        F.date_format("hour", "yyyy-MM-dd'T'HH:mm:ss").alias("fetchTime"), pick(lambda x: x.event_type == "signup").alias("new"),
        pick(lambda x: ~x.event_type.isin("signup", "error")).alias("updated"), pick(lambda x: x.event_type == "error").alias("deleted"),
    )
    return batches.select(F.lit(0).alias("page"), F.to_json(F.array(batch)).alias("body"))


DELTA = """delta AS (SELECT event_id, date_trunc('hour', ts) AS fetch_time, CASE event_type WHEN 'signup' THEN 'new' WHEN 'error' THEN 'deleted' ELSE 'updated' END AS action,
    CASE WHEN event_id % 17 > 0 THEN 'CVE-2024-' || (user_id + 1000) END AS cve, CASE WHEN event_id % 5 > 0 THEN 'https://g/' || event_id END AS link, date_trunc('second', ts) AS changed,
    CASE WHEN event_id % 17 = 0 THEN 'bad_id' WHEN event_type <> 'error' AND event_id % 5 = 0 THEN 'no_link' END AS reject FROM events)"""


@query("src_delta_log", f"WITH {DELTA} SELECT {A.stamp_sql('fetch_time')} AS fetch_time, action, cve, link, {A.stamp_sql('changed')} AS changed, reject FROM delta WHERE fetch_time > TIMESTAMP '2024-01-10 00:00:00'")
def _(spark, d):
    from ..functions.times import stamp

    rows = P.delta_entries(delta_payloads(spark, d), F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"))
    return rows.select(stamp(C("fetch_time")).alias("fetch_time"), "action", "cve", "link", stamp(C("changed")).alias("changed"), "reject")


def _qianxin(spark, d):
    k = C("s_suppkey")
    item = F.struct(F.when(k % 7 > 0, k).alias("id"), F.when(k % 11 > 0, C("s_name")).otherwise(" ").alias("title"), F.lit("高危").alias("level"))
    body = F.struct(F.when(k % 5 == 0, 500).otherwise(200).alias("status"), F.struct(F.array(item).alias("data")).alias("data"))
    return P.qianxin_entries(table(spark, d, "supplier").select(k.alias("page"), F.to_json(body).alias("body")))


@query("src_qianxin_json", "SELECT s_suppkey AS id, s_name AS title FROM supplier WHERE s_suppkey % 5 > 0 AND s_suppkey % 7 > 0 AND s_suppkey % 11 > 0")
def _(spark, d):
    return _qianxin(spark, d)[0].select("id", "title")


@query("src_qianxin_rejects", "SELECT s_suppkey AS page, CASE WHEN s_suppkey % 5 = 0 THEN 'status 500' ELSE 'no id or title' END AS reason FROM supplier WHERE s_suppkey % 5 = 0 OR s_suppkey % 7 = 0 OR s_suppkey % 11 = 0")
def _(spark, d):
    return _qianxin(spark, d)[1].select("page", "reason")


@query("src_huawei_json", "SELECT 'huawei-sa-' || s_suppkey AS code, s_name AS title, CASE WHEN s_suppkey % 2 = 0 THEN 'CVE-2024-' || (s_suppkey + 1000) ELSE '' END AS cves FROM supplier WHERE s_suppkey % 5 > 0")
def _(spark, d):
    k = C("s_suppkey")
    cve = F.concat(F.lit("2024-"), (k + 1000).cast("string"))
    item = F.struct(F.concat(F.lit("huawei-sa-"), k.cast("string")).alias("sasnNo"), C("s_name").alias("title"), F.array(F.struct(F.when(k % 2 == 0, cve).alias("cveId")), F.struct(F.lit("n/a").alias("cveId"))).alias("vul"))
    landed = table(spark, d, "supplier").select(k.alias("page"), F.to_json(F.struct(F.when(k % 5 == 0, "500").otherwise("200").alias("status"), F.array(item).alias("data"))).alias("body"))
    return P.huawei_entries(landed)[0].select("code", "title", F.array_join("cves", "|").alias("cves"))


def _rss(spark, d):
    """Feeds of 60 items; every seventh has no link, one feed in ten is broken, one in ten empty, one in ten without links."""
    k, feed = C("o_orderkey"), F.floor(C("o_orderkey") / 60)
    link = F.when((k % 7 == 0) | (feed % 10 == 5), "").otherwise(F.concat(F.lit("<link> https://r.example.org/"), k.cast("string"), F.lit("?a=1&amp;b=2 </link>")))
    item = F.concat(F.lit("<item><title>Fix &lt;"), k.cast("string"), F.lit("&gt;</title>"), link, F.lit("<dc:creator>"), C("o_orderpriority"), F.lit("</dc:creator><description><![CDATA[<b>x</b>]]></description></item>"))
    feeds = table(spark, d, "orders").groupBy(feed.alias("page")).agg(F.array_sort(F.collect_list(F.struct(k.alias("k"), item.alias("item")))).alias("v"))
    items = F.when(C("page") % 10 == 4, "").otherwise(F.array_join(F.transform("v", lambda x: x.item), ""))
    return feeds.select("page", F.concat(F.lit('<rss xmlns:dc="http://purl.org/dc/elements/1.1/">'), F.when(C("page") % 10 == 3, "<title>x</title>").otherwise(F.concat(F.lit("<channel><title>t</title>"), items, F.lit("</channel>"))), F.lit("</rss>")).alias("body"))


@query("src_rss", """SELECT CAST(o_orderkey // 60 AS BIGINT) AS page, 'Fix <' || o_orderkey || '>' AS title, 'https://r.example.org/' || o_orderkey || '?a=1&b=2' AS link, o_orderpriority AS creator FROM orders
    WHERE o_orderkey % 7 > 0 AND (o_orderkey // 60) % 10 NOT IN (3, 4, 5)""")
def _(spark, d):
    return P.rss_entries(_rss(spark, d)).select("page", "title", "link", "creator")


@query("src_rss_capped", """SELECT CAST(o_orderkey // 60 AS BIGINT) AS page, 'https://r.example.org/' || o_orderkey || '?a=1&b=2' AS link FROM orders
    WHERE o_orderkey % 7 > 0 AND (o_orderkey // 60) % 10 NOT IN (3, 4, 5) AND o_orderkey % 60 < 50""")
def _(spark, d):
    """The publisher whose feed counts only its first 50 items: that limit is the feature."""
    return P.rss_entries(_rss(spark, d), cap=P.MAX_FEED_ITEMS).select("page", "link")


@query("rss_state", "SELECT DISTINCT CAST(o_orderkey // 60 AS BIGINT) AS page, CASE (o_orderkey // 60) % 10 WHEN 3 THEN 'no_channel' WHEN 4 THEN 'exhausted' WHEN 5 THEN 'no_links' ELSE 'ok' END AS state FROM orders")
def _(spark, d):
    return P.rss_state(_rss(spark, d))


@query("src_cpe_csv", "SELECT lower(replace(p_brand, '#', '')) AS vendor, p_name || ', \"x\"' AS product, CASE WHEN p_partkey % 2 = 0 THEN 'cpe:' || p_partkey END AS cpe, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS title FROM part")
def _(spark, d):
    k = C("p_partkey")
    vendor, product = F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))), F.concat(F.lit('"'), C("p_name"), F.lit(', \\"x\\""'))
    line = F.when(k % 2 == 0, F.concat_ws(",", F.concat(F.lit("cpe:"), k.cast("string")), vendor, product, C("p_type"))).otherwise(F.concat_ws(",", vendor, product))
    return P.cpe_rows(table(spark, d, "part").select(k, line.alias("line")), k % 2 == 0)


def _archives(spark, d):
    """One archive a thousand orders, with an archive inside it."""

    def build(pdf):
        inner, outer = io.BytesIO(), io.BytesIO()
        with zipfile.ZipFile(inner, "w") as z:
            for k in pdf["o_orderkey"][pdf["o_orderkey"] % 2 == 0]:
                z.writestr(f"cves/CVE-{2000 + k % 26}-{k + 1000}.json", "{}")
        with zipfile.ZipFile(outer, "w") as z:
            z.writestr("readme.txt", "x")
            z.writestr("inner.zip", inner.getvalue())
            for k in pdf["o_orderkey"]:
                z.writestr(f"d/CVE-{2000 + k % 26}-{k + 1000}.json", "{}")
        return pd.DataFrame({"content": [outer.getvalue()]})

    return table(spark, d, "orders").select("o_orderkey").groupBy(F.floor(C("o_orderkey") / 1000)).applyInPandas(build, "content binary")


@query("src_zip_manifest", "SELECT DISTINCT (2000 + o_orderkey % 26) || '-' || (o_orderkey + 1000) AS code, 2000 + o_orderkey % 26 AS year, o_orderkey + 1000 AS number FROM orders")
def _(spark, d):
    return P.zip_manifest(_archives(spark, d))


@query("manifest_pages", """WITH m AS (SELECT 2000 + o_orderkey % 26 AS year, o_orderkey + 1000 AS number FROM orders)
    SELECT year || '-' || number AS code, year, number, CAST((row_number() OVER (ORDER BY year DESC, number DESC) - 1) // 100 + 1 AS BIGINT) AS page, CAST(ceil((count(*) OVER ()) / 100.0) AS BIGINT) AS pages FROM m""")
def _(spark, d):
    k = C("o_orderkey")
    m = table(spark, d, "orders").select((k % 26 + 2000).alias("year"), (k + 1000).alias("number"))
    return P.manifest_pages(m.select(F.concat_ws("-", C("year").cast("string"), C("number").cast("string")).alias("code"), "year", "number"))


@query("sink_run_output", f"WITH {A.FAILURES}, {A.OBSERVATIONS} SELECT identity, count(*) AS n FROM observations WHERE identity NOT IN (SELECT identity FROM failures) GROUP BY 1")
def _(spark, d):
    return L.run_output(A.observations(spark, d).select("identity", "event_id"), A.failures(spark, d)).groupBy("identity").agg(F.count("*").alias("n"))


_RUN = f"""{A.FAILURES}, failed AS (SELECT provider, identity, arg_max(error, (updated_at, error)) AS error, max(updated_at) AS updated_at FROM failures GROUP BY 1, 2),
    records AS (SELECT 'p' || (user_id % 7) AS provider, 'id' || user_id AS identity, count(*) AS n FROM events GROUP BY 1, 2),
    first AS (SELECT * FROM records QUALIFY row_number() OVER (PARTITION BY provider ORDER BY identity) <= 100),
    selected AS (SELECT * FROM first WHERE (provider, identity) NOT IN (SELECT (provider, identity) FROM failed))"""


def _run(spark, d):
    """Records of seven providers, failures of six, and what three listings said."""
    provider = F.concat(F.lit("p"), (C("user_id") % 7).cast("string"))
    records = table(spark, d, "events").groupBy(provider.alias("provider"), F.concat(F.lit("id"), C("user_id").cast("string")).alias("identity")).agg(F.count("*").alias("n"), F.lit(0).alias("pos"))
    listed = table(spark, d, "region").where("r_regionkey < 3").select(F.concat(F.lit("p"), C("r_regionkey").cast("string")).alias("provider"), (C("r_regionkey") * 5000).cast("long").alias("total"), F.lit("exhausted").alias("stop_reason"))
    return L.run_report(records, A.failures(spark, d), listed, limit=100)


@query("run_report", f"""WITH {_RUN}, names AS (SELECT provider FROM records UNION SELECT provider FROM failed)
    SELECT provider, CAST(CASE provider WHEN 'p1' THEN 5000 WHEN 'p2' THEN 10000 ELSE coalesce((SELECT count(*) FROM records r WHERE r.provider = names.provider), 0) END AS BIGINT) AS total,
    (SELECT count(*) FROM selected s WHERE s.provider = names.provider) AS result_count, (SELECT count(*) FROM failed f WHERE f.provider = names.provider) AS failed, 100 AS raw_limit, CASE WHEN provider IN ('p0', 'p1', 'p2') THEN 'exhausted' END AS stop_reason FROM names""")
def _(spark, d):
    return _run(spark, d)[0]


@query("run_report_records", f"WITH {_RUN} SELECT provider, identity, n FROM selected")
def _(spark, d):
    return _run(spark, d)[1].select("provider", "identity", "n")


@query("run_report_failures", f"WITH {_RUN} SELECT provider, identity, error, {A.stamp_sql('updated_at')} AS updated_at FROM failed")
def _(spark, d):
    return _run(spark, d)[2].select("provider", "identity", "error", stamp(C("updated_at")).alias("updated_at"))


@query("sink_failure_log", f"WITH {A.FAILURES} SELECT event_id % 2 AS part, count(*) AS n, count(status_code) AS with_status, CAST(sum(length(error)) AS BIGINT) AS n_error FROM failures GROUP BY 1")
def _(spark, d):
    path, rows = L.shared_path(spark, "failure-log"), A.failures(spark, d)
    for phase in ("list", "detail"):
        L.append_failure_log(rows.where(C("phase") == phase), path)
    log = spark.read.schema("phase string, status_code int, error string").json(path)
    return log.groupBy(F.when(C("phase") == "list", 0).otherwise(1).cast("long").alias("part")).agg(F.count("*").alias("n"), F.count("status_code").alias("with_status"), F.sum(F.length("error")).cast("long").alias("n_error"))


@query("source_catalog", "SELECT r_regionkey, r_name || '|cve' AS providers, r_name AS unknown FROM region")
def _(spark, d):
    names = F.array(F.concat(F.lit(" "), C("r_name")), F.lit("cve "), F.lit(" "), C("r_name"), F.lit("cve"))
    got = table(spark, d, "region").select("r_regionkey", L.source_catalog(names, A.PROVIDERS).alias("s"))
    return got.select("r_regionkey", F.array_join("s.providers", "|").alias("providers"), F.array_join("s.unknown", "|").alias("unknown"))


@query("validate_page", """SELECT DISTINCT CAST(o_orderkey // 50 AS BIGINT) AS page, CASE (o_orderkey // 50) % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'exhausted' ELSE 'no_rows' END AS state FROM orders""")
def _(spark, d):
    p = nvd_payloads(spark, d)
    done = F.concat(F.lit('{"resultsPerPage":0,"startIndex":100,"totalResults":'), F.when(C("page") % 3 == 1, "100").otherwise("5000"), F.lit(',"vulnerabilities":[]}'))
    return P.nvd_page_status(p.select("page", F.when(C("page") % 3 == 0, C("body")).otherwise(done).alias("body")))
