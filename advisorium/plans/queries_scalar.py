"""Queries over identifier, text, severity and time functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import severity as S
from ..functions import text as X
from ..functions import times as D
from . import adapters as A
from .registry import query, table

C = F.col


def _joined(c):
    return F.array_join(c, "|")


# --- identifiers and text -------------------------------------------------------------------------


@query("cve_normalize", f"WITH {A.ADV} SELECT k, CASE WHEN k % 7 = 0 THEN NULL ELSE number END AS cve FROM adv")
def _(spark, d):
    raw = F.when(C("k") % 7 == 0, F.concat(C("cve_raw"), F.lit("x"))).otherwise(C("cve_raw"))
    return A.adv(spark, d).select("k", X.cve_normalize(raw).alias("cve"))


@query("cve_canonical", f"WITH {A.ADV} SELECT k, 'CVE-' || number AS cve FROM adv")
def _(spark, d):
    return A.adv(spark, d).select("k", X.cve_canonical(C("cve_raw")).alias("cve"))


@query("cve_extract", f"""WITH {A.ADV_TEXT} SELECT doc_id,
    array_to_string(list_slice(['CVE-2024-' || (doc_id + 1000), 'CVE-2023-' || (doc_id + 2000), 'CVE-2022-' || (doc_id + 100000000)], 1, CASE WHEN doc_id % 5 > 1 THEN doc_id % 5 - 1 ELSE doc_id % 5 END), '|') AS any_ids,
    array_to_string(list_slice(['CVE-2024-' || (doc_id + 1000), 'CVE-2023-' || (doc_id + 2000)], 1, CASE WHEN doc_id % 5 > 1 THEN doc_id % 5 - 1 ELSE doc_id % 5 END), '|') AS bounded_ids,
    array_to_string(list_slice(['CVE-2024-' || (doc_id + 1000), 'CVE-2023-' || (doc_id + 2000), 'CVE-2022-' || substr(CAST(doc_id + 100000000 AS VARCHAR), 1, 8)], 1, CASE WHEN doc_id % 5 > 1 THEN doc_id % 5 - 1 ELSE doc_id % 5 END), '|') AS short_ids
    FROM adv_text""")
def _(spark, d):
    t = C("text")
    return A.adv_text(spark, d).select(
        "doc_id", _joined(X.cve_extract(t)).alias("any_ids"), _joined(X.cve_extract(t, X.CVE_BOUNDED)).alias("bounded_ids"), _joined(X.cve_extract(t, X.CVE_SHORT)).alias("short_ids")
    )


@query("cve_collect", f"""WITH {A.ADV} SELECT k, CASE WHEN k % 3 = 0 THEN 'CVE-1999-' || (k + 10000) || '|CVE-' || number ELSE 'CVE-' || number END AS ids,
    CASE WHEN k % 3 = 0 THEN 'CVE-1999-' || (k + 10000) ELSE 'CVE-' || number END AS first_id FROM adv""")
def _(spark, d):
    own = F.when(C("k") % 3 == 0, F.concat(F.lit("1999-"), (C("k") + 10000).cast("string"))).otherwise("n/a")
    ids = X.collect_cves(F.concat(F.array(own, C("cve_raw")), F.array(F.upper("cve_raw"), F.lit(None))))
    return A.adv(spark, d).select("k", _joined(ids).alias("ids"), F.get(ids, F.lit(0)).alias("first_id"))


@query("vuln_id_parse", """SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN 'CUSTOMER' END AS kind, CASE WHEN c_custkey % 5 > 0 THEN substr(c_name, 10) END AS code,
    CASE WHEN c_custkey % 5 > 0 THEN 'CUSTOMER:' || substr(c_name, 10) END AS key, CASE WHEN c_custkey % 5 > 0 THEN 'CUSTOMER-' || substr(c_name, 10) END AS display FROM customer""")
def _(spark, d):
    raw = F.when(C("c_custkey") % 5 == 0, "customer-").otherwise(F.replace("c_name", F.lit("#"), F.lit("-")))
    p = X.vuln_id_parse(raw)
    return table(spark, d, "customer").select("c_custkey", p["type"].alias("kind"), p["code"].alias("code"), p["key"].alias("key"), p["display"].alias("display"))


@query("identity_key", "SELECT c_custkey, lower(c_mktsegment) || ':' || c_custkey AS key, 'legacy:' || c_mktsegment || ':' || c_custkey AS canonical FROM customer")
def _(spark, d):
    code = C("c_custkey").cast("string")
    return table(spark, d, "customer").select(
        "c_custkey", X.identity_key(C("c_mktsegment"), code).alias("key"), X.canonical_id(F.concat(F.lit("LEGACY:"), C("c_mktsegment"), F.lit(":"), code)).alias("canonical")
    )


@query("text_clean", r"""SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS one_line, length(regexp_replace(text, '\s+', '', 'g')) AS n_compact,
    array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS lines FROM documents""")
def _(spark, d):
    t = F.concat(F.lit(" "), C("text"), F.lit(" ﻿\n\n "))
    return table(spark, d, "documents").select(
        "doc_id", X.text_clean(t).alias("one_line"), F.length(X.text_compact(t)).cast("long").alias("n_compact"), X.text_clean_lines(t).alias("lines")
    )


@query("key_slug", "SELECT p_partkey, replace(p_name, ' ', '_') || '_' || lower(replace(p_brand, '#', '_')) AS slug FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", X.key_slug(F.concat(F.lit(" ("), C("p_name"), F.lit(") "), C("p_brand"), F.lit("!"))).alias("slug"))


@query("html_strip", r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'),
    '\s+', ' ', 'g')) AS body FROM pages""")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", X.html_strip(C("html")).alias("body"))


@query("url_extract", "SELECT page_id, url || '|https://b.example.org/x' AS urls, 'https://a.example.org|' || url || '|https://b.example.org/x' AS with_anchor FROM pages")
def _(spark, d):
    t = F.concat(F.lit("see "), C("url"), F.lit("), and https://b.example.org/x。 or "), C("url"), F.lit("."))
    return table(spark, d, "pages").select(
        "page_id", _joined(X.url_extract(t)).alias("urls"), _joined(X.url_extract(t, F.array(F.lit("https://a.example.org"), C("url")))).alias("with_anchor")
    )


@query("url_canonical", r"""SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') AS canonical,
    'https://base.example.org/' || regexp_replace(regexp_replace(regexp_replace(url, '^https?://[^/]+/', ''), '[?#].*$', ''), '/+$', '') AS resolved,
    CASE WHEN regexp_extract(url, '^https?://([^/]+)', 1) = 'thther.example.org' THEN regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') END AS allowed FROM pages""")
def _(spark, d):
    relative = F.regexp_replace("url", "^https?://[^/]+", "")
    return table(spark, d, "pages").select(
        "page_id", X.url_canonical(C("url"), "https://base.example.org").alias("canonical"), X.url_canonical(relative, "https://base.example.org/").alias("resolved"),
        X.url_canonical(C("url"), "https://base.example.org", ["thther.example.org"]).alias("allowed"),
    )


_REFERENCES = [
    ("/a/{k}", "https://h.example.org/a/{k}"), ("//cdn.example.org/{k}", "https://cdn.example.org/{k}"), ("../{k}/x", "https://h.example.org/p/{k}/x"), ("./{k}?q=..", "https://h.example.org/p/q/{k}?q=.."), ("../../../{k}", "https://h.example.org/{k}"),
    ("?page={k}", "https://h.example.org/p/q/r?page={k}"), ("#f{k}", "https://h.example.org/p/q/r#f{k}"), ("http://o.example.org/{k}/../", "http://o.example.org/{k}/../"), ("{k}/y/..", "https://h.example.org/p/q/{k}/"), ("mailto:{k}@x", "mailto:{k}@x"),
]


@query("url_resolve", "SELECT page_id, CASE page_id % 10 " + " ".join(f"WHEN {n} THEN '{x.replace('{k}', chr(39) + ' || page_id || ' + chr(39))}'" for n, (_, x) in enumerate(_REFERENCES)) + " END AS address, page_id % 10 IN (2, 3, 8) AS below FROM pages")
def _(spark, d):
    k = C("page_id")
    own = F.element_at(F.array(*[F.replace(F.lit(r), F.lit("{k}"), k.cast("string")) for r, _ in _REFERENCES]), (k % 10 + 1).cast("int"))
    rows = table(spark, d, "pages").select("page_id", own.alias("r"))
    base = "https://h.example.org/p/q/r"
    return rows.select("page_id", X.url_resolve(C("r"), base).alias("address"), X.url_canonical(F.when(~C("r").rlike("^[?#]"), C("r")), base, ["h.example.org"], ["/p/"]).isNotNull().alias("below"))


@query("url_param", r"SELECT page_id, TRY_CAST(nullif(regexp_extract(url, '[?&]page=(\d+)', 1), '') AS BIGINT) AS page, page_id + 7 AS last_page FROM pages")
def _(spark, d):
    links = F.array(F.concat(F.lit("/l?Page="), C("page_id").cast("string")), F.concat(F.lit("/l?a=1&PAGE="), (C("page_id") + 7).cast("string"), F.lit("#x")), F.lit("/l?page=z"))
    return table(spark, d, "pages").select("page_id", X.url_param(C("url"), "page").alias("page"), F.array_max(F.transform(links, lambda u: X.url_param(u, "page"))).alias("last_page"))


@query("title_split", """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'SVD-2024-' || p_partkey WHEN 1 THEN 'A26-01-0' || (p_partkey % 10) WHEN 2 THEN NULL ELSE 'CVE-2024-' || (p_partkey + 1000) END AS code,
    CASE WHEN p_partkey % 4 = 1 THEN 'Alert' END AS kind, CASE WHEN p_partkey % 4 = 2 THEN p_type END AS status, p_name AS rest FROM part""")
def _(spark, d):
    k, n = C("p_partkey"), C("p_name")
    title = (
        F.when(k % 4 == 0, F.concat(F.lit("SVD-2024-"), k.cast("string"), F.lit(": "), n)).when(k % 4 == 1, F.concat(F.lit("Alert (A26-01-0"), (k % 10).cast("string"), F.lit("): "), n))
        .when(k % 4 == 2, F.concat(F.lit("【"), C("p_type"), F.lit("】"), n)).otherwise(F.concat(F.lit("CVE-2024-"), (k + 1000).cast("string"), F.lit(" "), n))
    )
    return table(spark, d, "part").select("p_partkey", X.title_split(title).alias("s")).select("p_partkey", "s.code", "s.kind", "s.status", "s.rest")


@query("list_split", "SELECT p_partkey, p_name || '|' || p_brand || '|' || p_type || '|x' AS items FROM part")
def _(spark, d):
    t = F.concat(C("p_name"), F.lit(", "), C("p_brand"), F.lit(" and "), C("p_type"), F.lit("; N/A\n\nx；na"))
    return table(spark, d, "part").select("p_partkey", _joined(X.list_split(t)).alias("items"))


@query("cvss_parse", """SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN 0.0 ELSE (p_size % 10) + 0.5 END AS score,
    CASE WHEN p_partkey % 2 = 0 THEN 'CVSS:3.0/AV:N/AC:L' ELSE 'CVSS:3.1/AV:L/AC:H' END AS vector FROM part""")
def _(spark, d):
    k, n = C("p_partkey"), C("p_size") % 10
    shown = F.when(n == 0, "0").otherwise(F.concat(n.cast("string"), F.lit(".5")))
    t = F.concat(F.lit("CVSS score: "), shown, F.when(k % 2 == 0, " (CVSS:3.0/AV:N/AC:L)").otherwise(" https://c.example.org/calc?vector=AV:L/AC:H&v=1"))
    return table(spark, d, "part").select("p_partkey", X.cvss_parse(t).alias("s")).select("p_partkey", "s.score", "s.vector")


@query("cwe_extract", "SELECT p_partkey, 'CWE-' || p_size || CASE WHEN p_size <> p_partkey % 50 THEN '|CWE-' || (p_partkey % 50) ELSE '' END AS cwes FROM part")
def _(spark, d):
    t = F.concat(F.lit("cwe-"), C("p_size").cast("string"), F.lit(" ("), C("p_name"), F.lit("), CWE-"), (C("p_partkey") % 50).cast("string"), F.lit(", CWE-"), C("p_size").cast("string"))
    return table(spark, d, "part").select("p_partkey", _joined(X.cwe_extract(t)).alias("cwes"))


@query("slice_between", "SELECT doc_id, trim(replace(text, chr(10), ' ')) AS found, CAST(NULL AS VARCHAR) AS missing FROM documents")
def _(spark, d):
    t = F.concat(F.lit("Title: x Summary:"), F.replace("text", F.lit("\n"), F.lit(" ")), F.lit("Solution: y References: z"))
    return table(spark, d, "documents").select(
        "doc_id", X.slice_between(t, "Summary:", ["References:", "Solution:", "Absent:"]).alias("found"), X.slice_between(t, "Impact:", ["References:"]).alias("missing")
    )


@query("record_url", """SELECT c_custkey, '2024/' || ((c_custkey + 1000) // 1000) || 'xxx/CVE-2024-' || (c_custkey + 1000) || '.json' AS path,
    CASE c_custkey % 3 WHEN 0 THEN 'https://nvd.nist.gov/vuln/detail/CVE-2024-' || (c_custkey + 1000) WHEN 1 THEN 'https://github.com/advisories/2024-' || (c_custkey + 1000) END AS url FROM customer""")
def _(spark, d):
    code = F.concat(F.lit("2024-"), (C("c_custkey") + 1000).cast("string"))
    provider = F.when(C("c_custkey") % 3 == 0, "nvd").when(C("c_custkey") % 3 == 1, "github_advisory").otherwise("wiz")
    return table(spark, d, "customer").select("c_custkey", X.record_path(code).alias("path"), X.detail_url(provider, code).alias("url"))


@query("uri_redact", "SELECT doc_id, 'db://user' || doc_id || ':***@host/db then ' || text AS shown FROM documents")
def _(spark, d):
    raw = F.concat(F.lit("db://user"), C("doc_id").cast("string"), F.lit(":secret!"), C("lang"), F.lit("@host/db then "), C("text"))
    return table(spark, d, "documents").select("doc_id", X.uri_redact(raw).alias("shown"))


_MARKS = ["_WAF_", 'ID="RenderData"', "id='renderdata'", "sigchl", "Punish-Type", "__jsl_clearance", "jsl_clearance", "X-Via-JSL", "jiasule", "yunaq", "EO-Bot-JS-Token", "EOJSChallengeSDK", "gcaptcha.eo.gtimg.com", "Tencent Cloud EdgeOne"]
_BARE = "replace(replace(lower(html), 'data:image', ''), '<table', '<tab')"
_MARK_LIST = "[" + ", ".join("'" + m.replace("'", "''") + "'" for m in _MARKS) + "]"


@query("page_blocked", f"""WITH p AS (SELECT page_id, {_BARE} || CASE WHEN page_id % 3 > 0 THEN '<p>' || ({_MARK_LIST})[page_id % 14 + 1] || '</p>' ELSE '' END || CASE WHEN page_id % 10 = 0 THEN '<TABLE></TABLE>' ELSE '' END ||
    CASE page_id % 8 WHEN 0 THEN '<img src="DATA:image/png"><input TYPE="text">' WHEN 1 THEN '<img src="DATA:image/png">' ELSE '' END AS h FROM pages), g AS (SELECT page_id, h, contains(lower(h), 'data:image') AND (contains(h, '验证码') OR contains(lower(h), 'type="text"') OR contains(lower(h), 'type=' || chr(39) || 'text' || chr(39))) AS gate FROM p)
    SELECT page_id, gate, NOT gate AND (page_id % 7 = 0 OR (len(list_filter({_MARK_LIST}, lambda m: contains(lower(h), lower(m)))) > 0 AND NOT contains(lower(h), '<table'))) AS blocked FROM g""")
def _(spark, d):
    k, bare = C("page_id"), F.replace(F.replace(F.lower("html"), F.lit("data:image"), F.lit("")), F.lit("<table"), F.lit("<tab"))
    mark = F.element_at(F.array(*[F.lit(m) for m in _MARKS]), (k % 14 + 1).cast("int"))
    gate = F.when(k % 8 == 0, '<img src="DATA:image/png"><input TYPE="text">').when(k % 8 == 1, '<img src="DATA:image/png">').otherwise("")
    html = F.concat(bare, F.when(k % 3 > 0, F.concat(F.lit("<p>"), mark, F.lit("</p>"))).otherwise(""), F.when(k % 10 == 0, "<TABLE></TABLE>").otherwise(""), gate)
    headers = F.when(k % 7 == 0, F.create_map(F.lit("Punish-Type"), F.lit("1"))).otherwise(F.create_map(F.lit("Server"), F.lit("x")))
    return table(spark, d, "pages").select("page_id", X.captcha_gate(html).alias("gate"), X.page_blocked(html, headers).alias("blocked"))


@query("failure_transient", f"WITH {A.FAILURES} SELECT event_id, event_id % 7 IN (0, 2, 3, 4) AS transient FROM failures")
def _(spark, d):
    return A.failures(spark, d).select("event_id", X.failure_transient(C("status_code"), C("error")).alias("transient"))


# --- severity -------------------------------------------------------------------------------------


@query("severity_normalize", f"""WITH {A.ADV} SELECT k, severity, CASE CAST(floor(score) AS INTEGER) WHEN 1 THEN 'Critical' WHEN 2 THEN 'High' WHEN 3 THEN 'Medium' WHEN 4 THEN 'Low' END AS of_number,
    CASE k % 6 WHEN 0 THEN 'Critical' WHEN 1 THEN 'High' WHEN 2 THEN 'Medium' WHEN 4 THEN 'Unknown' WHEN 5 THEN NULL END AS of_words FROM adv""")
def _(spark, d):
    k = C("k")
    words = F.when(k % 6 == 0, "critical (urgent)").when(k % 6 == 1, " 高危 ").when(k % 6 == 2, "Moderately bad").when(k % 6 == 3, "  ").when(k % 6 == 4, "odd").otherwise("7.5 of 10")
    return A.adv(spark, d).select("k", S.severity_normalize(C("severity_raw")).alias("severity"), S.severity_of_number(C("score")).alias("of_number"), S.severity_normalize(words).alias("of_words"))


_LEVEL = "CASE WHEN {0} >= 9 THEN 'Critical' WHEN {0} >= 7 THEN 'High' WHEN {0} >= 4 THEN 'Medium' WHEN {0} > 0 THEN 'Low' END"


@query("severity_from_score", f"SELECT p_partkey, {_LEVEL.format('(p_size % 101 / 5.0)')} AS level, coalesce({_LEVEL.format('(p_size % 3 * 4.5)')}, {_LEVEL.format('(p_partkey % 11)')}) AS first_level FROM part")
def _(spark, d):
    score = F.get(F.split(F.concat((C("p_size") % 101 / 5.0).cast("string"), F.lit("/")), "/"), F.lit(0))
    scores = F.array((C("p_size") % 3 * 4.5).cast("double"), (C("p_partkey") % 11).cast("double"))
    return table(spark, d, "part").select("p_partkey", S.severity_from_score(score).alias("level"), S.severity_from_scores(scores).alias("first_level"))


@query("severity_by_provider", f"""SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN {_LEVEL.format("(CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 11 ELSE c_custkey % 7 END)")}
    WHEN 1 THEN 'High' WHEN 2 THEN 'Low' WHEN 3 THEN 'Medium' ELSE 'Unknown' END AS severity FROM customer""")
def _(spark, d):
    k, n = C("c_custkey"), C("c_nationkey") % 5
    provider = F.when(n == 0, "cve").when(n == 1, "cnvd").when(n == 2, "qianxin").when(n == 3, "splunk").otherwise("nvd")
    none = F.lit(None).cast("string")
    scores = {"v4_0": F.when(k % 2 == 0, (k % 11).cast("double")), "v3_1": (k % 7).cast("double"), "v3_0": F.lit(9.9), "v2_0": F.lit(1.0)}
    texts = {"status": F.when(n == 1, "高"), "severity": F.when(n == 4, "strange").when(n == 3, "moderate"), "level": none, "rating": F.when(n == 2, "低危")}
    return table(spark, d, "customer").select("c_custkey", S.severity_by_provider(provider, scores, texts).alias("severity"))


@query("severity_msrc", f"""WITH g AS (SELECT l_orderkey, count(*) FILTER (WHERE l_linenumber % 3 = 1) AS real, arg_min(l_quantity, (l_linenumber, l_quantity)) AS q FROM lineitem GROUP BY l_orderkey)
    SELECT l_orderkey, CASE WHEN real > 0 THEN 'High' ELSE {_LEVEL.format('(q % 11)')} END AS severity FROM g""")
def _(spark, d):
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity"))).alias("v"))
    texts = F.transform("v", lambda x: F.when(x.l_linenumber % 3 == 1, "Important").when(x.l_linenumber % 3 == 2, "Remote code execution"))
    first = F.array(F.get(C("v"), F.lit(0)).l_quantity % 11)
    return rows.select("l_orderkey", S.severity_first_real(texts, first).alias("severity"))


@query("severity_title_rule", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Critical' ELSE 'Medium' END AS severity FROM documents")
def _(spark, d):
    title = F.concat(F.when(C("doc_id") % 3 == 0, "High Threat Security Alert: ").otherwise("Security Alert: "), F.length("text").cast("string"))
    return table(spark, d, "documents").select("doc_id", S.severity_title_rule(title).alias("severity"))


@query("severity_highest", f"WITH {A.ADV} SELECT cust, (['Critical', 'High', 'Medium', 'Low'])[min(CASE severity WHEN 'High' THEN 2 WHEN 'Medium' THEN 3 WHEN 'Low' THEN 4 END)] AS highest FROM adv GROUP BY cust")
def _(spark, d):
    rated = A.adv(spark, d).select("cust", S.severity_normalize(C("severity_raw")).alias("s"))
    return rated.groupBy("cust").agg(F.min_by("s", S.severity_rank(C("s"))).alias("highest"))


# --- dates and calendar windows -------------------------------------------------------------------


@query("ts_parse", f"WITH {A.ADV} SELECT k, {A.stamp_sql('published_at')} AS parsed FROM adv")
def _(spark, d):
    return A.adv(spark, d).select("k", D.stamp(D.parse_hk(C("published_raw"))).alias("parsed"))


@query("ts_parse_utc", f"WITH {A.ADV} SELECT k, {A.stamp_sql('CASE WHEN k % 11 = 0 THEN NULL WHEN k % 9 = 0 THEN published_at WHEN k % 9 = 1 THEN published_at ELSE published_at + INTERVAL 8 HOUR END')} AS parsed FROM adv")
def _(spark, d):
    return A.adv(spark, d).select("k", D.stamp(D.parse_utc(C("published_raw"))).alias("parsed"))


@query("ts_rfc822", f"""SELECT event_id, {A.stamp_sql("CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) + INTERVAL 7 HOUR ELSE date_trunc('second', ts) - INTERVAL 8 HOUR END")} AS parsed FROM events""")
def _(spark, d):
    shown = F.date_format("ts", "d MMM yyyy HH:mm:ss")
    raw = (
        F.when(C("event_id") % 3 == 0, F.concat(F.lit("Wed, "), shown, F.lit(" GMT"))).when(C("event_id") % 3 == 1, F.concat(F.lit("Thu, "), shown, F.lit(" -0700")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    )
    return table(spark, d, "events").select("event_id", D.stamp(D.parse_rfc822(raw)).alias("parsed"))


@query("date_iso", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""")
def _(spark, d):
    k, t = C("o_orderkey"), C("o_orderdate")
    raw = F.when(k % 4 == 0, F.concat(F.lit("on "), F.date_format(t, "yyyy/M/d"), F.lit(" noon"))).when(k % 4 == 1, F.date_format(t, "MMMM d, yyyy")).when(k % 4 == 2, F.date_format(t, "yyyy-M-d"))
    return table(spark, d, "orders").select("o_orderkey", D.date_iso(raw.otherwise("soon")).alias("day"))


@query("published_at", f"WITH {A.ADV} SELECT k, {A.stamp_sql('coalesce(published_at, updated_at, CASE WHEN k % 2 = 1 THEN observed_at END)')} AS published FROM adv")
def _(spark, d):
    disclosed = F.when(C("k") % 2 == 1, F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return A.adv(spark, d).select("k", D.stamp(D.first_time(C("published_raw"), C("updated_raw"), disclosed)).alias("published"))


@query("updated_at", f"WITH {A.ADV} SELECT k, {A.stamp_sql('coalesce(updated_at, published_at)')} AS updated FROM adv")
def _(spark, d):
    return A.adv(spark, d).select("k", D.stamp(D.first_time(C("updated_raw"), C("published_raw"))).alias("updated"))


_MODIFIED = """coalesce(CASE WHEN provider = 'wiz' AND k % 4 = 1 THEN NULL ELSE greatest(updated_at, CASE WHEN k % 4 = 1 THEN published_at END) END, CASE WHEN provider IN ('cve', 'msrc') THEN observed_at END)"""


def _modified(rows):
    published = D.parse_hk(C("published_raw"))
    edits = [D.parse_hk(C("updated_raw")), F.when(C("k") % 4 == 1, published)]
    return rows.withColumn("pub", published).withColumn("mod", D.modified_time(C("provider"), edits, published, C("observed_at"), F.lit(True)))


@query("modified_at", f"WITH {A.ADV} SELECT k, {A.stamp_sql(_MODIFIED)} AS modified FROM adv")
def _(spark, d):
    return _modified(A.adv(spark, d)).select("k", D.stamp(C("mod")).alias("modified"))


@query("news_time", f"WITH {A.ADV} SELECT k, {A.stamp_sql(f'greatest(published_at, {_MODIFIED})')} AS news FROM adv")
def _(spark, d):
    return _modified(A.adv(spark, d)).select("k", D.stamp(D.news_time(C("pub"), C("mod"))).alias("news"))


_CUT = "(date_trunc('day', {0} + INTERVAL 8 HOUR) - INTERVAL 8 HOUR - INTERVAL {1} DAY)"


@query("window_calendar", f"SELECT event_id, {A.stamp_sql(_CUT.format('ts', 6))} AS cutoff, {A.stamp_sql(_CUT.format('ts', '(-1)'))} AS until FROM events")
def _(spark, d):
    lo, hi = D.window_bounds(C("ts"), 7)
    return table(spark, d, "events").select("event_id", D.stamp(lo).alias("cutoff"), D.stamp(hi).alias("until"))


@query("window_daily_counts", "SELECT strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def _(spark, d):
    w = F.window("ts", "1 day", "1 day", "16 hours")
    return table(spark, d, "events").groupBy(w.alias("w")).agg(F.count("*").alias("n")).select(F.date_format(C("w.start") + D.hours(8), "yyyy-MM-dd").alias("day"), "n")


NOW = "2024-01-20 09:30:00"
_IN = f"coalesce(ts >= {_CUT.format(f'TIMESTAMP {NOW!r}', 6)} AND ts < {_CUT.format(f'TIMESTAMP {NOW!r}', '(-1)')}, false)"


@query("window_filter", f"SELECT event_type, count(*) FILTER (WHERE {_IN}) AS eligible, count(*) FILTER (WHERE NOT {_IN}) AS rejected FROM events GROUP BY 1")
def _(spark, d):
    inside = D.in_window(C("ts"), D.window_bounds(F.lit(NOW).cast("timestamp_ntz"), 7))
    return table(spark, d, "events").groupBy("event_type").agg(F.count_if(inside).alias("eligible"), F.count_if(~inside).alias("rejected"))


@query("listing_outdated", f"""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN false WHEN event_id % 2 = 0 AND event_id % 3 <> 0 THEN false ELSE NOT {_IN} END AS outdated FROM events""")
def _(spark, d):
    bounds = D.window_bounds(F.lit(NOW).cast("timestamp_ntz"), 7)
    e = C("event_id")
    published = F.when(e % 5 != 0, C("ts"))
    modified = F.when((e % 5 != 0) & (e % 3 == 0), C("ts"))
    return table(spark, d, "events").select("event_id", D.listing_outdated(published, modified, e % 2 == 0, bounds).alias("outdated"))


@query("updated_since", "SELECT event_id, CASE WHEN event_id % 4 > 0 THEN ts >= TIMESTAMP '2024-01-15 00:00:00' END AS newer FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", D.updated_since(F.when(C("event_id") % 4 > 0, C("ts")), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).alias("newer"))


@query("range_split", f"""WITH r AS (SELECT o_custkey AS cust, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY 1),
    s AS (SELECT cust, lo + to_days(CAST(120 * i AS INTEGER)) AS since, hi FROM r, range(0, 40) AS t(i))
    SELECT cust, {A.stamp_sql('since')} AS since, {A.stamp_sql('least(since + INTERVAL 120 DAY, hi)')} AS until FROM s WHERE since < hi""")
def _(spark, d):
    r = table(spark, d, "orders").groupBy(C("o_custkey").alias("cust")).agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return r.select("cust", F.explode(D.range_split(C("lo"), C("hi"))).alias("w")).select("cust", D.stamp(C("w.since")).alias("since"), D.stamp(C("w.until")).alias("until"))
