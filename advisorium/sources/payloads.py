"""Listing payloads of publishers -> entry rows.  Each function takes landed rows (page, body) and keeps to code generation."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, cve_canonical

NVD_PAGE = """struct<resultsPerPage:int,startIndex:int,totalResults:int,vulnerabilities:array<struct<cve:struct<id:string,published:string,lastModified:string,
    vulnStatus:string,descriptions:array<struct<lang:string,value:string>>>>>>"""
GHSA = "struct<ghsa_id:string,cve_id:string,summary:string,severity:string,published_at:string,updated_at:string,html_url:string>"
MSRC_INDEX = "struct<value:array<struct<ID:string,Alias:string,DocumentTitle:string,InitialReleaseDate:string,CurrentReleaseDate:string,CvrfUrl:string>>>"
DELTA_ENTRY = "struct<cveId:string,cveOrgLink:string,githubLink:string,dateUpdated:string>"
DELTA = f"array<struct<fetchTime:string,new:array<{DELTA_ENTRY}>,updated:array<{DELTA_ENTRY}>,deleted:array<{DELTA_ENTRY}>>>"
QIANXIN = "struct<status:int,message:string,data:struct<total:int,data:array<struct<id:long,title:string,level:string,update_time:string,vuln_ids:string>>>>"
HUAWEI = "struct<status:string,data:array<struct<sasnNo:string,title:string,type:string,publishDate:string,vul:array<struct<cveId:string>>>>,page:struct<totalPages:int,total:int>>"
RSS = """struct<channel:struct<title:string,link:string,item:array<struct<title:string,link:string,guid:string,description:string,pubDate:string,`dc:creator`:string>>>>"""
MAX_FEED_ITEMS = 50


def first_in_page(rows: DataFrame, *keys: str) -> DataFrame:
    """The first occurrence of a key by position."""
    order = Window.partitionBy(*keys).orderBy("pos")
    return rows.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def total_pages(total: Column, size: Column) -> Column:
    return F.when(size > 0, F.ceil(total / size)).cast("long")


def nvd_entries(landed: DataFrame) -> DataFrame:
    """page, pos, code, published, modified, status, total_pages: blank and repeated identifiers of a page dropped."""
    p = landed.select("page", F.from_json("body", NVD_PAGE).alias("p"))
    rows = p.select("page", total_pages(F.col("p.totalResults"), F.col("p.resultsPerPage")).alias("total_pages"), F.posexplode("p.vulnerabilities").alias("pos", "v"))
    rows = rows.select("page", "pos", "total_pages", blank_to_null(F.upper("v.cve.id")).alias("code"), F.col("v.cve.published").alias("published"), F.col("v.cve.lastModified").alias("modified"), F.col("v.cve.vulnStatus").alias("status"))
    return first_in_page(rows.where("code is not null"), "page", "code")


def nvd_page_status(landed: DataFrame) -> DataFrame:
    """page, state: 'ok', 'exhausted' (an empty page whose numbers prove it) or 'no_rows'."""
    p = landed.select("page", F.from_json("body", NVD_PAGE).alias("p")).select("page", "p.*")
    n = F.coalesce(F.size(F.filter("vulnerabilities", lambda v: blank_to_null(v.cve.id).isNotNull())), F.lit(0))
    proven = F.coalesce((F.col("startIndex") >= F.col("totalResults")) & (F.col("resultsPerPage") >= 0) & (F.size("vulnerabilities") == 0), F.lit(False))
    return p.select("page", F.when(n > 0, "ok").when(proven, "exhausted").otherwise("no_rows").alias("state"))


def ghsa_entries(landed: DataFrame) -> DataFrame:
    """An array, an object that holds one under a usual name, or a single advisory; the code must begin with GHSA-."""
    names = ("advisories", "items", "data", "results")
    wrapped = F.from_json("body", "struct<" + ",".join(f"{n}:array<{GHSA}>" for n in names) + ">")
    single = F.from_json("body", GHSA)
    listed = F.when(F.ltrim("body").startswith("["), F.from_json("body", f"array<{GHSA}>"))
    rows = F.coalesce(listed, *[wrapped[n] for n in names], F.when(single.ghsa_id.isNotNull(), F.array(single)))
    return landed.select("page", F.posexplode(rows).alias("pos", "a")).select("page", "pos", F.upper("a.ghsa_id").alias("code"), "a.cve_id", "a.summary", "a.severity", "a.published_at").where("code like 'GHSA-%'")


def msrc_entries(landed: DataFrame) -> DataFrame:
    rows = landed.select("page", F.posexplode(F.from_json("body", MSRC_INDEX).value).alias("pos", "v"))
    code = F.coalesce(blank_to_null(F.col("v.ID")), blank_to_null(F.col("v.Alias")))
    return rows.select("page", "pos", code.alias("code"), F.coalesce(blank_to_null(F.col("v.DocumentTitle")), code).alias("title"), F.col("v.InitialReleaseDate").alias("published")).where("code is not null")


def delta_entries(landed: DataFrame, after: Column) -> DataFrame:
    """fetch_time, action, pos, cve, link, changed, reject: batches later than ``after`` as one change log."""
    b = landed.select(F.explode(F.from_json("body", DELTA)).alias("b")).select(F.col("b.fetchTime").cast("timestamp_ntz").alias("fetch_time"), "b.*").where(F.col("fetch_time") > after)
    lists = F.array(*[F.struct(F.lit(a).alias("action"), F.coalesce(F.col(a), F.array().cast(f"array<{DELTA_ENTRY}>")).alias("entries")) for a in ("new", "updated", "deleted")])
    rows = b.select("fetch_time", F.explode(lists).alias("g")).select("fetch_time", "g.action", F.posexplode("g.entries").alias("pos", "e"))
    cve, link = cve_canonical(F.col("e.cveId")), F.coalesce(blank_to_null(F.col("e.githubLink")), blank_to_null(F.col("e.cveOrgLink")))
    reject = F.when(cve.isNull(), "bad_id").when((F.col("action") != "deleted") & link.isNull(), "no_link")
    return rows.select("fetch_time", "action", "pos", cve.alias("cve"), link.alias("link"), F.col("e.dateUpdated").cast("timestamp_ntz").alias("changed"), reject.alias("reject"))


def qianxin_entries(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries, rejects): a status other than 200, or an item without id or title, is a reject."""
    p = landed.select("page", F.from_json("body", QIANXIN).alias("p"))
    bad = p.where("p.status is null or p.status <> 200").select("page", F.lit(None).cast("int").alias("pos"), F.concat(F.lit("status "), F.coalesce(F.col("p.status").cast("string"), F.lit("unreadable"))).alias("reason"))
    rows = p.where("p.status = 200").select("page", F.posexplode("p.data.data").alias("pos", "v")).select("page", "pos", "v.*")
    fine = F.col("id").isNotNull() & blank_to_null(F.col("title")).isNotNull()
    return rows.where(fine), bad.unionByName(rows.where(~fine).select("page", "pos", F.lit("no id or title").alias("reason")))


def huawei_entries(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    p = landed.select("page", F.from_json("body", HUAWEI).alias("p"))
    bad = p.where("p.status is null or p.status <> '200'").select("page", F.concat(F.lit("status "), F.coalesce("p.status", F.lit("unreadable"))).alias("reason"))
    rows = p.where("p.status = '200'").select("page", F.posexplode("p.data").alias("pos", "v"))
    cves = F.array_distinct(F.array_compact(F.transform("v.vul", lambda x: cve_canonical(x.cveId))))
    return rows.select("page", "pos", blank_to_null(F.col("v.sasnNo")).alias("code"), F.col("v.title").alias("title"), F.col("v.publishDate").alias("published"), cves.alias("cves")).where("code is not null"), bad


def rss_entries(landed: DataFrame, cap: int | None = None) -> DataFrame:
    """page, pos, title, link, guid, published, creator, description of the items with a link; ``cap`` is the feed's own limit of items."""
    items = landed.select("page", F.posexplode(F.from_xml("body", RSS, {"rowTag": "rss"}).channel.item).alias("pos", "i"))
    rows = items.select("page", "pos", blank_to_null(F.col("i.title")).alias("title"), blank_to_null(F.col("i.link")).alias("link"), F.col("i.guid").alias("guid"), F.col("i.pubDate").alias("published"), F.col("i.`dc:creator`").alias("creator"), F.col("i.description").alias("description"))
    return (rows if cap is None else rows.where(F.col("pos") < cap)).where(F.col("link").rlike("^https?://"))


def rss_state(landed: DataFrame) -> DataFrame:
    """page, state: 'no_channel', 'exhausted' (no item), 'no_links' (items, none of them with a link) or 'ok'."""
    x = landed.select("page", F.from_xml("body", RSS, {"rowTag": "rss"}).channel.alias("c"))
    n, good = F.coalesce(F.size("c.item"), F.lit(0)), F.coalesce(F.size(F.filter("c.item", lambda i: i.link.rlike(r"^\s*https?://"))), F.lit(0))
    return x.select("page", F.when(F.col("c").isNull(), "no_channel").when(n <= 0, "exhausted").when(good <= 0, "no_links").otherwise("ok").alias("state"))


def cpe_rows(lines: DataFrame, with_cpe: Column) -> DataFrame:
    """Lines of two CSV layouts (cpe,vendor,product,title or vendor,product) -> vendor, product, cpe, title."""
    full = F.from_csv("line", F.lit("cpe string, vendor string, product string, title string"))
    short = F.from_csv("line", F.lit("vendor string, product string"))
    pick = lambda name: F.when(with_cpe, full[name]).otherwise(short[name])
    return lines.select(pick("vendor").alias("vendor"), pick("product").alias("product"), F.when(with_cpe, full.cpe).alias("cpe"), F.when(with_cpe, full.title).alias("title"))


_MEMBER = re.compile(r"(?:^|/)CVE-(\d{4})-(\d{4,})\.json$", re.I)


def zip_manifest(files: DataFrame, depth: int = 2) -> DataFrame:
    """Archives (content) -> code, year, number of members named CVE-YYYY-N.json, in up to ``depth`` levels of nested archives."""

    def members(blob: bytes, left: int) -> Iterator[tuple[int, int]]:
        with zipfile.ZipFile(io.BytesIO(blob)) as z:
            for name in z.namelist():
                if m := _MEMBER.search(name):
                    yield int(m[1]), int(m[2])
                elif left and name.lower().endswith(".zip"):
                    yield from members(z.read(name), left - 1)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([x for blob in pdf["content"] for x in members(bytes(blob), depth)], columns=["year", "number"])

    found = files.select("content").mapInPandas(read, "year long, number long").distinct()
    return found.select(F.concat(F.col("year").cast("string"), F.lit("-"), F.when(F.col("number") < 1000, F.lpad(F.col("number").cast("string"), 4, "0")).otherwise(F.col("number").cast("string"))).alias("code"), "year", "number")


def manifest_pages(manifest: DataFrame, size: int = 100) -> DataFrame:
    """Newest first, in pages of ``size``.

    Ranks come from counts per year and a rank within the year, so one window never sees more than a year.
    """
    years = manifest.groupBy("year").agg(F.count("*").alias("n"))
    later = years.alias("a").join(years.alias("b"), F.col("b.year") > F.col("a.year"), "left").groupBy(F.col("a.year").alias("year")).agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"), F.lit(1).alias("one"))
    total = years.agg(F.sum("n").alias("total"))
    ranked = manifest.withColumn("rn", F.row_number().over(Window.partitionBy("year").orderBy(F.desc("number"))))
    at = F.col("rn") + F.col("before")
    return ranked.join(F.broadcast(later), "year").crossJoin(F.broadcast(total)).select("code", "year", "number", (F.floor((at - 1) / size) + 1).alias("page"), F.ceil(F.col("total") / size).alias("pages"))
