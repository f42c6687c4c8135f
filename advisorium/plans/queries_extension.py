"""Queries over the extension surface."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.html_tables import register_html_cells
from ..sources.payloads import ghsa_entries, rss_entries
from . import adapters as A
from .queries_html import _LONG, region_pages
from .queries_sources import _rss
from .registry import query, table
from .sources_registry import ProviderRules, SourceRegistry

C = F.col


@query("source_registry", """SELECT 'splunk' AS provider, o_orderkey % 60 AS pos, 'https://r.example.org/' || o_orderkey || '?a=1&b=2' AS link FROM orders WHERE o_orderkey % 7 > 0 AND (o_orderkey // 60) % 10 NOT IN (3, 4, 5)""")
def _(spark, d):
    registry = SourceRegistry()
    registry.register("splunk", rss_entries, finalize=lambda rows: rows.select(C("pos").cast("long").alias("pos"), "link"))
    registry.register("github_advisory", ghsa_entries)
    return registry.run("splunk", _rss(spark, d))


@query("provider_rules", f"WITH {A.ADV} SELECT k, 'ID-' || k AS identity, CASE WHEN k % 2 = 0 THEN 'p' || k ELSE 'q' || k END AS published FROM adv")
def _(spark, d):
    k = C("k").cast("string")
    detail = F.to_json(F.struct(F.concat(F.lit("ID-"), k).alias("cve_id"), F.when(C("k") % 2 == 0, F.concat(F.lit("p"), k)).otherwise(" ").alias("published_at"), F.concat(F.lit("q"), k).alias("published_date")))
    rules = ProviderRules.of({"identity": ["cve_id"], "published": ["published_at", "published_date"]})
    return A.adv(spark, d).select("k", rules.value(detail, "identity").alias("identity"), rules.value(detail, "published").alias("published"))


@query("html_cells_udtf", f"WITH {_LONG} SELECT page_id, CAST(row_no AS INTEGER) AS row_no, CAST(col_no AS INTEGER) AS col_no, value FROM long")
def _(spark, d):
    register_html_cells(spark)
    return spark.sql("SELECT p.page_id, c.row_no, c.col_no, c.value FROM {pages} AS p, LATERAL html_cells(p.html) AS c", pages=region_pages(spark, d))
