"""Queries over documents: building, upsert, validation, selection and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.times import parse_hk, stamp
from ..operators import documents as O
from ..operators import matching as W
from ..operators import select as G
from ..operators import validate as M
from ..operators import xref as H
from ..sources.landing import write_snapshot
from . import adapters as A
from .queries_sources import DELTA, delta_payloads
from .registry import query, table

C = F.col


def _with_details(spark, d):
    return A.adv(spark, d).withColumn("details", F.create_map(F.lit("note"), F.concat(F.lit("n"), (C("k") % 7).cast("string"))))


def news(spark, d):
    """Built documents, errors left out."""
    return O.build_document(_with_details(spark, d)).where("error is null")


def _plain(df):
    return df.withColumn("provider", C("source.provider"))


NEWS = A.ADV + """, news AS (SELECT k, provider || ':' || code AS _id, provider, code, CASE WHEN k % 10 = 0 THEN code ELSE 'Advisory ' || k END AS title, nullif(severity, 'Unknown') AS severity, published_at,
    coalesce(updated_at, published_at) AS updated_at, observed_at, CASE WHEN provider <> 'cve' THEN 'CVE-' || number END AS cve, 'CVE-' || number AS any_cve, cust FROM adv)"""


@query("build_document", f"""WITH {NEWS} SELECT news._id, news.title, news.severity, {A.stamp_sql('news.published_at')} AS published_at, {A.stamp_sql('news.updated_at')} AS updated_at, news.cve AS cve_ids,
    CASE WHEN k % 5 = 0 THEN 'new' WHEN k % 5 < 3 THEN 'updated' END AS change_type, CASE WHEN k % 3 > 0 THEN 'https://adv.example.org/' || k END AS url FROM news""")
def _(spark, d):
    return news(spark, d).select("_id", "title", "severity", stamp(C("published_at")).alias("published_at"), stamp(C("updated_at")).alias("updated_at"), F.array_join("cve_ids", "|").alias("cve_ids"), "change_type", C("source.url").alias("url"))


@query("build_document_errors", f"WITH {A.ADV} SELECT CASE WHEN k % 13 = 0 THEN 'unknown_provider' WHEN k % 17 = 0 THEN 'empty_code' ELSE 'no_observation' END AS error, count(*) AS n FROM adv WHERE k % 13 = 0 OR k % 17 = 0 OR k % 19 = 0 GROUP BY 1")
def _(spark, d):
    k = C("k")
    rows = _with_details(spark, d).withColumn("provider", F.when(k % 13 == 0, "nobody").otherwise(C("provider"))).withColumn("code", F.when(k % 17 == 0, " ").otherwise(C("code"))).withColumn("observed_at", F.when(k % 19 > 0, C("observed_at")))
    return O.build_document(rows).where("error is not null").groupBy("error").agg(F.count("*").alias("n"))


@query("convert_existing", f"""WITH {A.ADV} SELECT k, provider, CASE WHEN k % 2 = 0 THEN code ELSE regexp_replace(code, '^[^:]*:', '') END AS code,
    {A.stamp_sql("CASE WHEN k % 2 = 0 OR k % 3 = 0 THEN observed_at WHEN k % 5 = 0 THEN published ELSE TIMESTAMP '1970-01-01' END")} AS observed_at FROM adv""")
def _(spark, d):
    k = C("k")
    rows = A.adv(spark, d).select(
        "k", F.concat(F.upper("provider"), F.lit(":"), C("code")).alias("_id"), F.when(k % 2 == 0, 2).otherwise(1).alias("schema_version"), F.when(k % 2 == 0, C("code")).alias("code"), F.when(k % 4 == 0, C("provider")).otherwise("gone").alias("provider"),
        F.when((k % 2 == 0) | (k % 3 == 0), C("observed_at")).alias("observed_at"), F.when(k % 5 == 0, C("published")).alias("scraped_at"),
    )
    return O.convert_existing(rows).join(rows.select("k", "_id"), "_id").select("k", "provider", "code", stamp(C("observed_at")).alias("observed_at"))


@query("provider_infer", "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'nvd' WHEN 1 THEN 'wiz' WHEN 2 THEN 'cve' END AS provider FROM customer")
def _(spark, d):
    k = C("c_custkey")
    own = F.array(F.when(k % 4 == 0, "NVD"), F.when(k % 4 == 1, "wiz"), F.lit("nobody"), F.when(k % 4 == 2, F.substring_index(F.lit("cve:x"), ":", 1)))
    return table(spark, d, "customer").select("c_custkey", O.provider_infer(own, O.REGISTERED).alias("provider"))


_PAYLOAD = """'{"code":"' || k || '","details":{"aliases":["a' || k || '","b, c",null],"facts":{"empty":null,"k":' || (k % 7) || ',"size":' || (k % 4) || '.5}},"source_provider":"' || provider || '","title":"t' || (k % 9)
    || '","updated_at":{"$date":"' || strftime(edited, '%Y-%m-%d %H:%M:%S.000') || '"}}'"""


def _digest_rows(spark, d, shift=0):
    """Small documents with a list and a map.  In a later version some are changed, dropped or added, and some differ only in what isn't compared: observation, address, order of map entries, kind of number."""
    k = C("k")
    rows = A.adv(spark, d)
    title = F.concat(F.lit("t"), (k % 9).cast("string"))
    if shift:
        rows = rows.where(k % 10 != 2)
        title = F.when(k % 10 == 0, "changed").otherwise(title)
    facts = [(F.lit("k"), (k % 7).cast("double")), (F.lit("size"), (k % 4) + 0.5), (F.lit("empty"), F.lit(None).cast("double"))]
    facts = F.create_map(*[x for pair in (reversed(facts) if shift else facts) for x in pair])
    aliases = F.array(F.concat(F.lit("a"), k.cast("string")), F.lit("b, c"), F.lit(None).cast("string"))
    docs = rows.select(
        F.when((k % 10 == 3) & F.lit(bool(shift)), F.concat(F.lit("new:"), k.cast("string"))).otherwise(F.concat(F.lit("id:"), k.cast("string"))).alias("_id"), k.cast("string").alias("code"), title.alias("title"), C("edited").alias("updated_at"),
        (C("observed_at") + F.make_dt_interval(F.lit(shift))).alias("observed_at"), F.struct(C("provider").alias("provider"), F.lit(f"u{shift}").alias("url")).alias("source"), F.struct(facts.alias("facts"), aliases.alias("aliases")).alias("details"), k.alias("k"),
    )
    compared = docs.drop("k").schema
    return docs.withColumn("digest", O.content_digest(compared)).withColumn("payload", O.content_payload(compared)).withColumn("provider", C("source.provider"))


@query("content_payload", f"WITH {A.ADV} SELECT k, {_PAYLOAD} AS payload FROM adv")
def _(spark, d):
    return _digest_rows(spark, d).select("k", "payload")


@query("content_digest", f"WITH {A.ADV} SELECT k, sha256({_PAYLOAD}) AS digest FROM adv")
def _(spark, d):
    return _digest_rows(spark, d).select("k", "digest")


@query("documents_match", f"WITH {A.ADV} SELECT k, k % 10 <> 0 AS same FROM adv WHERE k % 10 NOT IN (2, 3)")
def _(spark, d):
    a, b = _digest_rows(spark, d), _digest_rows(spark, d, 1)
    return a.select("_id", "k", C("digest").alias("x")).join(b.select("_id", C("digest").alias("y")), "_id").select("k", C("x").eqNullSafe(C("y")).alias("same"))


#: k % 12 -> what the later version of a document does to the text t, the list of two names and the map of two notes, and whether it is still the same.
_EDITS = ["nothing", "entries in another order", "names in another order", "two names as one with a comma", "a name that is null", "the word null as a name", "a null title", "a separator in the title", "a quote moved between names", "half a millisecond", "a millisecond", "a note gone null"]
_SAME = "k % 12 IN (0, 1, 9)"


def _edited(spark, d, later):
    """Documents whose later version differs only by what a comparison of printed values gets wrong."""
    k, e = C("k"), C("k") % 12
    edit = lambda n, new, old: F.when(F.lit(later) & (e == n), new).otherwise(old)
    one, two, void = F.concat(F.lit("x"), k.cast("string")), F.lit("y"), F.lit(None).cast("string")
    names = F.array(one, two)
    for n, other in ((2, F.array(two, one)), (3, F.array(F.concat(one, F.lit(", "), two))), (4, F.array(one, void)), (5, F.array(one, F.lit("null"))), (8, F.array(F.concat(one, F.lit('","y')), F.lit("")))):
        names = edit(n, other, names)
    notes = F.create_map(F.lit("a"), one, F.lit("b"), two)
    notes = edit(1, F.create_map(F.lit("b"), two, F.lit("a"), one), edit(11, F.create_map(F.lit("a"), one, F.lit("b"), void), notes))
    title = edit(6, void, edit(7, F.lit('~|names=["x"]'), F.lit("~")))
    at = C("edited") + F.expr("INTERVAL '0.1235' SECOND")
    at = edit(9, at + F.expr("INTERVAL '0.0004' SECOND"), edit(10, at + F.expr("INTERVAL '0.001' SECOND"), at))
    source = F.struct(C("provider").alias("provider"), F.lit(str(later)).alias("url"))
    return A.adv(spark, d).select(k.cast("string").alias("_id"), title.alias("title"), names.alias("names"), notes.alias("notes"), at.alias("updated_at"), source.alias("source"))


@query("documents_match_nested", f"WITH {A.ADV} SELECT CAST(k AS VARCHAR) AS _id, {_SAME} AS same FROM adv")
def _(spark, d):
    return O.documents_match(_edited(spark, d, False), _edited(spark, d, True))


@query("upsert_nested", f"WITH {A.ADV} SELECT CASE WHEN {_SAME} THEN 'unchanged' ELSE 'overwrite' END AS action, count(*) AS n FROM adv GROUP BY 1")
def _(spark, d):
    shown = lambda rows: rows.withColumn("digest", O.content_digest(rows.schema)).withColumn("provider", C("source.provider")).withColumn("observed_at", C("updated_at")).withColumn("pos", F.lit(1))
    return O.upsert_classify(shown(_edited(spark, d, False)), shown(_edited(spark, d, True))).groupBy("action").agg(F.count("*").alias("n"))


@query("json_content_payload", f"""WITH {A.ADV} SELECT k, '{{"a":{{"c":' || CASE WHEN k % 5 = 0 THEN '"null"' ELSE 'null' END || ',"z":[1,"x, y"]}},"b":' || k || CASE WHEN k % 4 = 0 THEN ',"n":null' ELSE '' END || ',"source_provider":"nvd"}}' AS payload FROM adv""")
def _(spark, d):
    k = C("k")
    doc = F.concat(
        F.lit('{"b":'), k.cast("string"), F.when(k % 3 == 0, ".0").otherwise(""), F.lit(',"a":{"z":[1,"x, y"],"c":'), F.when(k % 5 == 0, '"null"').otherwise("null"), F.lit('},"source":{"provider":"nvd","url":"u"},"observed_at":"x"'),
        F.when(k % 4 == 0, ',"n":null').otherwise(""), F.lit("}"),
    )
    return A.adv(spark, d).select("k", O.json_content_payload(doc).alias("payload"))


def _classified(spark, d, mode="overwrite"):
    stored = _digest_rows(spark, d).withColumn("classification", F.concat(F.lit("c"), C("code")))
    batch = _digest_rows(spark, d, 1).withColumn("pos", C("k"))
    again = batch.where("k % 10 = 4").withColumn("pos", C("k") - 1).withColumn("title", F.lit("older"))
    stale = batch.where("k % 10 = 5").withColumn("observed_at", C("observed_at") - F.make_dt_interval(F.lit(9))).withColumn("digest", F.lit("x"))
    batch = batch.where("k % 10 <> 5").unionByName(again).unionByName(stale)
    batch = batch.withColumn("provider", F.when(C("k") % 10 == 6, "other").otherwise(C("provider")))
    return stored, O.upsert_classify(stored, batch, mode)


_ACTION = "CASE k % 10 WHEN 0 THEN {m} WHEN 3 THEN 'insert' WHEN 5 THEN 'stale' WHEN 6 THEN 'overwrite' ELSE 'unchanged' END"


@query("upsert_classify", f"""WITH {A.ADV}, r AS (SELECT k, {_ACTION.format(m="'overwrite'")} AS action FROM adv WHERE k % 10 <> 2 UNION ALL SELECT k, 'superseded' FROM adv WHERE k % 10 = 4) SELECT k, action FROM r""")
def _(spark, d):
    return _classified(spark, d)[1].select("k", "action")


@query("upsert_skip_mode", f"""WITH {A.ADV} SELECT {_ACTION.format(m="'skip'")} AS action, count(*) AS n FROM adv WHERE k % 10 <> 2 GROUP BY 1""")
def _(spark, d):
    return _classified(spark, d, "skip")[1].where("action <> 'superseded'").groupBy("action").agg(F.count("*").alias("n"))


@query("upsert_apply", f"""WITH {A.ADV} SELECT CASE WHEN g.i = 1 THEN 'new:' ELSE 'id:' END || k AS _id, CASE WHEN k % 10 = 0 THEN 'changed' ELSE 't' || (k % 9) END AS title, CASE WHEN g.i = 0 THEN 'c' || k END AS classification
    FROM adv, (VALUES (0), (1)) AS g(i) WHERE g.i = 0 OR k % 10 = 3""")
def _(spark, d):
    stored, classified = _classified(spark, d)
    cols = ["_id", "code", "title", "digest", "classification"]
    return O.upsert_apply(stored.select(*cols), classified, ["classification"]).select("_id", "title", "classification")


@query("sink_upsert", f"WITH {A.ADV} SELECT count(*) + count(*) FILTER (WHERE k % 10 = 3) AS n, count(*) FILTER (WHERE k % 10 = 0) AS n_changed FROM adv")
def _(spark, d):
    stored, classified = _classified(spark, d)
    new = write_snapshot(O.upsert_apply(stored.select("_id", "title"), classified, []), "news")
    return new.agg(F.count("*").alias("n"), F.count_if(C("title") == "changed").alias("n_changed"))


@query("upsert_stats", f"""WITH {A.ADV} SELECT count(*) FILTER (WHERE k % 10 = 3) AS inserted, count(*) FILTER (WHERE k % 10 IN (0, 6)) AS overwritten, CAST(0 AS BIGINT) AS deleted, count(*) FILTER (WHERE k % 10 = 5) AS skipped,
    count(*) FILTER (WHERE k % 10 IN (0, 6)) AS conflicts, count(*) FILTER (WHERE k % 10 IN (1, 4, 7, 8, 9)) AS unchanged, count(*) FILTER (WHERE k % 10 = 4) AS superseded FROM adv""")
def _(spark, d):
    return O.upsert_stats(_classified(spark, d)[1])


@query("latest_wins", f"WITH {A.OBSERVATIONS}, l AS (SELECT identity, max(observed_at) AS m FROM observations WHERE event_id % 2 = 0 GROUP BY 1) SELECT o.event_id, coalesce(l.m > o.observed_at, false) AS stale FROM observations o LEFT JOIN l USING (identity) WHERE o.event_id % 2 = 1")
def _(spark, d):
    o = A.observations(spark, d)
    stored = o.where("event_id % 2 = 0").groupBy("identity").agg(F.max("observed_at").alias("m"))
    return o.where("event_id % 2 = 1").join(stored, "identity", "left").select("event_id", F.coalesce(C("m") > C("observed_at"), F.lit(False)).alias("stale"))


def _ledger(spark, d):
    k = C("c_custkey")
    c = table(spark, d, "customer")
    sign = lambda changed: F.sha2(F.to_json(F.struct(F.when(changed, "x").otherwise(C("c_name")).alias("title"), C("c_mktsegment").alias("severity"))), 256)
    return c.select(k.alias("identity"), sign(F.lit(False)).alias("signature")), c.where(k % 7 > 0).select(k.alias("identity"), sign(k % 5 == 0).alias("signature"))


@query("entry_signature", "SELECT c_custkey AS identity, sha256('{\"title\":\"' || c_name || '\",\"severity\":\"' || c_mktsegment || '\"}') AS signature FROM customer")
def _(spark, d):
    return _ledger(spark, d)[0]


@query("changed_entries", "SELECT c_custkey AS identity FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 5 = 0")
def _(spark, d):
    listing, ledger = _ledger(spark, d)
    return O.changed_entries(listing, ledger).select("identity")


@query("unchanged_skip", "SELECT c_custkey AS identity, c_custkey % 7 = 0 OR c_custkey % 5 = 0 OR c_custkey % 3 = 0 AS fetch FROM customer")
def _(spark, d):
    listing, ledger = _ledger(spark, d)
    return O.unchanged_skip(listing, ledger, listing.where("identity % 3 > 0")).select("identity", "fetch")


def _snapshots(spark, d):
    t = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((C("doc_id") % 20).cast("int"))
    return O.snapshot_put(table(spark, d, "documents").select(C("text").alias("payload"), t.alias("written_at")))


_SNAP = "s AS (SELECT sha256(text) AS digest, min(TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 20 AS INTEGER))) AS written_at FROM documents GROUP BY 1)"


@query("snapshot_put", f"WITH {_SNAP} SELECT digest, {A.stamp_sql('written_at')} AS written_at FROM s")
def _(spark, d):
    return _snapshots(spark, d).select("digest", stamp(C("written_at")).alias("written_at"))


@query("snapshot_verify", f"WITH {_SNAP} SELECT digest FROM s WHERE substr(digest, 1, 1) <> 'a'")
def _(spark, d):
    broken = _snapshots(spark, d).withColumn("payload", F.when(C("digest").startswith("a"), F.concat("payload", F.lit("!"))).otherwise(C("payload")))
    return O.snapshot_verify(broken).select("digest")


@query("snapshot_prune", f"WITH {_SNAP} SELECT digest FROM s WHERE written_at >= TIMESTAMP '2024-01-09' OR substr(digest, 1, 1) = 'b'")
def _(spark, d):
    s = _snapshots(spark, d)
    return O.snapshot_prune(s, s.where(C("digest").startswith("b")), F.lit("2024-01-16").cast("timestamp_ntz")).select("digest")


def _tables(spark, d):
    """Two tables of customers: the second is later, or equal, or contradicts, or has another provider."""
    k = C("c_custkey")
    base = F.lit("2024-01-01").cast("timestamp_ntz")
    row = lambda n, p, t, g: table(spark, d, "customer").select(F.concat(F.lit("i:"), k.cast("string")).alias("_id"), p.alias("provider"), t.alias("observed_at"), g.alias("digest"))
    first = row(0, F.lit("nvd"), base, F.lit("a"))
    second = row(1, F.when(k % 8 == 0, "wiz").otherwise("nvd"), F.when(k % 4 == 1, base + F.make_dt_interval(F.lit(1))).otherwise(base), F.when(k % 4 == 1, "b").when(k % 8 == 2, "c").otherwise("a"))
    return first.unionByName(second)


@query("unify_tables", "SELECT 'i:' || c_custkey AS _id, CASE WHEN c_custkey % 4 = 1 THEN 'b' ELSE 'a' END AS digest, CAST(2 AS BIGINT) AS n FROM customer WHERE c_custkey % 8 NOT IN (0, 2)")
def _(spark, d):
    return O.unify(_tables(spark, d))[0].select("_id", "digest", "n")


@query("unify_failures", "SELECT 'i:' || c_custkey AS _id, CASE WHEN c_custkey % 8 = 0 THEN 'provider' ELSE 'tie' END AS reason FROM customer WHERE c_custkey % 8 IN (0, 2)")
def _(spark, d):
    return O.unify(_tables(spark, d))[1].select("_id", "reason")


@query("unify_report", "SELECT CAST(2 * count(*) AS BIGINT) AS scanned, count(*) FILTER (WHERE c_custkey % 8 NOT IN (0, 2)) AS inserted, count(*) FILTER (WHERE c_custkey % 8 NOT IN (0, 2)) AS duplicates, count(*) FILTER (WHERE c_custkey % 8 IN (0, 2)) AS failed FROM customer")
def _(spark, d):
    rows = _tables(spark, d)
    good, bad = O.unify(rows)
    one = good.agg(F.count("*").alias("inserted"), F.coalesce(F.sum(C("n") - 1), F.lit(0)).alias("duplicates"))
    return rows.agg(F.count("*").alias("scanned")).crossJoin(one).crossJoin(bad.agg(F.count("*").alias("failed")))


@query("parity_check", "SELECT side, n FROM (SELECT 'left_only' AS side, count(*) FILTER (WHERE c_custkey % 5 = 0) AS n FROM customer UNION ALL SELECT 'right_only', count(*) FILTER (WHERE c_custkey % 7 = 0) FROM customer UNION ALL SELECT 'left', count(*) FROM customer UNION ALL SELECT 'right', count(*) FILTER (WHERE c_custkey % 5 > 0) + count(*) FILTER (WHERE c_custkey % 7 = 0) FROM customer)")
def _(spark, d):
    ids = table(spark, d, "customer").select(C("c_custkey").alias("id"))
    return O.parity(ids, ids.where("id % 5 > 0").unionByName(ids.where("id % 7 = 0").select((-C("id") - 1).alias("id"))), "id")


@query("migration_plan", f"WITH {A.ADV} SELECT count(*) AS scanned, count(*) FILTER (WHERE k % 10 IN (0, 3)) AS would_change FROM adv WHERE k % 10 <> 2")
def _(spark, d):
    a, b = _digest_rows(spark, d), _digest_rows(spark, d, 1)
    j = b.select("_id", "digest").join(a.select("_id", C("digest").alias("old")), "_id", "left")
    return j.agg(F.count("*").alias("scanned"), F.count_if(~C("digest").eqNullSafe(C("old"))).alias("would_change"))


@query("field_diff", """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'name' ELSE '' END || CASE WHEN c_custkey % 6 = 0 THEN '|' ELSE '' END || CASE WHEN c_custkey % 2 = 0 THEN 'segment' ELSE '' END AS changed,
    CASE WHEN c_custkey % 5 = 0 THEN 'balance' ELSE '' END AS gone FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 2 = 0 OR c_custkey % 5 = 0""")
def _(spark, d):
    k = C("c_custkey")
    old = table(spark, d, "customer").select(k, C("c_name").alias("name"), C("c_mktsegment").alias("segment"), C("c_acctbal").alias("balance"))
    new = old.select(k, F.when(k % 3 == 0, "x").otherwise(C("name")).alias("name"), F.when(k % 2 == 0, "y").otherwise(C("segment")).alias("segment"), F.when(k % 5 > 0, C("balance")).alias("balance"))
    diff = O.field_diff(old, new, "c_custkey", ["name", "segment", "balance"])
    return diff.select("c_custkey", F.array_join("set", "|").alias("changed"), F.array_join("unset", "|").alias("gone"))


# --- validation -----------------------------------------------------------------------------------


def _broken(spark, d):
    k = C("c_custkey")
    provider = F.when(k % 11 == 0, "nobody").when(k % 2 == 0, "cve").otherwise("nvd")
    cves = F.when(k % 2 == 1, F.when(k % 9 == 0, F.array(F.lit("CVE-2024-0001"), F.lit("CVE-2024-0001"))).when(k % 5 == 0, F.array(F.lit("cve-1"))).otherwise(F.array(F.lit("CVE-2024-0001"))))
    rows = table(spark, d, "customer").select(
        k, provider.alias("provider"), F.concat(F.when(k % 7 == 0, "wiz").otherwise(provider), F.lit(":1")).alias("_id"), F.when(k % 13 == 0, 1).otherwise(2).alias("schema_version"), F.when(k % 17 > 0, F.lit("2024-01-01").cast("timestamp_ntz")).alias("observed_at"),
        F.lit("{}").alias("details"), F.when(k % 6 == 1, "x").alias("classification"), cves.alias("cve_ids"), F.when(k % 19 == 0, "Unknown").otherwise("High").alias("severity"),
        F.when(k % 23 == 0, "").otherwise("c").alias("code"), F.when(k % 29 > 0, "t").alias("title"), F.when(k % 31 == 0, "gone").when(k % 31 == 1, "new").alias("change_type"),
        F.struct(F.when(k % 8 == 0, "who").otherwise("nvd").alias("provider"), F.when(k % 16 == 0, "").otherwise("u").alias("url"), F.lit(None).cast("string").alias("detail_url")).alias("source"),
        F.when(k % 18 == 1, "error").when(k % 18 == 7, "failed").otherwise("queued").alias("classification_status"), F.when(k % 21 == 0, "soon").when(k % 21 == 1, "2024-01-02").alias("published_at"),
    )
    return rows.withColumn("violations", M.violations(C("provider"), {c: C(c) for c in rows.columns}))


_P = "CASE WHEN c_custkey % 11 = 0 THEN 'nobody' WHEN c_custkey % 2 = 0 THEN 'cve' ELSE 'nvd' END"
_RULES = [
    ("provider_unknown", "c_custkey % 11 = 0"), ("provider_mismatch", "c_custkey % 7 = 0"), ("version", "c_custkey % 13 = 0"), ("no_observation", "c_custkey % 17 = 0"), ("classification_off_cve", f"c_custkey % 6 = 1 AND ({_P}) <> 'cve'"),
    ("cve_ids_repeat", "c_custkey % 2 = 1 AND c_custkey % 9 = 0"), ("cve_ids_form", "c_custkey % 2 = 1 AND c_custkey % 9 > 0 AND c_custkey % 5 = 0"), ("severity", "c_custkey % 19 = 0"),
    ("no_code", "c_custkey % 23 = 0"), ("no_title", "c_custkey % 29 = 0"), ("change_type", "c_custkey % 31 = 0"), ("source_provider", "c_custkey % 8 = 0"), ("source_address", "c_custkey % 16 = 0"), ("classification_status", "c_custkey % 18 = 1"), ("published_at_date", "c_custkey % 21 = 0"),
]


@query("validate_rows", "SELECT c_custkey, concat_ws('|', " + ", ".join(f"CASE WHEN {t} THEN '{n}' END" for n, t in _RULES) + ") AS violations FROM customer")
def _(spark, d):
    return _broken(spark, d).select("c_custkey", F.array_join("violations", "|").alias("violations"))


@query("validate_schema", """SELECT c_custkey, concat_ws('|', CASE WHEN c_custkey % 3 = 0 THEN 'old_field' END, CASE WHEN c_custkey % 5 = 0 THEN 'unknown_field' END) AS violations FROM customer""")
def _(spark, d):
    k = C("c_custkey")
    doc = F.to_json(F.struct(F.lit("nvd:1").alias("_id"), F.lit("x").alias("title"), F.when(k % 3 == 0, "y").alias("status"), F.when(k % 5 == 0, "z").alias("extra")))
    fine = {"_id": F.lit("nvd:1"), "schema_version": F.lit(2), "observed_at": F.lit("x"), "details": F.lit("{}"), "classification": F.lit(None).cast("string"), "cve_ids": F.lit(None).cast("array<string>"), "severity": F.lit(None).cast("string")}
    return table(spark, d, "customer").select("c_custkey", F.array_join(M.violations(F.lit("nvd"), fine, F.json_object_keys(doc)), "|").alias("violations"))


@query("validate_summary", "WITH v AS (" + " UNION ALL ".join(f"SELECT {_P} AS provider, '{n}' AS rule FROM customer WHERE {t}" for n, t in _RULES) + ") SELECT provider, rule, count(*) AS n FROM v GROUP BY 1, 2")
def _(spark, d):
    return M.summary(_broken(spark, d))


# --- selection ------------------------------------------------------------------------------------


@query("dedup_page", f"WITH {A.OBSERVATIONS} SELECT page, identity, arg_min(event_id, pos) AS event_id FROM observations GROUP BY 1, 2")
def _(spark, d):
    return G.first_per_key(A.observations(spark, d), ["page", "identity"], ["pos"]).select("page", "identity", "event_id")


def _log(spark, d):
    from ..sources.payloads import delta_entries

    return delta_entries(delta_payloads(spark, d), F.lit("2000-01-01").cast("timestamp_ntz")).where("reject is null")


@query("delta_updated_since", f"WITH {DELTA} SELECT cve, action, {A.stamp_sql('changed')} AS at FROM delta WHERE reject IS NULL AND action <> 'deleted' AND changed >= TIMESTAMP '2024-01-20 12:00:00'")
def _(spark, d):
    return G.delta_updated_since(_log(spark, d), F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")).select("cve", "action", stamp(C("at")).alias("at"))


@query("delta_latest_in_window", f"""WITH {DELTA} SELECT cve, {A.stamp_sql('fetch_time')} AS fetch_time, action, link FROM delta WHERE reject IS NULL AND action <> 'deleted' AND fetch_time BETWEEN TIMESTAMP '2024-01-05 03:00:00' AND TIMESTAMP '2024-01-25 07:00:00'
    QUALIFY row_number() OVER (PARTITION BY cve ORDER BY fetch_time DESC, CASE action WHEN 'new' THEN 0 ELSE 1 END, event_id) = 1""")
def _(spark, d):
    t = lambda x: F.lit(x).cast("timestamp_ntz")
    return G.delta_latest_in_window(_log(spark, d), t("2024-01-05 03:00:00"), t("2024-01-25 07:00:00")).select("cve", stamp(C("fetch_time")).alias("fetch_time"), "action", "link")


@query("delta_coverage", f"WITH {DELTA} SELECT {A.stamp_sql('min(fetch_time)')} AS coverage_start FROM delta")
def _(spark, d):
    return _log(spark, d).agg(stamp(F.min("fetch_time")).alias("coverage_start"))


def _scan(spark, d):
    """Ten feeds of listing rows; what is known depends on the event."""
    return A.observations(spark, d).withColumn("feed", C("page") % 10).withColumn("known", C("event_id") % 97 == 5).withColumn("at", C("observed_at"))


_SCAN = f"{A.OBSERVATIONS}, scan AS (SELECT *, page % 10 AS feed, event_id % 97 = 5 AS known FROM observations)"


@query("known_filter", f"""WITH {_SCAN}, s AS (SELECT *, known AND coalesce(max(CASE WHEN known THEN 0 ELSE 1 END) OVER (PARTITION BY feed ORDER BY page, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS stop FROM scan),
    t AS (SELECT event_id, max(CASE WHEN stop THEN 1 ELSE 0 END) OVER (PARTITION BY feed ORDER BY page, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped FROM s) SELECT event_id FROM t WHERE stopped = 0""")
def _(spark, d):
    return G.stop_after_known(_scan(spark, d), ["feed"], ["page", "pos"], "known").select("event_id")


@query("stop_two_known_pages", f"""WITH {_SCAN}, p AS (SELECT feed, page, page % 3 > 0 AS k FROM scan GROUP BY 1, 2, 3), q AS (SELECT *, k AND coalesce(lag(k) OVER (PARTITION BY feed ORDER BY page), false) AS hit FROM p),
    r AS (SELECT feed, page, coalesce(max(CASE WHEN hit THEN 1 ELSE 0 END) OVER (PARTITION BY feed ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM q) SELECT event_id FROM scan JOIN r USING (feed, page) WHERE before = 0""")
def _(spark, d):
    return G.stop_after_known_pages(_scan(spark, d).withColumn("known", C("page") % 3 > 0), ["feed"], "known").select("event_id")


@query("stop_old_page", f"""WITH {_SCAN}, p AS (SELECT feed, page, bool_and(observed_at < TIMESTAMP '2024-01-12' OR page % 4 = 0) AS o FROM scan GROUP BY 1, 2),
    r AS (SELECT feed, page, coalesce(max(CASE WHEN o THEN 1 ELSE 0 END) OVER (PARTITION BY feed ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p) SELECT event_id FROM scan JOIN r USING (feed, page) WHERE before = 0""")
def _(spark, d):
    old = (C("at") < F.lit("2024-01-12").cast("timestamp_ntz")) | (C("page") % 4 == 0)
    return G.stop_after_old_page(_scan(spark, d), ["feed"], old).select("event_id")


_BACK = "row_number() OVER (ORDER BY event_id DESC)"


@query("stop_timestamp_boundary", f"""WITH {_SCAN}, t AS (SELECT event_id, max(CASE WHEN value < 0.4 THEN 1 ELSE 0 END) OVER (PARTITION BY feed ORDER BY page, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped, value FROM scan)
    SELECT event_id, stopped = 0 AS in_order FROM t WHERE value >= 0.4""")
def _(spark, d):
    s = _scan(spark, d)
    kept = G.stop_at_boundary(s, ["feed"], ["page", "pos"], C("value"), F.lit(0.4)).select("event_id", F.lit(True).alias("_in"))
    return G.stop_at_boundary(s, ["feed"], [], C("value"), F.lit(0.4), ordered=False).join(kept, "event_id", "left").select("event_id", C("_in").isNotNull().alias("in_order"))


@query("stop_unchanged", f"""WITH {_SCAN}, t AS (SELECT event_id, max(CASE WHEN prop % 50 = 7 THEN 1 ELSE 0 END) OVER (PARTITION BY feed ORDER BY page, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped FROM scan) SELECT event_id FROM t WHERE stopped = 0""")
def _(spark, d):
    s = _scan(spark, d).withColumn("digest", F.sha2(C("prop").cast("string"), 256))
    stored = s.where("prop % 50 = 7").select("event_id", C("digest").alias("old"))
    same = s.join(stored, "event_id", "left").withColumn("known", F.coalesce(C("digest") == C("old"), F.lit(False)))
    return G.stop_after_known(same, ["feed"], ["page", "pos"], "known", seen_new_first=False).select("event_id")


@query("latest_observed", f"WITH {NEWS} SELECT _id, {A.stamp_sql('observed_at')} AS observed_at FROM news ORDER BY news.observed_at DESC, _id DESC LIMIT 100")
def _(spark, d):
    return G.newest(news(spark, d), "observed_at", "_id", 100).select("_id", stamp(C("observed_at")).alias("observed_at"))


@query("keyset_page", f"WITH {NEWS} SELECT _id FROM (SELECT _id FROM news WHERE observed_at < TIMESTAMP '1998-06-01' OR (observed_at = TIMESTAMP '1998-06-01' AND _id < 'm') ORDER BY observed_at DESC, _id DESC LIMIT 50)")
def _(spark, d):
    return G.keyset_page(news(spark, d), "observed_at", "_id", (F.lit("1998-06-01").cast("timestamp_ntz"), F.lit("m")), 50).select("_id")


@query("filter_provider_severity", f"WITH {NEWS} SELECT _id, severity FROM news WHERE provider IN ('nvd', 'wiz') AND severity IN ('High', 'Medium')")
def _(spark, d):
    return news(spark, d).where("source.provider in ('nvd', 'wiz') and severity in ('High', 'Medium')").orderBy(F.desc("observed_at"), "_id").select("_id", "severity")


@query("topn_per_provider", f"WITH {NEWS} SELECT provider, _id, CAST(rn AS INTEGER) AS rn FROM (SELECT provider, _id, row_number() OVER (PARTITION BY provider ORDER BY observed_at DESC, _id DESC) AS rn FROM news) WHERE rn <= 10")
def _(spark, d):
    return G.top_per_group(_plain(news(spark, d)), "provider", "observed_at", "_id", 10).select("provider", "_id", "rn")


# --- joins ----------------------------------------------------------------------------------------


@query("join_upsert_left", f"WITH {A.ADV} SELECT k, k % 10 = 3 AS is_new FROM adv WHERE k % 10 <> 2")
def _(spark, d):
    stored, batch = _digest_rows(spark, d).select("_id", F.lit(True).alias("there")), _digest_rows(spark, d, 1)
    return batch.join(stored, "_id", "left").select("k", C("there").isNull().alias("is_new"))


@query("join_semi_known", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5)")
def _(spark, d):
    known = table(spark, d, "customer").where("c_nationkey < 5").select(C("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").join(known, "o_custkey", "left_semi").select("o_orderkey")


@query("join_anti_new", "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5)")
def _(spark, d):
    known = table(spark, d, "customer").where("c_nationkey < 5").select(C("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").join(known, "o_custkey", "left_anti").select("o_orderkey")


@query("join_cve_xref", f"WITH {NEWS} SELECT DISTINCT any_cve AS cve, _id FROM news WHERE any_cve IS NOT NULL")
def _(spark, d):
    n = _plain(news(spark, d))
    wanted = A.adv(spark, d).select(F.concat(F.lit("CVE-"), F.regexp_replace("cve_raw", "(?i)^cve-", "")).alias("cve")).distinct()
    return H.cve_xref(n, wanted).select("cve", "_id")


def _shared_cves(spark, d):
    """News in which groups of ten orders report one CVE."""
    n = _plain(news(spark, d)).join(A.adv(spark, d).select(F.concat_ws(":", "provider", "code").alias("_id"), "k"), "_id")
    cve = F.concat(F.lit("2024-"), (F.floor(C("k") / 10) + 1000).cast("string"))
    return n.withColumn("code", cve).withColumn("cve_ids", F.array(F.concat(F.lit("CVE-"), cve)))


@query("cve_source_pairs", f"""WITH {NEWS}, f AS (SELECT k // 10 AS g, provider, min(published_at) AS at FROM news GROUP BY 1, 2)
    SELECT a.provider AS provider_a, b.provider AS provider_b, count(*) AS n, round(avg((epoch(b.at) - epoch(a.at)) / 3600), 3) AS avg_lag_hours FROM f a JOIN f b ON a.g = b.g AND a.provider < b.provider GROUP BY 1, 2""")
def _(spark, d):
    return H.source_pairs(_shared_cves(spark, d))


@query("join_catalog_left", "SELECT n_name AS provider, count(s_suppkey) AS n FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1")
def _(spark, d):
    nation = table(spark, d, "nation")
    docs = table(spark, d, "supplier").join(nation, C("s_nationkey") == C("n_nationkey")).select(C("n_name").alias("provider"))
    return H.catalog_counts(nation.select(C("n_name").alias("provider")), docs)


_DAYWIN = "w AS (SELECT i AS win, TIMESTAMP '2024-01-01' + to_hours(CAST(i * 30 AS INTEGER)) AS since, TIMESTAMP '2024-01-01' + to_hours(CAST(i * 30 + 40 AS INTEGER)) AS until FROM range(0, 24) AS t(i))"


@query("join_window_range", f"WITH {_DAYWIN} SELECT event_id, win FROM events JOIN w ON ts >= since AND ts < until AND user_id % 24 = win")
def _(spark, d):
    base = F.lit("2024-01-01").cast("timestamp_ntz")
    w = spark.range(24).select(C("id").alias("win"), (base + F.make_dt_interval(F.lit(0), (C("id") * 30).cast("int"))).alias("since"), (base + F.make_dt_interval(F.lit(0), (C("id") * 30 + 40).cast("int"))).alias("until"))
    return H.covering_windows(table(spark, d, "events").withColumn("win", C("user_id") % 24), w, "win", "ts").select("event_id", "win")


_SPANS = "w AS (SELECT o_orderkey AS w, o_custkey % 24 AS key, TIMESTAMP '2024-01-01' + to_minutes(CAST(o_orderkey % 43200 AS INTEGER)) AS since, CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 720 ELSE 5256000 END AS minutes FROM orders WHERE o_orderpriority = '1-URGENT')"


@query("join_window_lengths", f"WITH {_SPANS} SELECT event_id, count(*) AS n, CAST(sum(w) AS BIGINT) AS windows FROM events JOIN w ON ts >= since AND ts < since + to_minutes(CAST(minutes AS INTEGER)) AND user_id % 24 = key GROUP BY 1")
def _(spark, d):
    """Windows of a minute, of half a day and of ten years."""
    k, base = C("o_orderkey"), F.lit("2024-01-01").cast("timestamp_ntz")
    minutes = lambda m: F.make_dt_interval(F.lit(0), F.lit(0), m.cast("int"))
    since = base + minutes(k % 43200)
    length = F.when(k % 3 == 0, F.lit(1)).when(k % 3 == 1, F.lit(720)).otherwise(F.lit(5256000))
    w = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(k.alias("w"), (C("o_custkey") % 24).alias("key"), since.alias("since"), (since + minutes(length)).alias("until"))
    hit = H.covering_totals(table(spark, d, "events").select("event_id", "ts", (C("user_id") % 24).alias("key")), w, "key", "ts", "w")
    return hit.groupBy("event_id").agg(F.sum("n").alias("n"), F.sum("total").alias("windows"))


@query("join_ledger_asof", f"WITH {A.OBSERVATIONS}, l AS (SELECT identity, max(observed_at) AS m FROM observations WHERE event_id % 2 = 0 GROUP BY 1) SELECT event_id FROM observations o LEFT JOIN l USING (identity) WHERE event_id % 2 = 1 AND (m IS NULL OR m < observed_at)")
def _(spark, d):
    o = A.observations(spark, d)
    return H.not_committed(o.where("event_id % 2 = 1"), o.where("event_id % 2 = 0").select("identity", "observed_at")).select("event_id")


@query("join_broadcast_rules", "SELECT s_suppkey, r_name AS rule FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey AND r_regionkey < 3")
def _(spark, d):
    rules = table(spark, d, "nation").join(table(spark, d, "region").where("r_regionkey < 3"), C("r_regionkey") == C("n_regionkey"), "left").select(C("n_nationkey").alias("s_nationkey"), C("r_name").alias("rule"))
    return H.by_rules(table(spark, d, "supplier"), rules, "s_nationkey").select("s_suppkey", "rule")


@query("join_text_contains", """WITH t AS (SELECT p_partkey, ' about ' || p_name || ' and red widget ' AS text FROM part), terms AS (SELECT DISTINCT p_name AS term FROM part)
    SELECT p_partkey AS id, term FROM t JOIN terms ON contains(text, ' ' || term || ' ')""")
def _(spark, d):
    p = table(spark, d, "part")
    texts = p.select(C("p_partkey").alias("id"), F.concat(F.lit("About: "), F.upper("p_name"), F.lit(", and (red  widget)!")).alias("text"))
    return W.text_matches(texts, p.select(C("p_name").alias("term"))).select("id", "term")


_NEAR = """d AS (SELECT label, arg_min(embedding, vec_id) AS u FROM embeddings GROUP BY label), q AS (SELECT vec_id, label, embedding AS v FROM embeddings),
    s AS (SELECT q.vec_id AS id, d.label AS name, round(list_sum(list_transform(range(1, len(u) + 1), lambda i: CAST(u[i] AS DOUBLE) * CAST(v[i] AS DOUBLE))) / (sqrt(list_sum(list_transform(u, lambda x: CAST(x AS DOUBLE) * x))) * sqrt(list_sum(list_transform(v, lambda x: CAST(x AS DOUBLE) * x)))), 6) AS score FROM q, d),
    b AS (SELECT id, max(score) AS score FROM s GROUP BY 1), n AS (SELECT id, b.score, max(name) AS candidate FROM b JOIN s USING (id) WHERE s.score = b.score GROUP BY 1, 2)"""


def _near(spark, d, threshold):
    e = table(spark, d, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    dictionary = e.groupBy("label").agg(F.min_by("v", "vec_id").alias("u")).select(C("label").alias("name"), "u")
    return W.nearest(e.select(C("vec_id").alias("id"), "v"), dictionary, threshold)


@query("join_nearest", f"WITH {_NEAR} SELECT id, CASE WHEN score >= 0.5 THEN candidate END AS name, round(score, 4) AS score FROM n")
def _(spark, d):
    return _near(spark, d, 0.5).select("id", "name", F.round("score", 4).alias("score"))


_LARGE = _NEAR.replace("SELECT label, arg_min(embedding, vec_id) AS u FROM embeddings GROUP BY label", "SELECT vec_id AS label, list_reverse(embedding) AS u FROM embeddings")


@query("join_nearest_cells", f"WITH {_LARGE} SELECT id, candidate, round(score, 4) AS score FROM n")
def _(spark, d):
    """A dictionary of as many entries as there are vectors: each one read backwards."""
    e = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    found = W.nearest_in_cells(e.select(C("vec_id").alias("id"), "v"), e.select(C("vec_id").alias("name"), F.reverse("v").alias("u")))
    return found.select("id", "candidate", F.round("score", 4).alias("score"))


_PLAIN = r"trim(regexp_replace(lower({}), '[^\p{{L}}\p{{M}}\p{{N}}#]+', ' ', 'g'))"


@query("join_text_passages", f"""WITH t AS (SELECT doc_id, ' ' || {_PLAIN.format('text')} || ' ' AS plain FROM documents), w AS (SELECT item_id, string_split({_PLAIN.format('text')}, ' ') AS w FROM benchmark),
    terms AS (SELECT DISTINCT array_to_string(w[1:4], ' ') AS term FROM w UNION SELECT array_to_string(w[1:7], ' ') FROM w) SELECT doc_id AS id, term FROM t JOIN terms ON contains(plain, ' ' || term || ' ')""")
def _(spark, d):
    """Beginnings of benchmark passages in whole documents, by the way for dictionaries that no automaton holds."""
    words = F.split(W.plain_words("text"), " ")
    b = table(spark, d, "benchmark")
    terms = b.select(F.array_join(F.slice(words, 1, 4), " ").alias("term")).unionByName(b.select(F.array_join(F.slice(words, 1, 7), " ").alias("term")))
    return W.text_matches(table(spark, d, "documents").select(C("doc_id").alias("id"), "text"), terms, automaton_bytes=0).select("id", "term")
