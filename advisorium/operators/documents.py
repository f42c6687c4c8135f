"""Building, comparing and storing advisory documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nested as N
from ..functions import severity as S
from ..functions import text as X
from ..functions import times as D
from ..functions.canonical import canonical_fields, canonical_text, quoted
from ..sources.landing import write_snapshot

# Per provider the detail fields by role, in order of priority.
ROLES = ("identity", "title", "cve", "severity", "published", "updated", "source", "volatile")
PROVIDER_RULES: dict[str, dict[str, list[str]]] = {
    "avd": {"cve": ["cve_id"], "severity": ["danger_level"], "published": ["attack_metrics.disclosure_date"]},
    "cisco": {"identity": ["advisory_id"], "title": ["title"], "cve": ["cve_id", "cve_ids"], "severity": ["sir"], "published": ["first_published"], "updated": ["last_updated"], "source": ["publication_url"]},
    "cnnvd": {"identity": ["cnnvdId"], "title": ["vulName"], "cve": ["cveId", "cveCode"], "severity": ["vulLevel", "hazardLevel"], "published": ["publishDate", "publishTime"], "updated": ["updateTime"]},
    "cnvd": {"identity": ["cnvd_id"], "title": ["title"], "cve": ["cve_ids"], "severity": ["severity"], "published": ["published_date"], "updated": ["updated_date"], "volatile": ["click_count", "comment_count", "follow_count", "clickCount", "commentCount", "followCount"]},
    "cve": {"identity": ["cve_id"], "title": ["title"], "cve": ["cve_id"], "published": ["published"], "updated": ["last_modified"], "volatile": ["vuln_status", "affected_products"]},
    "fortiguard": {"identity": ["advisory_id"], "title": ["title"], "cve": ["cve_ids"], "severity": ["severity"], "published": ["published_date"], "updated": ["updated_date"], "source": ["csaf_url", "cvrf_url"]},
    "github_advisory": {"identity": ["ghsa_id"], "cve": ["cve_id", "cve_ids"], "severity": ["severity"], "published": ["published_at"], "updated": ["updated_at"], "source": ["html_url", "api_url"]},
    "govcert": {"identity": ["alert_code"], "cve": ["cve_ids"], "severity": ["severity"], "published": ["published_date"]},
    "hikvision": {"identity": ["advisory_id"], "title": ["title"], "cve": ["cve_ids"], "severity": ["severity"], "published": ["initial_release_date", "published_date"], "updated": ["updated_date"]},
    "hkcert": {"cve": ["vulnerability_identifiers"], "severity": ["risk_level"], "published": ["release_date"], "updated": ["last_update_date"], "volatile": ["views"]},
    "hpe": {"identity": ["doc_id"], "title": ["title"], "cve": ["cve_ids"], "severity": ["severity"], "published": ["release_date", "published_date"], "updated": ["last_updated"]},
    "huawei_sa": {"identity": ["sasnNo", "sasnId"], "title": ["title"], "cve": ["cve_ids"], "severity": ["severity"], "published": ["publishDate"]},
    "infosec": {"identity": ["alert_code"], "cve": ["cve_ids"], "published": ["published_date"]},
    "juniper": {"identity": ["article_id"], "title": ["title"], "cve": ["cve_ids"], "published": ["published_date"], "updated": ["updated_date"]},
    "msrc": {"identity": ["cve_id", "document_id"], "title": ["title"], "cve": ["cve_id"], "published": ["initial_release_date"], "updated": ["current_release_date"]},
    "nvd": {"identity": ["cve_id"], "title": ["title"], "cve": ["cve_id"], "severity": ["severity"], "published": ["published_at", "published_date"], "updated": ["updated_at", "last_modified"], "source": ["detail_url"], "volatile": ["vuln_status"]},
    "paloalto": {"identity": ["advisory_id"], "title": ["title"], "cve": ["cve_ids"], "severity": ["severity"], "published": ["published_date"], "updated": ["updated_date"]},
    "qianxin": {"identity": ["article_id"], "title": ["title"], "cve": ["cve_ids"], "severity": ["level"], "published": ["published_at", "published_date"], "updated": ["updated_at", "updated_date"], "volatile": ["read_num", "prev_article", "next_article"]},
    "ransomwarelive": {"title": ["victim"], "published": ["attackdate"], "updated": ["discovered"]},
    "splunk": {"identity": ["advisory_id"], "title": ["title"], "cve": ["cve_id", "cve_ids"], "severity": ["severity"], "published": ["published_date"], "updated": ["last_modified"]},
    "wiz": {"identity": ["feed_guid"], "title": ["title"], "cve": ["cve_ids"], "published": ["published_at"], "updated": ["updated_at"], "source": ["article_url"]},
    "zeroday": {"cve": ["cve_id"], "published": ["disclosed_date"], "updated": ["patched_date"]},
    "zimbra": {"identity": ["version"], "title": ["title"], "published": ["release_date"], "source": ["reference_links"]},
}
REGISTERED = sorted(PROVIDER_RULES)


def role_fields(provider: Column, role: str) -> Column:
    """array<string> of the detail fields with a role: a constant map, so the look-up folds into the plan."""
    pairs = [x for name, rules in PROVIDER_RULES.items() for x in (F.lit(name), F.array(*[F.lit(f) for f in rules.get(role, [])]).cast("array<string>"))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), provider), F.array().cast("array<string>"))


def detail_clean(rows: DataFrame) -> Column:
    """Detail fields (map<string,string>) without raw, volatile and blank ones and without those that repeat the envelope.

    Expects provider, code, title, cve_raw, severity_raw, url, detail_url, details, and the parsed publication time as _published.
    """
    p = F.col("provider")
    roles = {r: role_fields(p, r) for r in ROLES}
    same_time = lambda v: D.parse_hk(v).eqNullSafe(F.col("_published"))

    def repeats(k: Column, v: Column) -> Column:
        has = lambda role: F.array_contains(roles[role], k)
        return F.coalesce(
            (has("identity") & (F.lower(v) == F.lower("code"))) | (has("title") & (F.lower(F.trim(v)) == F.lower(F.trim("title"))))
            | (has("cve") & (X.cve_normalize(v) == X.cve_normalize(F.col("cve_raw")))) | (has("severity") & (S.severity_normalize(v) == S.severity_normalize(F.col("severity_raw"))))
            | ((has("published") | has("updated")) & same_time(v)) | (has("source") & v.isin(F.col("url"), F.col("detail_url"))),
            F.lit(False),
        )

    return F.map_filter("details", lambda k, v: v.isNotNull() & (F.trim(v) != "") & ~k.startswith("raw") & ~F.array_contains(roles["volatile"], k) & ~repeats(k, v))


def metric_preference(metrics: dict[str, Column]) -> Column:
    """struct(version, severity, score, vector): the newest version with a metric; in it the primary one, else the first."""
    out = F.lit(None).cast("struct<version:string,severity:string,score:double,vector:string>")
    for version in sorted(metrics):  # the last, newest, wraps all others
        m = metrics[version]
        best = F.coalesce(F.get(F.filter(m, lambda x: x.type == "Primary"), F.lit(0)), F.get(m, F.lit(0)))
        out = F.when(F.size(m) > 0, F.struct(F.lit(version).alias("version"), best.severity.alias("severity"), best.score.alias("score"), best.vector.alias("vector"))).otherwise(out)
    return out


def metrics_regroup(metrics: Column, versions: dict[str, str], others: list[str]) -> Column:
    """Mixed metric objects by version; fields of no version keep their name."""
    pick = lambda name: F.array_compact(F.transform(metrics, lambda m: m[name]))
    return F.struct(*[pick(source).alias(out) for out, source in versions.items()], *[pick(o).alias(o) for o in others])


def cpe_products(configurations: Column, affected: Column) -> Column:
    """vendor:product of all CPE criteria, then of the affected list; each once in first order."""
    criteria = F.flatten(F.flatten(F.transform(configurations, lambda c: F.transform(c.nodes, lambda n: F.transform(n.cpeMatch, lambda m: m.criteria)))))
    named = F.transform(criteria, lambda c: F.concat_ws(":", F.get(F.split(c, ":"), F.lit(3)), F.get(F.split(c, ":"), F.lit(4))))
    return F.array_distinct(F.concat(named, F.transform(affected, lambda a: F.concat_ws(":", a.vendor, a.product))))


def cvrf_explode(documents: DataFrame) -> DataFrame:
    """Month documents -> one row per vulnerability with a valid identifier; document columns stay with it."""
    rows = documents.select("document", F.explode("Vulnerability").alias("v"))
    threats = F.filter("v.Threats", lambda t: F.trim(t) != "")
    out = rows.select("document", X.cve_canonical(F.col("v.CVE")).alias("cve"), F.coalesce(X.blank_to_null(F.col("v.Title")), F.col("document")).alias("title"), F.get(threats, F.lit(0)).alias("vuln_type"))
    return out.where("cve is not null")


def product_tree(nodes: DataFrame) -> DataFrame:
    """nodes(id, parent, name) -> id, name, depth: every node under a root, whose depth is 1.

    Pointers are doubled: each round replaces a node's pointer by that of the node it points to, so
    a tree of depth n takes log2(n) rounds, each a join of written tables.  Nodes whose
    parents lead to a missing one are left out; nodes that lead into a circle are an error.
    """
    now = write_snapshot(nodes.select("id", "name", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), 1).alias("depth"), F.lit(1).alias("steps")), "tree")
    most, rounds = nodes.count(), 0
    while not (rest := now.where("up is not null")).isEmpty():
        if 2 ** rounds > 2 * most:  # more steps than nodes
            names = ", ".join(str(r.id) for r in rest.select("id").limit(10).collect())
            raise ValueError(f"the nodes form a circle: {names}")
        to = now.select(F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("depth").alias("_depth"), F.col("steps").alias("_steps"))
        j = rest.join(to, rest["up"] == to["_id"], "left")
        moved = j.select("id", "name", F.col("_up").alias("up"), (F.col("_depth") + F.col("steps")).alias("depth"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"))
        now, rounds = write_snapshot(now.where("up is null").unionByName(moved), "tree"), rounds + 1
    return now.where("depth is not null").select("id", "name", "depth").distinct()


def product_names_join(sets: DataFrame, names: DataFrame) -> DataFrame:
    """sets(key, product_ids) and names(product_id, name) -> key, names: unknown ids dropped, order kept."""
    flat = sets.select("key", F.posexplode_outer("product_ids").alias("pos", "product_id"))
    found = flat.join(names, "product_id", "left")
    listed = found.groupBy("key").agg(F.array_sort(F.collect_list(F.when(F.col("name").isNotNull(), F.struct("pos", "name")))).alias("v"))
    return listed.select("key", F.transform("v", lambda x: x["name"]).alias("names"))


def merge_detail(listing: DataFrame, detail: DataFrame, key: str) -> DataFrame:
    """The detail record wins, the listing fills what is missing, lists are united and the detail's address leads them; another code is an error."""
    kinds = {f.name: f.dataType for f in listing.schema.fields}
    both = listing.alias("l").join(detail.alias("d"), key, "left")
    fields = [N.fill(F.col(f"d.{c}"), F.col(f"l.{c}"), kinds[c]).alias(c) for c in listing.columns if c not in (key, "links", "code")]
    links = F.array_distinct(F.array_compact(F.concat(F.array("d.url"), F.coalesce("d.links", F.array().cast("array<string>")), F.coalesce("l.links", F.array().cast("array<string>")))))
    return both.select(key, F.col("l.code").alias("code"), *fields, links.alias("links"), F.when(F.col("d.code") != F.col("l.code"), "id_mismatch").alias("error"))


def legacy_shape_upgrade(doc: Column) -> Column:
    """Old keys of a JSON document under their new names; delimited text becomes a list."""
    old = F.from_json(doc, "struct<vulnerable_products:string,intro_tables:string,affected_products:array<string>,introduction:string>")
    split = X.list_split(old.vulnerable_products)
    return F.struct(F.coalesce(old.affected_products, F.when(F.size(split) > 0, split)).alias("affected_products"), F.coalesce(old.introduction, old.intro_tables).alias("introduction"))


# --- the envelope ---------------------------------------------------------------------------------


def build_document(rows: DataFrame) -> DataFrame:
    """Collected advisories -> envelope columns and ``error`` (null where the row is fine).

    Expects provider, code, title, cve_raw, severity_raw, published_raw, updated_raw, observed_at, url,
    detail_url, status and details (map<string,string>).
    """
    provider, code = F.col("provider"), X.blank_to_null(F.col("code"))
    severity = S.severity_normalize(F.col("severity_raw"))
    published = F.col("_published")
    rows = rows.withColumn("_published", D.parse_hk(F.col("published_raw")))  # read more than once, so it stays a column of its own
    error = F.when(~provider.isin(*REGISTERED) | provider.isNull(), "unknown_provider").when(code.isNull(), "empty_code").when(F.col("observed_at").isNull(), "no_observation")
    cves = X.collect_cves(F.array("cve_raw"))
    return rows.select(
        F.concat_ws(":", provider, code).alias("_id"), F.lit(2).alias("schema_version"), code.alias("code"), F.coalesce(X.blank_to_null(X.text_clean(F.col("title"))), code).alias("title"),
        F.when(severity != "Unknown", severity).alias("severity"), N.change_type(F.col("status")).alias("change_type"), published.alias("published_at"),
        F.coalesce(D.parse_hk(F.col("updated_raw")), published).alias("updated_at"), F.col("observed_at"), N.source_clean(provider, F.col("url"), F.col("detail_url")).alias("source"),
        F.when((provider != "cve") & (F.size(cves) > 0), cves).alias("cve_ids"), detail_clean(rows).alias("details"), error.alias("error"),
    )


def convert_existing(rows: DataFrame) -> DataFrame:
    """Stored rows of either version -> _id, code, provider, observed_at, schema_version.

    Version 2 passes with its provider repaired from the id; older rows take the code from the end of
    the id and the first known observation time, 1970 if there is none.  The id is kept.
    """
    prefix, suffix = F.lower(F.substring_index("_id", ":", 1)), F.regexp_replace("_id", "^[^:]*:", "")
    new = F.col("schema_version") == 2
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return rows.select(
        "_id", F.when(new, F.col("code")).otherwise(F.coalesce(F.col("code"), suffix)).alias("code"), F.when(F.col("provider").isin(*REGISTERED), F.col("provider")).otherwise(prefix).alias("provider"),
        F.when(new, F.col("observed_at")).otherwise(F.coalesce("observed_at", "scraped_at", epoch)).alias("observed_at"), F.lit(2).alias("schema_version"),
    )


def provider_infer(candidates: Column, known: list[str]) -> Column:
    """The first candidate that is a registered provider."""
    return F.get(F.filter(F.transform(candidates, F.lower), lambda x: x.isin(*known)), F.lit(0))


NOT_COMPARED = ("_id", "observed_at", "scraped_at", "source", "classification", "error")


def content_payload(schema: T.StructType) -> Column:
    """The compared part of a document of this schema as canonical text: fields by name and type, and the provider of its source.

    Identifier, observation time, source and classification are not compared.  Maps with the same
    entries in another order are the same, lists in another order are not; a null field is the same as none.
    """
    fields = [f for f in schema.fields if f.name not in NOT_COMPARED]
    kinds = T.StructType([*fields, T.StructField("source_provider", T.StringType())])
    return canonical_text(F.struct(*[F.col(f.name) for f in fields], F.col("source.provider").alias("source_provider")), kinds)


def content_digest(schema: T.StructType) -> Column:
    return F.sha2(content_payload(schema), 256)


def json_content_payload(doc: Column) -> Column:
    """The same for open documents as JSON text, where a null field differs from none; null where the text is no object."""
    fields = canonical_fields(doc)
    kept = F.map_filter(fields, lambda k, _: ~k.isin(*NOT_COMPARED))
    entries = F.transform(F.map_entries(kept), lambda e: F.concat(quoted(e["key"]), F.lit(":"), e["value"]))
    provider = F.concat(F.lit('"source_provider":'), F.coalesce(quoted(F.get_json_object(doc, "$.source.provider")), F.lit("null")))
    return F.concat(F.lit("{"), F.array_join(F.array_sort(F.concat(entries, F.array(provider))), ","), F.lit("}"))


def documents_match(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Documents of two tables by _id -> _id, same: false where the content differs or only one table has it.

    Their schemas may differ, in the order of fields, in numeric types and in fields that are null throughout.
    """
    left = stored.select("_id", content_digest(stored.schema).alias("_a"))
    right = batch.select("_id", content_digest(batch.schema).alias("_b"))
    return left.join(right, "_id", "full").select("_id", F.col("_a").eqNullSafe(F.col("_b")).alias("same"))


def upsert_classify(stored: DataFrame, batch: DataFrame, mode: str = "overwrite") -> DataFrame:
    """stored(_id, digest, provider, observed_at), batch(the same, pos) -> batch rows with ``action``.

    Several rows for one id count in order of ``pos``; only the last is compared with the store, the
    earlier ones are 'superseded'.  Actions: insert, unchanged, overwrite, skip (conflict in skip
    mode), stale (the store holds a later observation).  A wrong provider is always overwritten.
    """
    if mode not in ("overwrite", "skip"):
        raise ValueError("mode is 'overwrite' or 'skip'")
    last = Window.partitionBy("_id").orderBy(F.desc("pos"))
    b = batch.withColumn("_rn", F.row_number().over(last))
    s = stored.select("_id", F.col("digest").alias("s_digest"), F.col("provider").alias("s_provider"), F.col("observed_at").alias("s_observed"))
    j = b.join(s, "_id", "left")
    action = (
        F.when(F.col("_rn") > 1, "superseded").when(F.col("s_digest").isNull(), "insert").when(~F.col("s_provider").eqNullSafe(F.col("provider")), "overwrite")
        .when(F.col("s_observed") > F.col("observed_at"), "stale").when(F.col("s_digest") == F.col("digest"), "unchanged").otherwise(mode)
    )
    return j.withColumn("action", action).drop("_rn", "s_digest", "s_provider", "s_observed")


def upsert_apply(stored: DataFrame, classified: DataFrame, carried: list[str]) -> DataFrame:
    """The new table: inserted and overwritten rows from the batch, with the stored ``carried`` columns; all others stay."""
    new = classified.where("action in ('insert', 'overwrite')").select(*[c for c in stored.columns if c not in carried])
    kept = stored.select("_id", *carried)
    changed = new.join(kept, "_id", "left").select(*stored.columns)
    return stored.join(new.select("_id"), "_id", "left_anti").select(*stored.columns).unionByName(changed)


def upsert_stats(classified: DataFrame) -> DataFrame:
    n = lambda *a: F.count_if(F.col("action").isin(*a))
    return classified.agg(
        n("insert").alias("inserted"), n("overwrite").alias("overwritten"), F.lit(0).cast("long").alias("deleted"), n("skip", "stale").alias("skipped"),
        n("overwrite", "skip").alias("conflicts"), n("unchanged").alias("unchanged"), n("superseded").alias("superseded"),
    )


def changed_entries(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listing rows (identity, signature) whose signature differs from the ledger's, or that the ledger doesn't have."""
    known = ledger.select("identity", F.col("signature").alias("_seen"))
    return listing.join(known, "identity", "left").where(~F.col("signature").eqNullSafe(F.col("_seen"))).drop("_seen")


def unchanged_skip(listing: DataFrame, ledger: DataFrame, stored: DataFrame) -> DataFrame:
    """Listing rows with ``fetch``: false where the signature is the ledger's and the row is still stored."""
    known = ledger.select("identity", F.col("signature").alias("_seen"))
    there = stored.select("identity", F.lit(True).alias("_there")).distinct()
    j = listing.join(known, "identity", "left").join(there, "identity", "left")
    same = F.col("signature").eqNullSafe(F.col("_seen")) & F.col("_there").isNotNull()
    return j.withColumn("fetch", ~same).drop("_seen", "_there")


def snapshot_put(payloads: DataFrame) -> DataFrame:
    """payload, written_at -> digest, payload, written_at: one row for each content, first written."""
    return payloads.withColumn("digest", F.sha2("payload", 256)).groupBy("digest", "payload").agg(F.min("written_at").alias("written_at"))


def snapshot_verify(snapshots: DataFrame) -> DataFrame:
    return snapshots.where(F.sha2("payload", 256) == F.col("digest"))


def snapshot_prune(snapshots: DataFrame, references: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Without snapshots older than ``days`` that nothing refers to."""
    held = references.select("digest", F.lit(True).alias("_held")).distinct()
    j = snapshots.join(held, "digest", "left")
    return j.where((F.col("written_at") >= now - F.make_dt_interval(F.lit(days))) | F.col("_held").isNotNull()).drop("_held")


def unify(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(_id, provider, observed_at, digest, ...) of all tables -> (one row per id, report of ids that fail).

    An id under two providers fails, and so does one whose newest time has two contents; else the newest
    observation wins and equal rows count once.
    """
    best = rows.groupBy("_id").agg(
        F.max(F.struct("observed_at", "digest", "provider")).alias("top"), F.count_distinct("provider").alias("providers"), F.count("*").alias("n"),
        F.max(F.struct("observed_at", F.col("digest"))).alias("hi"), F.min_by("digest", F.struct(-F.unix_micros(F.col("observed_at").cast("timestamp")), F.col("digest"))).alias("lo_digest"),
    )
    reason = F.when(F.col("providers") > 1, "provider").when(F.col("hi.digest") != F.col("lo_digest"), "tie")
    judged = best.select("_id", "top.provider", "top.observed_at", "top.digest", "n", reason.alias("reason"))
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null").select("_id", "reason", "n")


def parity(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """side, n: identifiers that only one of two tables has, and the counts of both."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    row = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("side"), "n")
    return row("left_only", a.exceptAll(b)).unionByName(row("right_only", b.exceptAll(a))).unionByName(row("left", a)).unionByName(row("right", b))


def field_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, set, unset: names of fields to write and to remove so that ``old`` becomes ``new``."""
    j = old.alias("o").join(new.alias("n"), key)
    changed = F.array_compact(F.array(*[F.when(F.col(f"n.{f}").isNotNull() & ~F.col(f"n.{f}").eqNullSafe(F.col(f"o.{f}")), F.lit(f)) for f in fields]))
    gone = F.array_compact(F.array(*[F.when(F.col(f"n.{f}").isNull() & F.col(f"o.{f}").isNotNull(), F.lit(f)) for f in fields]))
    return j.select(key, changed.alias("set"), gone.alias("unset")).where((F.size("set") > 0) | (F.size("unset") > 0))
