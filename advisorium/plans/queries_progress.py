"""Queries over progress intervals, aggregates, monitoring and classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.severity import severity_normalize
from ..functions.times import stamp
from ..operators import classify as K
from ..operators import monitor as M
from ..operators import progress as J
from . import adapters as A
from .queries_documents import NEWS, _NEAR, _near, _plain, news
from .registry import query, table

C = F.col


def _t(x):
    return F.lit(x).cast("timestamp_ntz")


# --- intervals ------------------------------------------------------------------------------------

_MERGED = f"""{A.WINDOWS}, m1 AS (SELECT *, max(until) OVER (PARTITION BY provider ORDER BY since, until ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM windows),
    m2 AS (SELECT *, sum(CASE WHEN reach IS NULL OR since > reach THEN 1 ELSE 0 END) OVER (PARTITION BY provider ORDER BY since, until ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM m1),
    merged AS (SELECT provider, min(since) AS since, max(until) AS until FROM m2 GROUP BY provider, island)"""


@query("interval_merge", f"WITH {_MERGED} SELECT provider, {A.stamp_sql('since')} AS since, {A.stamp_sql('until')} AS until FROM merged")
def _(spark, d):
    return J.interval_merge(A.windows(spark, d), "provider").select("provider", stamp(C("since")).alias("since"), stamp(C("until")).alias("until"))


@query("frontier_advance", f"""WITH {_MERGED}, b AS (SELECT provider, min(since) + INTERVAL 10 DAY AS boundary FROM windows GROUP BY 1)
    SELECT provider, {A.stamp_sql('greatest(max(boundary), max(CASE WHEN since <= boundary AND until >= boundary THEN until END))')} AS frontier, count(*) FILTER (WHERE since > boundary) AS pending FROM b JOIN merged USING (provider) GROUP BY 1""")
def _(spark, d):
    w = A.windows(spark, d)
    marks = w.groupBy("provider").agg((F.min("since") + F.make_dt_interval(F.lit(10))).alias("boundary"))
    return J.frontier_advance(w, marks, "provider").select("provider", stamp(C("frontier")).alias("frontier"), "pending")


@query("interval_clamp", f"WITH {A.WINDOWS} SELECT provider, {A.stamp_sql('greatest(since, c)')} AS since, {A.stamp_sql('least(until, n)')} AS until FROM (SELECT *, TIMESTAMP '1997-01-01' AS c, TIMESTAMP '1999-01-01' AS n FROM windows) WHERE until >= c AND greatest(since, c) <= least(until, n)")
def _(spark, d):
    return J.interval_clamp(A.windows(spark, d), _t("1997-01-01"), _t("1999-01-01")).select("provider", stamp(C("since")).alias("since"), stamp(C("until")).alias("until"))


@query("bootstrap_mark", f"""WITH {NEWS}, s AS (SELECT provider, max(updated_at) AS u, max(published_at) AS p FROM news WHERE provider <> 'wiz' GROUP BY 1), c AS (SELECT unnest(['cve','nvd','github_advisory','msrc','splunk','wiz']) AS provider)
    SELECT c.provider, {A.stamp_sql("least(TIMESTAMP '2001-07-20', coalesce(u, p, TIMESTAMP '2001-07-13'))")} AS start, u IS NULL AND p IS NULL AS empty FROM c LEFT JOIN s USING (provider)""")
def _(spark, d):
    catalog = spark.createDataFrame([(p,) for p in A.PROVIDERS], "provider string")
    return J.bootstrap_mark(catalog, _plain(news(spark, d)).where("provider <> 'wiz'"), _t("2001-07-20")).select("provider", stamp(C("start")).alias("start"), "empty")


@query("coverage_gap", f"WITH e AS (SELECT user_id % 40 AS provider, min(ts) AS until FROM events GROUP BY 1), w AS (SELECT i AS provider, TIMESTAMP '2024-01-01' + to_hours(CAST(i AS INTEGER)) AS since FROM range(0, 40) AS t(i)) SELECT provider, {A.stamp_sql('since')} AS since, {A.stamp_sql('until')} AS until FROM w JOIN e USING (provider) WHERE until > since")
def _(spark, d):
    feed = table(spark, d, "events").select((C("user_id") % 40).alias("provider"), "ts")
    wanted = spark.range(40).select(C("id").alias("provider"), (_t("2024-01-01") + F.make_dt_interval(F.lit(0), C("id").cast("int"))).alias("since"))
    return J.coverage_gap(feed, wanted, "provider", "ts").select("provider", stamp(C("since")).alias("since"), stamp(C("until")).alias("until"))


@query("sync_status", """WITH c AS (SELECT DISTINCT user_id AS provider FROM events), w AS (SELECT user_id AS provider, count(*) AS n FROM events WHERE event_type = 'view' AND value > 20 GROUP BY 1), r AS (SELECT user_id AS provider, count(*) AS n FROM events WHERE event_type = 'click' AND value > 20 GROUP BY 1),
    e AS (SELECT user_id AS provider, count(*) AS n FROM events WHERE event_type = 'error' AND value > 30 GROUP BY 1)
    SELECT provider, coalesce(w.n, 0) AS pending_windows, coalesce(r.n, 0) AS pending_retries, CASE WHEN e.n > 0 THEN 'error' WHEN w.n > 0 OR r.n > 0 THEN 'partial' ELSE 'up_to_date' END AS status FROM c LEFT JOIN w USING (provider) LEFT JOIN r USING (provider) LEFT JOIN e USING (provider)""")
def _(spark, d):
    e = table(spark, d, "events").withColumn("provider", C("user_id"))
    part = lambda kind, v: e.where((C("event_type") == kind) & (C("value") > v))
    return J.sync_status(e.select("provider").distinct(), part("view", 20), part("click", 20), part("error", 30))


@query("caught_up", "SELECT user_id AS provider, count(*) FILTER (WHERE event_type = 'error' AND value > 20) = 0 AND count(*) FILTER (WHERE event_type = 'view' AND value > 20) = 0 AS caught_up, NOT (count(*) FILTER (WHERE event_type = 'error' AND value > 20) = 0 AND count(*) FILTER (WHERE event_type = 'view' AND value > 20) = 0) AND count(*) FILTER (WHERE event_type = 'purchase' AND value > 15) = 0 AS no_progress FROM events GROUP BY 1")
def _(spark, d):
    n = lambda kind, v: F.count_if((C("event_type") == kind) & (C("value") > v))
    runs = table(spark, d, "events").groupBy(C("user_id").alias("provider")).agg(n("purchase", 15).alias("fetched"), n("view", 20).alias("pending"), n("error", 20).alias("errors"))
    return J.run_flags(runs).select("provider", "caught_up", "no_progress")


def _retries(spark, d):
    e = C("event_id")
    return A.failures(spark, d).select(
        e, "provider", "identity", C("updated_at").alias("failed_at"), F.when(e % 3 == 0, C("updated_at") - F.make_dt_interval(F.lit(5))).alias("record_at"), F.when(e % 3 == 1, C("updated_at") - F.make_dt_interval(F.lit(3))).alias("news_at"),
        (C("updated_at") - F.make_dt_interval(F.lit(1))).alias("listed_at"), C("updated_at").alias("required_at"),
    )


@query("retry_expire", f"""WITH {A.FAILURES} SELECT event_id, coalesce(CASE event_id % 3 WHEN 0 THEN updated_at - INTERVAL 5 DAY WHEN 1 THEN updated_at - INTERVAL 3 DAY ELSE CASE WHEN updated_at < TIMESTAMP '2024-01-13' THEN updated_at - INTERVAL 1 DAY END END < TIMESTAMP '2024-01-14', false) AS expired FROM failures""")
def _(spark, d):
    return J.retry_expire(_retries(spark, d), _t("2024-01-14"), _t("2024-01-20")).select("event_id", "expired")


@query("retry_resolve", f"""WITH {A.FAILURES}, s AS (SELECT 'p' || (user_id % 6) AS provider, 'id' || (user_id % 40) AS identity, max(ts) AS ok FROM events WHERE event_type = 'view' GROUP BY 1, 2), t AS (SELECT DISTINCT 'p' || (user_id % 6) AS provider, 'id' || (user_id % 40) AS identity FROM events WHERE event_type = 'click' AND value > 25)
    SELECT event_id FROM failures f LEFT JOIN s USING (provider, identity) LEFT JOIN t ON t.provider = f.provider AND t.identity = f.identity WHERE NOT (coalesce(ok >= f.updated_at, false) AND t.identity IS NOT NULL)""")
def _(spark, d):
    e = table(spark, d, "events").select(F.concat(F.lit("p"), (C("user_id") % 6).cast("string")).alias("provider"), F.concat(F.lit("id"), (C("user_id") % 40).cast("string")).alias("identity"), C("ts").alias("observed_at"), "event_type", "value")
    return J.retry_resolve(_retries(spark, d), e.where("event_type = 'view'"), e.where("event_type = 'click' and value > 25")).select("event_id")


@query("window_complete", f"WITH {A.WINDOWS} SELECT provider, count(*) FILTER (WHERE since = until OR provider % 7 = 0) AS not_done, count(*) AS n FROM windows GROUP BY 1")
def _(spark, d):
    w = A.windows(spark, d).withColumn("enumerated", C("since") < C("until"))
    failed = w.select("provider").where("provider % 7 = 0").distinct()
    return J.window_complete(w, failed).groupBy("provider").agg(F.count_if(~C("complete")).alias("not_done"), F.count("*").alias("n"))


# --- aggregates and monitoring --------------------------------------------------------------------


@query("agg_provider_version", f"WITH {NEWS} SELECT provider, 2 AS schema_version, count(*) AS n FROM news GROUP BY 1")
def _(spark, d):
    return _plain(news(spark, d)).groupBy("provider", "schema_version").agg(F.count("*").alias("n")).orderBy("provider", "schema_version")


@query("agg_provider_severity", f"WITH {NEWS} SELECT provider, severity, count(*) AS n FROM news GROUP BY 1, 2")
def _(spark, d):
    return _plain(news(spark, d)).groupBy("provider", "severity").agg(F.count("*").alias("n"))


@query("agg_window_severity", f"""WITH {NEWS} SELECT provider, severity, count(*) AS n FROM news WHERE greatest(published_at, updated_at) >= TIMESTAMP '1998-05-31 16:00:00' AND greatest(published_at, updated_at) < TIMESTAMP '1998-06-30 16:00:00' GROUP BY 1, 2""")
def _(spark, d):
    from ..functions.times import in_window, news_time, window_bounds

    n = _plain(news(spark, d)).where(in_window(news_time(C("published_at"), C("updated_at")), window_bounds(_t("1998-06-30 05:00:00"), 30)))
    return n.groupBy("provider", "severity").agg(F.count("*").alias("n"))


@query("agg_classification_status", "SELECT CASE p_partkey % 4 WHEN 0 THEN 'classified' WHEN 1 THEN 'unclassified' WHEN 2 THEN 'error' END AS status, count(*) AS n, count(*) FILTER (WHERE p_size > 25) AS large FROM part GROUP BY 1")
def _(spark, d):
    status = F.when(C("p_partkey") % 4 == 0, "classified").when(C("p_partkey") % 4 == 1, "unclassified").when(C("p_partkey") % 4 == 2, "error")
    return table(spark, d, "part").groupBy(status.alias("status")).agg(F.count("*").alias("n"), F.count_if(C("p_size") > 25).alias("large"))


@query("agg_failures", f"WITH {A.FAILURES} SELECT provider, phase, status_code, count(*) AS n, arg_min(identity, (updated_at, event_id)) AS first_identity FROM failures GROUP BY 1, 2, 3")
def _(spark, d):
    return A.failures(spark, d).groupBy("provider", "phase", "status_code").agg(F.count("*").alias("n"), F.min_by("identity", F.struct("updated_at", "event_id")).alias("first_identity"))


@query("agg_run_summary", f"WITH {A.OBSERVATIONS} SELECT strftime(observed_at, '%Y-%m-%d') AS run, count(*) AS fetched, count(*) FILTER (WHERE event_type = 'purchase') AS with_details, count(*) FILTER (WHERE event_type = 'signup') AS inserted, count(DISTINCT identity) AS identities FROM observations GROUP BY 1")
def _(spark, d):
    n = lambda kind: F.count_if(C("event_type") == kind)
    return A.observations(spark, d).groupBy(F.date_format("observed_at", "yyyy-MM-dd").alias("run")).agg(F.count("*").alias("fetched"), n("purchase").alias("with_details"), n("signup").alias("inserted"), F.count_distinct("identity").alias("identities"))


@query("sort_newest", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS day FROM orders")
def _(spark, d):
    day = F.when(C("o_orderkey") % 5 > 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, d, "orders").select("o_orderkey", day.alias("day")).orderBy(F.desc_nulls_last("day"), "o_orderkey").select("o_orderkey", F.coalesce("day", F.lit("")).alias("day"))


@query("sort_failures", f"WITH {A.FAILURES} SELECT provider, string_agg(identity, ',' ORDER BY identity) AS identities FROM (SELECT DISTINCT provider, identity FROM failures) GROUP BY 1")
def _(spark, d):
    return A.failures(spark, d).groupBy("provider").agg(F.array_join(F.array_sort(F.collect_set("identity")), ",").alias("identities"))


@query("set_union", "SELECT n_name AS name, n_nationkey AS key FROM nation UNION ALL SELECT s_name, s_suppkey FROM supplier")
def _(spark, d):
    return table(spark, d, "nation").select(C("n_name").alias("name"), C("n_nationkey").cast("long").alias("key")).unionByName(table(spark, d, "supplier").select(C("s_suppkey").alias("key"), C("s_name").alias("name")))


@query("set_except", "SELECT n_nationkey AS key FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_suppkey % 2 = 0")
def _(spark, d):
    return table(spark, d, "nation").select(C("n_nationkey").alias("key")).exceptAll(table(spark, d, "supplier").where("s_suppkey % 2 = 0").select(C("s_nationkey").alias("key")).distinct())


@query("set_intersect", "SELECT n_nationkey AS key FROM nation INTERSECT SELECT s_nationkey FROM supplier WHERE s_suppkey % 2 = 0")
def _(spark, d):
    return table(spark, d, "nation").select(C("n_nationkey").alias("key")).intersect(table(spark, d, "supplier").where("s_suppkey % 2 = 0").select(C("s_nationkey").alias("key")))


_KEY = "provider || '|' || phase || '|' || identity || '|' || url || '|' || substr(error, 1, 300)"


@query("alert_fresh", f"""WITH {A.FAILURES}, f AS (SELECT *, {_KEY} AS key FROM failures), s AS (SELECT key, max(updated_at) AS sent_at FROM f WHERE updated_at < TIMESTAMP '2024-01-15' GROUP BY 1)
    SELECT event_id, key, NOT coalesce(TIMESTAMP '2024-01-15' - sent_at >= INTERVAL 0 HOUR AND TIMESTAMP '2024-01-15' - sent_at < INTERVAL 48 HOUR, false) AS fresh FROM f LEFT JOIN s USING (key)""")
def _(spark, d):
    f = A.failures(spark, d)
    sent = f.where(C("updated_at") < _t("2024-01-15")).groupBy(M.failure_key().alias("key")).agg(F.max("updated_at").alias("sent_at"))
    return M.alert_fresh(f, sent, _t("2024-01-15"), 48).select("event_id", "key", "fresh")


@query("alert_runs")
def _(spark, d):
    f = A.failures(spark, d).withColumn("run", F.datediff(C("updated_at").cast("date"), F.lit("2024-01-01").cast("date")).cast("long")).withColumn("run_at", F.date_trunc("day", "updated_at"))
    return M.alert_runs(f, 48)


@query("alert_first_runs", f"WITH {A.FAILURES}, r AS (SELECT provider, min(date_trunc('day', updated_at)) AS d FROM failures GROUP BY 1) SELECT provider, count(DISTINCT {_KEY}) AS fresh, CAST(0 AS BIGINT) AS repeats, true AS alert FROM failures JOIN r USING (provider) WHERE date_trunc('day', updated_at) = d GROUP BY 1")
def _(spark, d):
    f = A.failures(spark, d).withColumn("run", F.datediff(C("updated_at").cast("date"), F.lit("2024-01-01").cast("date")).cast("long")).withColumn("run_at", F.date_trunc("day", "updated_at"))
    runs = M.alert_runs(f, 48)
    return runs.groupBy("provider").agg(F.min(F.struct("run", "fresh", "repeats", "alert")).alias("r")).select("provider", "r.fresh", "r.repeats", "r.alert")


@query("alert_report", f"""WITH {A.FAILURES}, r AS (SELECT *, row_number() OVER (PARTITION BY provider ORDER BY identity, event_id) AS rn, count(*) OVER (PARTITION BY provider) AS total FROM failures)
    SELECT provider, CAST(rn AS INTEGER) AS rn, event_id, CASE WHEN length(error) > 300 THEN substr(error, 1, 300) || '...' ELSE error END AS error, CASE WHEN event_id % 2 = 0 THEN 'new' ELSE 'repeat' END AS mark, greatest(total - 50, 0) AS left_out FROM r WHERE rn <= 50""")
def _(spark, d):
    f = A.failures(spark, d).withColumn("fresh", C("event_id") % 2 == 0)
    return M.alert_report(f, "provider", ["identity", "event_id"]).select("provider", "rn", "event_id", "error", "mark", "left_out")


@query("listing_totals", "SELECT page_id, greatest(page_id % 30, CAST(ceil(length(html) / 500.0) AS BIGINT), 1) AS pages FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", M.listing_totals(F.length("html"), F.lit(500), F.array(C("page_id") % 30, F.lit(None).cast("long"), F.lit(0).cast("long"))).alias("pages"))


# --- classification -------------------------------------------------------------------------------


def _cpe(k):
    name = F.replace("p_name", F.lit(" "), F.lit("_"))
    vendor = F.lower(F.replace("p_brand", F.lit("#"), F.lit("_")))
    return F.when(k % 2 == 0, F.concat(F.lit("cpe:2.3:a:"), vendor, F.lit(":"), name, F.lit(":1.0:*"))).otherwise(F.concat(F.lit("cpe:/o:"), vendor, F.lit(":"), name, F.lit(":1.0")))


_VENDOR = "lower(replace(p_brand, '#', ' '))"


@query("cpe_parse", f"SELECT p_partkey, {_VENDOR} AS vendor, p_name AS product FROM part")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", K.cpe_parse(_cpe(C("p_partkey"))).alias("p")).select("p_partkey", "p.vendor", "p.product")


def _records(spark, d):
    k = C("p_partkey")
    vendor = F.lower(F.replace("p_brand", F.lit("#"), F.lit(" ")))
    pair = F.struct(vendor.alias("vendor"), C("p_name").alias("product"))
    return table(spark, d, "part").select(
        k.alias("id"), F.when(k % 4 < 2, F.array(_cpe(k))).otherwise(F.array().cast("array<string>")).alias("cpes"), F.when(k % 3 == 0, F.array(pair)).otherwise(F.array().cast("array<struct<vendor:string,product:string>>")).alias("affected"),
        F.concat(F.lit("Flaw in "), F.upper("p_name")).alias("title"), F.when(k % 5 == 0, " ").otherwise(C("p_type")).alias("description"),
    )


@query("cls_evidence", f"""SELECT p_partkey AS id, 'configurations' AS source, {_VENDOR} AS vendor, p_name AS product, CAST(NULL AS VARCHAR) AS text FROM part WHERE p_partkey % 4 < 2 UNION ALL SELECT p_partkey, 'affected', {_VENDOR}, p_name, NULL FROM part WHERE p_partkey % 3 = 0
    UNION ALL SELECT p_partkey, 'title', NULL, NULL, 'Flaw in ' || upper(p_name) FROM part UNION ALL SELECT p_partkey, 'description', NULL, NULL, p_type FROM part WHERE p_partkey % 5 > 0""")
def _(spark, d):
    return K.evidence(_records(spark, d)).select("id", "source", "vendor", "product", "text")


def _dictionary(spark, d):
    """Every second brand; a product with a CPE of its own."""
    p = table(spark, d, "part").where("p_partkey % 2 = 0")
    vendor = F.lower(F.replace("p_brand", F.lit("#"), F.lit(" ")))
    return p.groupBy(vendor.alias("vendor"), C("p_name").alias("product")).agg(F.min(_cpe(C("p_partkey"))).alias("cpe"))


_DICT = f"""dict AS (SELECT {_VENDOR} AS vendor, p_name AS product, min('cpe:2.3:a:' || replace({_VENDOR}, ' ', '_') || ':' || replace(p_name, ' ', '_') || ':1.0:*') AS cpe FROM part WHERE p_partkey % 2 = 0 GROUP BY 1, 2),
    p AS (SELECT p_partkey AS id, {_VENDOR} AS vendor, p_name AS product FROM part),
    hits AS (SELECT id, 0 AS priority, d.vendor, d.product FROM p JOIN dict d ON d.vendor = p.vendor AND d.product = p.product WHERE id % 3 = 0 UNION ALL SELECT id, 1, d.vendor, d.product FROM p JOIN dict d ON d.vendor = p.vendor AND d.product = p.product WHERE id % 4 = 0
      UNION ALL SELECT id, 2, d.vendor, d.product FROM p JOIN dict d ON d.product = p.product),
    best AS (SELECT id, min((priority, vendor, product)) AS b FROM hits GROUP BY id)"""


@query("cls_dictionary", f"WITH {_DICT} SELECT id, (['vendor_product', 'cpe', 'text'])[b[1] + 1] AS match_type, b[2] AS vendor, b[3] AS product FROM best")
def _(spark, d):
    return K.dictionary_match(K.evidence(_records(spark, d)), _dictionary(spark, d))


@query("cls_zero_shot", f"WITH {_NEAR} SELECT id, CASE WHEN id % 10 = 0 THEN 1.0 ELSE round(score, 4) END AS confidence, CASE WHEN id % 10 = 0 OR score >= 0.5 THEN 'classified' ELSE 'unclassified' END AS status, CASE WHEN id % 10 > 0 AND score < 0.5 THEN candidate END AS candidate FROM n")
def _(spark, d):
    near = _near(spark, d, 0.5)
    exact = near.where("id % 10 = 0").select("id", F.lit(-1).alias("name"))
    return K.zero_shot(exact, near.drop("name"), 0.5).select("id", F.round("confidence", 4).alias("confidence"), "status", "candidate")


def _states(spark, d):
    k = C("p_partkey")
    return table(spark, d, "part").select(
        k.alias("id"), F.when(k % 5 == 0, "nvd").otherwise("cve").alias("provider"), F.when(k % 3 == 0, "unclassified").when(k % 3 == 1, "classified").otherwise("failed").alias("status"), F.when(k % 2 == 0, "v7").otherwise("v6").alias("seen_version")
    )


@query("cls_select", "SELECT CASE WHEN p_partkey % 5 = 0 THEN 'not_cve' WHEN p_partkey % 3 = 0 AND p_partkey % 2 = 0 THEN 'already_unclassified' END AS skip_reason, count(*) AS n FROM part GROUP BY 1")
def _(spark, d):
    return K.select_rows(_states(spark, d), "v7").groupBy("skip_reason").agg(F.count("*").alias("n"))


_S = "p_partkey % 5"


@query("cls_shape", f"""SELECT p_partkey, CASE {_S} WHEN 0 THEN 'classified' WHEN 1 THEN 'unclassified' WHEN 2 THEN 'failed' WHEN 3 THEN 'queued' END AS status, CASE WHEN {_S} = 0 THEN p_brand END AS vendor, CASE WHEN {_S} = 0 THEN 'cpe:' || p_partkey END AS cpe, CASE WHEN {_S} < 2 THEN CAST(p_size AS DOUBLE) END AS confidence,
    CASE WHEN {_S} < 4 THEN CAST(p_partkey % 3 AS INTEGER) END AS attempts, CASE WHEN {_S} = 1 THEN 'low' END AS reason, CASE WHEN {_S} IN (0, 2, 3) THEN 'boom' END AS error, CASE WHEN {_S} IN (0, 2, 3) AND p_partkey % 2 = 1 THEN '2024-01-01 00:00:00.000' END AS queued, CASE WHEN {_S} = 1 THEN '2024-01-01 16:00:00.000' END AS updated,
    CASE WHEN {_S} = 1 THEN p_brand END AS c_vendor, CASE WHEN {_S} = 1 THEN p_type END AS c_product, CASE WHEN {_S} = 1 THEN 'cpe:' || p_partkey END AS c_cpe, CASE WHEN {_S} < 4 THEN 'tax1' END AS version, CASE WHEN {_S} < 4 THEN 2 END AS classifier_version FROM part""")
def _(spark, d):
    k = C("p_partkey")
    own = F.struct(F.lit(None).cast("string").alias("vendor"), C("p_type").alias("product"), F.lit("").alias("cpe"))
    cols = {
        "vendor": C("p_brand"), "best_vendor": C("p_brand"), "product": C("p_name"), "candidate": own, "taxonomy_version": F.lit("tax1"), "classified_at": F.lit("2024-01-02"), "reason": F.lit("low"), "error": F.lit("boom"),
        "cpe": F.concat(F.lit("cpe:"), k.cast("string")), "confidence": C("p_size"), "attempts": k % 3, "queued_at": F.when(k % 2 == 0, "soon").otherwise("2024-01-01T00:00:00Z"),
    }
    status = F.element_at(F.array(*[F.lit(s) for s in ("classified", "unclassified", "failed", "queued", "odd")]), (k % 5 + 1).cast("int"))
    made = table(spark, d, "part").select("p_partkey", K.shape(status, cols).alias("s"))
    return made.select(
        "p_partkey", "s.status", "s.vendor", "s.cpe", "s.confidence", "s.attempts", "s.reason", "s.error", stamp(C("s.queued_at")).alias("queued"), stamp(C("s.updated_at")).alias("updated"), C("s.candidate.vendor").alias("c_vendor"), C("s.candidate.product").alias("c_product"),
        C("s.candidate.cpe").alias("c_cpe"), C("s.dictionary_version").alias("version"), "s.classifier_version",
    )


def _run_records(spark, d, whole=False):
    """Parts as stored records: one in five of another provider, one in seven with a title that names nothing, a third already classified, another third unclassified by this dictionary or the last.  ``whole``: with their descriptions, and the last third failed before."""
    k, vendor = C("p_partkey"), F.lower(F.replace("p_brand", F.lit("#"), F.lit(" ")))
    records = _records(spark, d).withColumn("title", F.when(C("id") % 7 == 0, "Flaw").otherwise(C("title"))).withColumn("description", C("description") if whole else F.lit("none"))
    old = table(spark, d, "part").select(k.alias("id"), F.when(k % 3 == 1, "classified").when(k % 3 == 0, "unclassified").otherwise("failed" if whole else None).alias("status"), vendor.alias("vendor"), "p_name", _cpe(k).alias("cpe"), F.when(k % 2 == 0, "v7").otherwise("v6").alias("version"), (k % 5).alias("m"))
    stored = K.shape(C("status"), {"vendor": C("vendor"), "product": C("p_name"), "cpe": C("cpe"), "confidence": F.lit("1.0"), "method": F.lit("dictionary"), "reason": F.lit("dictionary miss"), "dictionary_version": C("version"), "updated_at": F.lit("2024-01-01"), "candidate": F.struct(*[F.lit("").alias(x) for x in ("vendor", "product", "cpe")])})
    old = old.select("id", F.when(C("m") == 0, "nvd").otherwise("cve").alias("provider"), stored.alias("classification"))
    return records.join(old, "id")


def _run_vectors(spark, d):
    """Two-dimensional vectors of parts and of dictionary entries."""
    k = C("p_partkey")
    p = table(spark, d, "part").select(k, "p_name", "p_brand", F.array(C("p_size").cast("double"), (k % 50 + 1).cast("double")).alias("v"))
    entries = _dictionary(spark, d).select("cpe").join(p.where(k % 2 == 0).select(_cpe(k).alias("cpe"), k, "v"), "cpe").groupBy("cpe").agg(F.min_by("v", "p_partkey").alias("u"))
    return p.select(k.alias("id"), "v"), entries


def _run(spark, d, whole=False, **options):
    return K.reclassify(_run_records(spark, d, whole), _dictionary(spark, d), "v7", F.lit("2024-02-01T00:00:00Z"), _run_vectors(spark, d), 0.9999, **options)


_RUN = f"""{_DICT.split("hits AS")[0]}
    r AS (SELECT p.*, p_size AS x, id % 50 + 1 AS y FROM p JOIN part ON p_partkey = id WHERE id % 5 > 0),
    settled AS (SELECT r.id, CASE WHEN id % 3 = 0 AND f.cpe IS NOT NULL THEN 'vendor_product' WHEN id % 4 < 2 AND f.cpe IS NOT NULL THEN 'cpe' WHEN id % 7 > 0 AND t.m IS NOT NULL THEN 'text' END AS match_type, f.vendor AS fv, f.product AS fp, f.cpe AS fc, t.m
      FROM r LEFT JOIN dict f ON f.vendor = r.vendor AND f.product = r.product LEFT JOIN (SELECT product, min((vendor, product, cpe)) AS m FROM dict GROUP BY product) t ON t.product = r.product),
    e AS (SELECT dict.vendor, dict.product, dict.cpe, arg_min(p_size, p_partkey) AS x, arg_min(p_partkey % 50 + 1, p_partkey) AS y FROM dict JOIN part ON p_partkey % 2 = 0 AND {_VENDOR} = dict.vendor AND p_name = dict.product GROUP BY 1, 2, 3),
    s AS (SELECT r.id, round((r.x * e.x + r.y * e.y) / (sqrt(r.x * r.x + r.y * r.y) * sqrt(e.x * e.x + e.y * e.y)), 6) AS score, e.vendor, e.product, e.cpe FROM r JOIN settled USING (id), e WHERE match_type IS NULL),
    z AS (SELECT id, max((score, cpe, vendor, product)) AS b FROM s GROUP BY id),
    done AS (SELECT id, coalesce(match_type, CASE WHEN b[1] >= 0.9999 THEN 'zero_shot' END) AS match_type, CASE WHEN match_type IN ('vendor_product', 'cpe') THEN fv WHEN match_type = 'text' THEN m[1] WHEN b[1] >= 0.9999 THEN b[3] END AS vendor,
      CASE WHEN match_type IN ('vendor_product', 'cpe') THEN fp WHEN match_type = 'text' THEN m[2] WHEN b[1] >= 0.9999 THEN b[4] END AS product, CASE WHEN match_type IN ('vendor_product', 'cpe') THEN fc WHEN match_type = 'text' THEN m[3] WHEN b[1] >= 0.9999 THEN b[2] END AS cpe,
      CASE WHEN match_type IS NULL AND b[1] < 0.9999 THEN b[2] END AS candidate, CASE WHEN match_type IS NULL THEN b[1] ELSE 1.0 END AS confidence FROM settled LEFT JOIN z USING (id)),
    judged AS (SELECT done.*, id % 3 = 1 AND id % 2 = 0 AND match_type IN ('vendor_product', 'cpe', 'text') AND done.vendor = p.vendor AND done.cpe = CASE WHEN id % 2 = 0 THEN 'cpe:2.3:a:' ELSE 'cpe:/o:' END || replace(p.vendor, ' ', '_') || ':' || replace(p.product, ' ', '_') || CASE WHEN id % 2 = 0 THEN ':1.0:*' ELSE ':1.0' END AS same
      FROM done JOIN p USING (id))"""


@query("reclassify", f"""WITH {_RUN} SELECT count(*) AS scanned, count(*) FILTER (WHERE same IS NOT TRUE) AS updated, count(*) FILTER (WHERE same IS TRUE) AS unchanged, count(match_type) AS classified, count(*) FILTER (WHERE match_type IS NULL) AS unclassified, CAST(0 AS BIGINT) AS errors FROM judged""")
def _(spark, d):
    return _run(spark, d, whole=True).stats


@query("reclassify_rows", f"WITH {_RUN} SELECT id, match_type, CASE WHEN match_type IS NULL THEN 'unclassified' ELSE 'classified' END AS status, vendor, product, cpe, candidate, round(confidence, 4) AS confidence, CASE WHEN match_type IS NULL THEN 'confidence below threshold' END AS reason, NOT same AS changed FROM judged")
def _(spark, d):
    c = "classification."
    return _run(spark, d).rows.select("id", "match_type", c + "status", c + "vendor", c + "product", c + "cpe", C(c + "candidate.cpe").alias("candidate"), F.round(c + "confidence", 4).alias("confidence"), c + "reason", "changed")


@query("reclassify_incremental", f"""WITH {_RUN} SELECT count(*) AS scanned, count(*) FILTER (WHERE NOT same) AS updated, count(*) FILTER (WHERE same) AS unchanged, count(match_type) AS classified, count(*) FILTER (WHERE match_type IS NULL) AS unclassified, CAST(0 AS BIGINT) AS errors FROM judged
    WHERE id % 6 > 0""")
def _(spark, d):
    return _run(spark, d, incremental=True).stats


@query("reclassify_write", f"""WITH {_RUN}, j AS (SELECT p.id, CASE WHEN p.id % 5 = 0 OR same THEN CASE p.id % 3 WHEN 1 THEN 'classified' WHEN 0 THEN 'unclassified' END WHEN match_type IS NULL THEN 'unclassified' ELSE 'classified' END AS status FROM p LEFT JOIN judged USING (id))
    SELECT coalesce(status, 'none') AS status, count(*) AS n FROM j GROUP BY 1""")
def _(spark, d):
    return K.with_classification(_run_records(spark, d), _run(spark, d)).groupBy(F.coalesce("classification.status", F.lit("none")).alias("status")).agg(F.count("*").alias("n"))
