"""Advisory-shaped inputs derived from the test tables by integer arithmetic, and the same as SQL.

Every adapter exists twice: as a DataFrame and as a SQL common table expression for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import table

PROVIDERS = ["cve", "nvd", "github_advisory", "msrc", "splunk", "wiz"]

#: Spark pattern and strftime pattern of the nine printed date forms; forms 0 to 5 carry a time, 0 and 1 an offset.
DATE_FORMS = [
    ("yyyy-MM-dd'T'HH:mm:ss'Z'", "%Y-%m-%dT%H:%M:%SZ"), ("yyyy-MM-dd'T'HH:mm:ss'+08:00'", "%Y-%m-%dT%H:%M:%S+08:00"),
    ("yyyy-MM-dd'T'HH:mm:ss", "%Y-%m-%dT%H:%M:%S"), ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"), ("yyyy/MM/dd HH:mm", "%Y/%m/%d %H:%M"),
    ("yyyy-MM-dd", "%Y-%m-%d"), ("yyyy.MM.dd", "%Y.%m.%d"), ("d MMM yyyy", "%-d %b %Y"), ("MMMM d, yyyy", "%B %-d, %Y"),
]


def printed(t: Column, form: Column) -> Column:
    out = F.when(form == 0, F.date_format(t, DATE_FORMS[0][0]))
    for k, (spark_form, _) in enumerate(DATE_FORMS[1:], 1):
        out = out.when(form == k, F.date_format(t, spark_form))
    return out


def printed_sql(t: str, form: str) -> str:
    return "CASE " + " ".join(f"WHEN {form} = {k} THEN strftime({t}, '{f}')" for k, (_, f) in enumerate(DATE_FORMS)) + " END"


def parsed_sql(t: str, form: str) -> str:
    """What reading the printed form back as Hong Kong time gives in UTC."""
    day, minute = f"date_trunc('day', {t})", f"date_trunc('minute', {t})"
    return (
        f"CASE WHEN {form} = 0 THEN {t} WHEN {form} IN (1, 2, 3) THEN {t} - INTERVAL 8 HOUR WHEN {form} = 4 THEN {minute} - INTERVAL 8 HOUR "
        f"ELSE CAST({day} AS TIMESTAMP) - INTERVAL 8 HOUR END"
    )


def adv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advisories as collected: one per order."""
    k, t = F.col("o_orderkey"), F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"), (F.col("o_orderkey") % 60).cast("int"))
    provider = F.element_at(F.array(*[F.lit(p) for p in PROVIDERS]), (k % 6 + 1).cast("int"))
    number = F.concat(F.lit("20"), F.lpad((k % 26).cast("string"), 2, "0"), F.lit("-"), (k + 10000).cast("string"))
    text = F.when(k % 11 == 0, "unknown").otherwise(printed(t, k % 9))
    return table(spark, sf_dir, "orders").select(
        k.alias("k"), provider.alias("provider"), F.when(k % 6 == 0, number).otherwise(F.concat(F.lit("ADV-"), k.cast("string"))).alias("code"),
        F.when(k % 2 == 0, F.concat(F.lit("cve-"), number)).when(k % 3 == 0, number).otherwise(F.concat(F.lit("CVE-"), number)).alias("cve_raw"),
        F.when(k % 10 == 0, "").otherwise(F.concat(F.lit("Advisory  "), k.cast("string"))).alias("title"),
        F.substring("o_orderpriority", 3, 20).alias("severity_raw"), text.alias("published_raw"), t.alias("published"),
        F.when(k % 4 == 0, printed(t + F.make_dt_interval(F.lit(3)), (k + 1) % 9)).alias("updated_raw"), (t + F.make_dt_interval(F.lit(3))).alias("edited"),
        (t + F.make_dt_interval(F.lit(5))).alias("observed_at"), F.concat(F.lit("https://adv.example.org/"), k.cast("string")).alias("url"),
        F.when(k % 3 == 0, F.concat(F.lit("https://adv.example.org/"), k.cast("string"))).otherwise(F.concat(F.lit("https://adv.example.org/d/"), k.cast("string"))).alias("detail_url"),
        F.when(k % 5 == 0, "new").when(k % 5 == 1, "updated").when(k % 5 == 2, "update").otherwise(F.col("o_orderstatus")).alias("status"),
        F.col("o_custkey").alias("cust"), F.round(F.col("o_totalprice") % 11, 1).alias("score"),
    )


_T = "o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60)"
ADV = f"""adv0 AS (SELECT o_orderkey AS k, {_T} AS published, {_T} + INTERVAL 3 DAY AS edited, {_T} + INTERVAL 5 DAY AS observed_at,
    '20' || lpad(CAST(o_orderkey % 26 AS VARCHAR), 2, '0') || '-' || CAST(o_orderkey + 10000 AS VARCHAR) AS number, o_orderstatus, o_orderpriority, o_custkey AS cust, o_totalprice FROM orders),
adv AS (SELECT k, (['cve','nvd','github_advisory','msrc','splunk','wiz'])[CAST(k % 6 AS INTEGER) + 1] AS provider,
    CASE WHEN k % 6 = 0 THEN number ELSE 'ADV-' || k END AS code, number,
    CASE WHEN k % 2 = 0 THEN 'cve-' || number WHEN k % 3 = 0 THEN number ELSE 'CVE-' || number END AS cve_raw,
    CASE WHEN k % 10 = 0 THEN '' ELSE 'Advisory  ' || k END AS title, substr(o_orderpriority, 3) AS severity_raw,
    CASE WHEN k % 11 = 0 THEN NULL ELSE {parsed_sql('published', '(k % 9)')} END AS published_at,
    CASE WHEN k % 4 = 0 THEN {parsed_sql('edited', '((k + 1) % 9)')} END AS updated_at,
    published, edited, observed_at, 'https://adv.example.org/' || k AS url,
    CASE WHEN k % 3 = 0 THEN 'https://adv.example.org/' || k ELSE 'https://adv.example.org/d/' || k END AS detail_url,
    CASE WHEN k % 5 = 0 THEN 'new' WHEN k % 5 = 1 THEN 'updated' WHEN k % 5 = 2 THEN 'update' ELSE o_orderstatus END AS status,
    CASE substr(o_orderpriority, 3) WHEN 'HIGH' THEN 'High' WHEN 'MEDIUM' THEN 'Medium' WHEN 'LOW' THEN 'Low' ELSE 'Unknown' END AS severity, cust, round(o_totalprice % 11, 1) AS score
    FROM adv0)"""


def stamp_sql(t: str) -> str:
    return f"strftime({t}, '%Y-%m-%d %H:%M:%S.') || lpad(CAST(CAST(extract('ms' FROM {t}) AS BIGINT) % 1000 AS VARCHAR), 3, '0')"


def adv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with up to four identifiers spliced in, in mixed case and one of them twice."""
    d = F.col("doc_id")
    number = F.concat(F.lit("2024-"), (d + 1000).cast("string"))
    ids = F.array(F.concat(F.lit("CVE-"), number), F.concat(F.lit("cve-"), number), F.concat(F.lit("(CVE-2023-"), (d + 2000).cast("string"), F.lit(")")), F.concat(F.lit("xCVE-2022-"), (d + 100000000).cast("string")))
    return table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.col("text").alias("plain"), F.concat_ws(" ", F.lit("See"), F.array_join(F.slice(ids, F.lit(1), (d % 5).cast("int")), " "), F.lit("and"), F.col("text")).alias("text")
    )


ADV_TEXT = """adv_text AS (SELECT doc_id, lang, text AS plain, 'See' || ' ' || array_to_string(list_slice(['CVE-2024-' || (doc_id + 1000), 'cve-2024-' || (doc_id + 1000),
    '(CVE-2023-' || (doc_id + 2000) || ')', 'xCVE-2022-' || (doc_id + 100000000)], 1, doc_id % 5), ' ') || ' and ' || text AS text FROM documents)"""


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed fetches from the error events."""
    e = F.col("event_id")
    status = F.element_at(F.array(*[F.lit(x) for x in (429, 500, 404, 503, 521, 400)]), (e % 7 + 1).cast("int"))
    return table(spark, sf_dir, "events").where("event_type = 'error'").select(
        "event_id", F.concat(F.lit("p"), (F.col("user_id") % 6).cast("string")).alias("provider"), F.when(e % 2 == 0, "list").otherwise("detail").alias("phase"),
        F.concat(F.lit("id"), (F.col("user_id") % 40).cast("string")).alias("identity"), F.concat(F.lit("https://x.example.org/"), (F.col("user_id") % 40).cast("string")).alias("url"),
        F.when(e % 7 < 3, F.element_at(F.array(*[F.lit(x) for x in (429, 404, 500)]), (e % 7 + 1).cast("int"))).alias("status_code"),
        F.when(e % 7 == 3, "HTTP 503 for page").when(e % 7 == 4, "Failed to fetch page").when(e % 7 == 5, "HTTP 404 for page").otherwise(F.concat(F.lit("boom "), F.repeat(F.lit("x"), ((e % 5) * 100).cast("int")))).alias("error"),
        F.col("ts").alias("updated_at"),
    )


FAILURES = """failures AS (SELECT event_id, 'p' || (user_id % 6) AS provider, CASE WHEN event_id % 2 = 0 THEN 'list' ELSE 'detail' END AS phase, 'id' || (user_id % 40) AS identity,
    'https://x.example.org/' || (user_id % 40) AS url, CASE event_id % 7 WHEN 0 THEN 429 WHEN 1 THEN 404 WHEN 2 THEN 500 END AS status_code,
    CASE event_id % 7 WHEN 3 THEN 'HTTP 503 for page' WHEN 4 THEN 'Failed to fetch page' WHEN 5 THEN 'HTTP 404 for page' ELSE 'boom ' || repeat('x', CAST((event_id % 5) * 100 AS INTEGER)) END AS error,
    ts AS updated_at FROM events WHERE event_type = 'error')"""


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch windows of each customer."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("provider"), F.col("o_orderdate").alias("since"), (F.col("o_orderdate") + F.make_dt_interval((F.col("o_orderkey") % 40).cast("int"))).alias("until")
    )


WINDOWS = "windows AS (SELECT o_custkey AS provider, o_orderdate AS since, o_orderdate + to_days(CAST(o_orderkey % 40 AS INTEGER)) AS until FROM orders)"


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows from events: identity, page and position, observation time, payload."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("id"), F.col("user_id").cast("string")).alias("identity"), F.floor(F.col("event_id") / 100).alias("page"), (F.col("event_id") % 100).alias("pos"),
        F.col("ts").alias("observed_at"), F.col("value").alias("value"), "event_type", F.get_json_object("props", "$.k").cast("long").alias("prop"),
    )


OBSERVATIONS = """observations AS (SELECT event_id, 'id' || user_id AS identity, CAST(event_id // 100 AS BIGINT) AS page, event_id % 100 AS pos, ts AS observed_at, value, event_type,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS prop FROM events)"""
