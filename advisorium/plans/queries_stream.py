"""Streaming queries over events cut into files; each one equals its batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import stamp
from ..sources.landing import shared_path
from ..streaming import stream as N
from . import adapters as A
from .queries_scalar import _IN, NOW
from .registry import query, table

C = F.col
FILES = 5
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def landed(spark, d, rows: DataFrame, t: str, by: str | None = None) -> str:
    """The rows as a few files in order of time."""
    path = shared_path(spark, "landed")
    part = rows.repartitionByRange(FILES, by or t)
    part.sortWithinPartitions(t).write.parquet(path)
    return path


def _events(spark, d):
    e = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return N.read_files(spark, landed(spark, d, e, "ts"), EVENTS, 1)


@query("stream_ingest", f"SELECT event_id, {A.stamp_sql('ts')} AS ts, user_id FROM events")
def _(spark, d):
    return N.drain(_events(spark, d), "append").select("event_id", stamp(C("ts")).alias("ts"), "user_id")


@query("stream_window_gate", f"SELECT event_id FROM events WHERE {_IN}")
def _(spark, d):
    return N.drain(N.window_gate(_events(spark, d), "ts", F.lit(NOW).cast("timestamp_ntz"), 7), "append").select("event_id")


@query("stream_dedup", "SELECT user_id, event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY 1, 2")
def _(spark, d):
    once = N.dedup(_events(spark, d), ["user_id", "event_type"], "ts", "60 days")
    return N.drain(once, "append").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("stream_latest", "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) IS NOT NULL AS seen FROM events GROUP BY 1")
def _(spark, d):
    best = N.latest(_events(spark, d).select("user_id", "ts", "event_id"), "user_id", "ts")
    return N.drain(best, "complete").select("user_id", "event_id", C("ts").isNotNull().alias("seen"))


@query("stream_upsert", f"SELECT user_id, {A.stamp_sql('max(ts)')} AS ts, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1")
def _(spark, d):
    store = N.upsert_log(spark, "user_id long, ts timestamp_ntz, event_id long, value double", "user_id", "ts")
    N.drain(_events(spark, d), "append", N.log_sink(store))
    return store.read().select("user_id", stamp(C("ts")).alias("ts"), "value")


@query("stream_alert")
def _(spark, d):
    f = A.failures(spark, d).withColumn("run", F.datediff(C("updated_at").cast("date"), F.lit("2024-01-01").cast("date")).cast("long")).withColumn("run_at", F.date_trunc("day", "updated_at"))
    cols = "provider string, run long, run_at timestamp_ntz, phase string, identity string, url string, error string"
    names = [c.split()[0] for c in cols.split(", ")]
    path = landed(spark, d, f.select(*names), "run_at", by="run")
    ends = f.groupBy("provider").agg((F.max("run_at") + F.make_dt_interval(F.lit(365))).alias("run_at"))  # at the end every source says how far it is
    ends.select("provider", F.lit(None).cast("long").alias("run"), "run_at", *[F.lit(None).cast("string").alias(c) for c in names[3:]]).coalesce(1).write.mode("append").parquet(path)
    return N.drain(N.alert_stream(N.read_files(spark, path, cols, 1), 48, late="180 days"), "append")


@query("stream_daily", "SELECT strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def _(spark, d):
    return N.drain(N.daily(_events(spark, d), "ts"), "complete")


@query("stream_sliding", "SELECT strftime(date_trunc('day', ts) - to_days(CAST(i AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM events, range(0, 7) AS t(i) GROUP BY 1")
def _(spark, d):
    return N.drain(N.sliding(_events(spark, d), "ts"), "complete")


@query("stream_sessions", """WITH a AS (SELECT user_id, ts, CASE WHEN epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) <= 21600 THEN 0 ELSE 1 END AS new FROM events),
    b AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM a) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM b GROUP BY user_id, s""")
def _(spark, d):
    log = N.session_log(spark, "user_id long", F.make_dt_interval(hours=F.lit(6)))
    N.drain(N.session_rows(_events(spark, d), "user_id", "ts"), "append", N.log_sink(log))
    return log.read().select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("stream_retry", """WITH f AS (SELECT user_id, max(ts) FILTER (WHERE event_type = 'error') AS failed_at, max(ts) FILTER (WHERE event_type = 'view') AS ok, (SELECT max(ts) FROM events) AS newest FROM events GROUP BY 1) SELECT 'id' || user_id AS identity FROM f WHERE failed_at IS NOT NULL AND (ok IS NULL OR ok < failed_at) AND failed_at >= newest - INTERVAL 7 DAY""")
def _(spark, d):
    store = N.retry_log(spark, 7)
    e = _events(spark, d).select(F.concat(F.lit("id"), C("user_id").cast("string")).alias("identity"), C("ts").alias("at"), (C("event_type") == "error").alias("failed"), "event_type")
    N.drain(N.retry_rows(e.where("event_type in ('error', 'view')")), "append", N.log_sink(store))
    return N.waiting(store.read()).select("identity")


@query("stream_progress", f"SELECT event_type AS source, {A.stamp_sql('max(ts)')} AS until, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def _(spark, d):
    """A table and, behind it, how far each source has been committed."""
    rows = N.upsert_log(spark, "key string, ts timestamp_ntz, event_type string, user_id long", "key", "ts")
    progress = N.progress_log(spark)
    e = _events(spark, d).select(F.concat_ws("|", "event_type", C("user_id").cast("string")).alias("key"), "ts", "event_type", "user_id")
    N.drain(e, "append", N.acknowledged(rows, progress, "event_type", "ts"))
    users = rows.read().groupBy(C("event_type").alias("source")).agg(F.count_distinct("user_id").alias("users"))
    return progress.read().join(users, "source").select("source", stamp(C("until")).alias("until"), "users")
