"""Catch-up as Structured Streaming: landed rows in, an upserted table out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.times import hours, in_window, window_bounds
from ..operators.monitor import is_fresh, kept_for, run_key
from ..sources.landing import shared_path


def read_files(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 10) -> DataFrame:
    """Files as they land; positions are kept by the query's checkpoint."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def window_gate(rows: DataFrame, t: str, now: Column, days: int) -> DataFrame:
    """Only rows inside the calendar window; an unknown time is outside."""
    return rows.where(in_window(F.col(t), window_bounds(now, days)))


def dedup(rows: DataFrame, key: list[str], t: str, late: str) -> DataFrame:
    """The first row of a key; state is kept for ``late`` behind the newest time."""
    return rows.withColumn("_t", F.col(t).cast("timestamp")).withWatermark("_t", late).dropDuplicatesWithinWatermark(key).drop("_t")


def latest(rows: DataFrame, key: str, t: str) -> DataFrame:
    """The row with the newest observation of each key (update or complete mode)."""
    return rows.groupBy(key).agg(F.max(F.struct(F.col(t), F.struct(*[F.col(c) for c in rows.columns if c not in (key, t)]).alias("row"))).alias("top")).select(key, f"top.{t}", "top.row.*")


def daily(rows: DataFrame, t: str, late: str = "7 days") -> DataFrame:
    """Rows per Hong Kong day."""
    w = F.window(F.col("_t"), "1 day", "1 day", "16 hours")
    timed = rows.withColumn("_t", F.col(t).cast("timestamp")).withWatermark("_t", late)
    return timed.groupBy(w.alias("w")).agg(F.count("*").alias("n")).select(F.date_format(F.col("w.start").cast("timestamp_ntz") + hours(8), "yyyy-MM-dd").alias("day"), "n")


def sliding(rows: DataFrame, t: str, width: str = "7 days", step: str = "1 day", late: str = "7 days") -> DataFrame:
    timed = rows.withColumn("_t", F.col(t).cast("timestamp")).withWatermark("_t", late)
    return timed.groupBy(F.window("_t", width, step).alias("w")).agg(F.count("*").alias("n")).select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


def sessions(rows: DataFrame, key: str, t: str, gap: str, late: str = "1 day") -> DataFrame:
    timed = rows.withColumn("_t", F.col(t).cast("timestamp")).withWatermark("_t", late)
    return timed.groupBy(key, F.session_window("_t", gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


def drain(stream: DataFrame, mode: str, sink: Callable[[DataFrame, int], None] | None = None) -> DataFrame | None:
    """Run a stream over everything that is there.  With ``sink`` each batch goes to it; else rows go to files (append) or memory."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    w = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", shared_path(spark, "stream-checkpoint"))
    if sink is not None:
        done(w.foreachBatch(sink).start())
        return None
    if mode == "append":
        path = shared_path(spark, "stream-out")
        done(w.format("parquet").option("path", path).start())
        return spark.read.schema(stream.schema).parquet(path)
    holder = shared_path(spark, "stream-result")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.parquet(f"{holder}/v={number}")

    done(w.foreachBatch(keep).start())
    every = spark.read.option("basePath", holder).parquet(f"{holder}/v=*")
    newest = every.agg(F.max("v")).first()[0]
    return every.where(F.col("v") == newest).drop("v")


def done(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


class ChangeLog:
    """Rows of each micro-batch in a folder of their own, read together; what they mean is a view over them.

    A batch writes its own rows and nothing else.  It counts once a row of the commit log names it, so a write
    that broke off is never read, and one that comes again, as after a restart, changes nothing.  With the
    same ``root`` a restarted driver goes on where it was.  When the rows since the last compaction are as many as
    it holds, ``collapse`` of all rows is written as a new base, so what is written in all stays in proportion to the rows that came.
    """

    COMMIT = "batch long, base boolean, rows long"

    def __init__(self, spark: SparkSession, schema: str, collapse: Callable[[DataFrame], DataFrame], root: str | None = None, least: int = 100_000):
        self.spark, self.schema, self.collapse, self.root, self.least = spark, schema, collapse, root or shared_path(spark, "log"), least

    def commits(self) -> tuple[tuple[int, int], dict[int, int]]:
        """((batch, rows) of the newest base, rows by batch since then)."""
        try:
            rows = self.spark.read.schema(self.COMMIT).parquet(f"{self.root}/commits").collect()  # a row a batch
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        base = max(((r.batch, r.rows) for r in rows if r.base), default=(-1, 0))
        return base, {r.batch: r.rows for r in rows if not r.base and r.batch > base[0]}

    def _write(self, df: DataFrame, batch: int, base: bool) -> None:
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{self.root}/{'base' if base else 'batch'}-{batch}")
        self.spark.createDataFrame([(batch, base, seen.get["n"])], self.COMMIT).write.mode("append").parquet(f"{self.root}/commits")

    def rows(self) -> DataFrame:
        """All rows that count, as they came."""
        (base, _), batches = self.commits()
        paths = [f"{self.root}/base-{base}"] * (base >= 0) + [f"{self.root}/batch-{b}" for b in sorted(batches)]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        """The view: what the rows come to."""
        return self.collapse(self.rows())

    def append(self, df: DataFrame, batch: int) -> None:
        (base, held), batches = self.commits()
        if batch <= max([base, *batches]):
            return
        self._write(df, batch, False)
        if (new := sum(self.commits()[1].values())) >= max(held, self.least) or new and len(batches) >= 200:
            self._write(self.read(), batch, True)


def latest_of(rows: DataFrame, key: str, t: str) -> DataFrame:
    """Per key the row with the newest observation; of equal times the largest row."""
    rest = [c for c in rows.columns if c not in (key, t)]
    return rows.groupBy(key).agg(F.max(F.struct(F.col(t), *[F.col(c) for c in rest])).alias("top")).select(key, "top.*").select(*rows.columns)


def upsert_log(spark: SparkSession, schema: str, key: str, t: str, root: str | None = None, least: int = 100_000) -> ChangeLog:
    """A table in which per key the newest observation wins, whatever the order of batches: an older one that was queued never hides a newer one."""
    return ChangeLog(spark, schema, lambda rows: latest_of(rows, key, t), root, least)


def session_log(spark: SparkSession, key: str, gap: Column, root: str | None = None, least: int = 100_000) -> ChangeLog:
    """Sessions as rows (key, start, last, n): what lies within ``gap`` of a row of the same key is in its session, however late it comes.

    ``key`` is a name with its type.  Each batch writes its own sessions, the view joins those that meet; no state is
    read and no session is written again by the batches that follow, save when the log is compacted.
    """
    name = key.split()[0]

    def collapse(rows: DataFrame) -> DataFrame:
        before = Window.partitionBy(name).orderBy("start", "last")
        reach = rows.withColumn("reach", F.max("last").over(before.rowsBetween(Window.unboundedPreceding, -1)))
        first = F.when(F.col("reach").isNull() | (F.col("start") > F.col("reach") + gap), 1).otherwise(0)
        marked = reach.withColumn("session", F.sum(first).over(before.rowsBetween(Window.unboundedPreceding, 0)))
        return marked.groupBy(name, "session").agg(F.min("start").alias("start"), F.max("last").alias("last"), F.sum("n").alias("n")).drop("session")

    return ChangeLog(spark, f"{key}, start timestamp_ntz, last timestamp_ntz, n long", collapse, root, least)


def session_rows(rows: DataFrame, key: str, t: str) -> DataFrame:
    """Each row with a time as a session of its own, for ``session_log``."""
    return rows.where(F.col(t).isNotNull()).select(key, F.col(t).alias("start"), F.col(t).alias("last"), F.lit(1).cast("long").alias("n"))


def log_sink(log: ChangeLog) -> Callable[[DataFrame, int], None]:
    """foreachBatch: each batch, collapsed, is appended to the log."""
    names = [f.name for f in log.spark.createDataFrame([], log.schema).schema]
    return lambda batch, number: log.append(log.collapse(batch.select(*names)), number)


RETRIES = "identity string, failed_at timestamp_ntz, ok_at timestamp_ntz"


def retry_log(spark: SparkSession, ttl_days: int, root: str | None = None, least: int = 100_000) -> ChangeLog:
    """RETRIES: the last failure and the last success of each identity.

    What is ``ttl_days`` older than the newest row is forgotten, successes too, so the table does not grow for ever.
    """

    def collapse(rows: DataFrame) -> DataFrame:
        both = rows.groupBy("identity").agg(F.max("failed_at").alias("failed_at"), F.max("ok_at").alias("ok_at"))
        oldest = rows.agg((F.max(F.greatest("failed_at", "ok_at")) - F.make_dt_interval(F.lit(ttl_days))).alias("oldest"))
        kept = both.crossJoin(F.broadcast(oldest))  # one row
        kept = kept.select("identity", *[F.when(F.col(c) >= F.col("oldest"), F.col(c)).alias(c) for c in ("failed_at", "ok_at")])
        return kept.where("failed_at is not null or ok_at is not null")

    return ChangeLog(spark, RETRIES, collapse, root, least)


def retry_rows(rows: DataFrame) -> DataFrame:
    """identity, at, failed as RETRIES rows."""
    return rows.select("identity", F.when(F.col("failed"), F.col("at")).alias("failed_at"), F.when(~F.col("failed"), F.col("at")).alias("ok_at"))


def acknowledged(log: ChangeLog, progress: ChangeLog, source: str, t: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch: rows first, and only once they are committed how far their source has come (a row source, until in ``progress``).

    A batch whose write fails leaves the progress where it was, and comes again with the same number.
    """
    write = log_sink(log)

    def both(batch: DataFrame, number: int) -> None:
        write(batch, number)
        progress.append(batch.groupBy(F.col(source).alias("source")).agg(F.max(t).alias("until")), number)

    return both


PROGRESS = "source string, until timestamp_ntz"


def progress_log(spark: SparkSession, root: str | None = None) -> ChangeLog:
    """PROGRESS: the newest committed time of each source; it never goes back."""
    return ChangeLog(spark, PROGRESS, lambda rows: rows.groupBy("source").agg(F.max("until").alias("until")), root)


def gated(sink: Callable[[DataFrame, int], None], t: str, days: int, clock: Callable[[DataFrame], Column] | None = None) -> Callable[[DataFrame, int], None]:
    """foreachBatch: the calendar window of each batch is that of its own time, so it moves while the stream runs.

    ``clock`` gives the time of a batch; without it that is when the batch runs.
    """
    now = clock or (lambda _: F.current_timestamp().cast("timestamp_ntz"))
    return lambda batch, number: sink(window_gate(batch, t, now(batch), days), number)


def waiting(retries: DataFrame) -> DataFrame:
    """identity and failed_at of what failed and has not succeeded since."""
    return retries.where("failed_at is not null and (ok_at is null or ok_at < failed_at)").select("identity", "failed_at")


ALERT_OUT = "provider string, run long, fresh long, repeats long, alert boolean, kept long"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class AlertProcessor(StatefulProcessor):
    """One provider: what was sent when, a row a failure key; the waiting runs, a row a run; which runs are due when, a row a time.

    So no state row grows with the number of runs, and what is no longer remembered is removed row by row.
    """

    def __init__(self, repeat_hours: int):
        self.repeat_hours = repeat_hours

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sent = handle.getMapState("sent", "key string", "at long")
        self.waiting = handle.getMapState("waiting", "run long", "keys array<string>, delivered boolean")
        self.due = handle.getMapState("due", "at long", "runs array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            for (run, at), part in batch.dropna(subset=["run"]).groupby(["run", "run_at"]):
                at, held = int(at.timestamp() * 1000), self.waiting.getValue((int(run),))
                keys, delivered = (set(held[0]), held[1]) if held else (set(), True)
                self.waiting.updateValue((int(run),), (sorted(keys | set(part["key"].dropna())), bool(delivered and part["delivered"].all())))
                runs = self.due.getValue((at,))
                if not runs:
                    self.handle.registerTimer(at)
                self.due.updateValue((at,), (sorted({int(run), *(runs[0] if runs else [])}),))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        now, time, out = _utc(at), _utc, []
        for run in self.due.getValue((at,))[0]:
            keys, delivered = self.waiting.getValue((run,))
            before = [self.sent.getValue((k,)) for k in keys]
            fresh = sum(is_fresh(time(b[0]) if b else None, now, self.repeat_hours) for b in before)
            if fresh and delivered:
                for k in keys:
                    self.sent.updateValue((k,), (at,))
            every = [(k, then) for (k,), (then,) in self.sent.iterator()]
            gone = [k for k, then in every if now - time(then) > kept_for(self.repeat_hours)]
            for k in gone:
                self.sent.removeKey((k,))
            self.waiting.removeKey((run,))
            out.append((key[0], run, fresh, len(keys) - fresh, bool(fresh and delivered), len(every) - len(gone)))
        self.due.removeKey((at,))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in ALERT_OUT.split(", ")])

    def close(self) -> None:
        pass


def _utc(ms: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=ms)


def alert_stream(failures: DataFrame, repeat_hours: int, late: str = "1 day") -> DataFrame:
    """failures(provider, run, run_at, phase, identity, url, error[, delivered]) -> one row per run.

    A run waits in the state of its provider until the watermark, ``late`` behind the newest run, has
    passed it; timers then fold runs in order of time.  So the order in which files and batches arrive
    does not matter within ``late``.  A row with ``delivered`` false says that the alert of its run was not
    sent; if it comes before the run is folded, the run marks nothing as sent and its failures stay
    fresh.  A row without a run only moves the watermark, as a source that is idle or at its end sends it.
    The query must be started with the RocksDB state store (``drain`` does so).
    """
    delivered = F.coalesce(F.col("delivered"), F.lit(True)) if "delivered" in failures.columns else F.lit(True)
    keyed = failures.select("provider", "run", F.col("run_at").cast("timestamp").alias("run_at"), run_key().alias("key"), delivered.alias("delivered")).withWatermark("run_at", late)
    return keyed.groupBy("provider").transformWithStateInPandas(AlertProcessor(repeat_hours), ALERT_OUT, "append", "EventTime")
