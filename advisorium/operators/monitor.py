"""Failure alerts with repeat suppression, run summaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Report limits.
REPORTED, ERROR_CHARS = 50, 300
ALERT_RUN = "provider string, run long, fresh long, repeats long, alert boolean, kept long"


def failure_key(error_chars: int = ERROR_CHARS) -> Column:
    """What makes two failures one alert."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return F.concat_ws("|", text("provider"), text("phase"), text("identity"), text("url"), F.substring(text("error"), 1, error_chars))


def run_key() -> Column:
    """The key of a failure; null for a row that only says something of its run."""
    return F.when(F.coalesce("phase", "identity", "url", "error").isNotNull(), failure_key())


def alert_fresh(failures: DataFrame, sent: DataFrame, now: Column, repeat_hours: int) -> DataFrame:
    """failures with key and fresh: never reported, or not within the repeat window before now."""
    j = failures.withColumn("key", failure_key()).join(sent.select("key", "sent_at"), "key", "left")
    age = now - F.col("sent_at")
    inside = (age >= F.make_dt_interval(F.lit(0))) & (age < F.make_dt_interval(F.lit(0), F.lit(repeat_hours)))
    return j.withColumn("fresh", ~F.coalesce(inside, F.lit(False))).drop("sent_at")


def crash_failures(crashes: DataFrame) -> DataFrame:
    """crashes(provider, run, run_at, kind, message) as failures with a key of their own: one for each provider and shortened error."""
    error = F.substring(F.concat_ws(": ", "kind", "message"), 1, ERROR_CHARS)
    none = F.lit(None).cast("string")
    return crashes.select("provider", "run", "run_at", F.lit("EXCEPTION").alias("phase"), none.alias("identity"), none.alias("url"), error.alias("error"))


def kept_for(repeat_hours: int) -> dt.timedelta:
    return dt.timedelta(days=max(7, 2 * repeat_hours))


def is_fresh(sent_at: dt.datetime | None, now: dt.datetime, repeat_hours: int) -> bool:
    """Never reported, or not within the repeat window before ``now``."""
    return sent_at is None or not dt.timedelta(0) <= now - sent_at < dt.timedelta(hours=repeat_hours)


def _fold(runs: Iterator[pd.DataFrame], repeat_hours: int) -> Iterator[pd.DataFrame]:
    """Runs sorted by provider and run: memory holds what one provider has sent within the time it is kept."""
    provider, sent = None, {}
    for batch in runs:
        out = []
        for row in batch.itertuples(index=False):
            if row.provider != provider:
                provider, sent = row.provider, {}
            now = row.run_at.to_pydatetime()
            fresh = sum(is_fresh(sent.get(k), now, repeat_hours) for k in row.keys)
            if fresh and row.delivered:
                sent.update(dict.fromkeys(row.keys, now))
            sent = {k: at for k, at in sent.items() if now - at <= kept_for(repeat_hours)}
            out.append((provider, row.run, fresh, len(row.keys) - fresh, bool(fresh and row.delivered), len(sent)))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in ALERT_RUN.split(", ")])


def _delivered(failures: DataFrame) -> Column:
    """Whether the alert of the row's run went out; without such a column all did."""
    return F.coalesce(F.col("delivered"), F.lit(True)) if "delivered" in failures.columns else F.lit(True)


def alert_runs(failures: DataFrame, repeat_hours: int) -> DataFrame:
    """failures(provider, run, run_at, ...) -> per run what is fresh, repeated and alerted, and how many keys are remembered.

    A run with a fresh failure marks all its failures as sent, unless a row of it has ``delivered``
    false: then sending failed, nothing is marked, and the failures are fresh again in the next run.
    Runs of a provider are a sequence with memory.  Rows are first reduced to one a run; the runs are sorted by Spark
    and read one after the other, so a task holds the keys of one provider that are still remembered, not its runs.
    """
    rows = failures.withColumn("key", run_key()).withColumn("_sent", _delivered(failures))
    runs = rows.groupBy("provider", "run").agg(F.max("run_at").alias("run_at"), F.array_sort(F.collect_set("key")).alias("keys"), F.min("_sent").alias("delivered"))
    ordered = runs.repartition("provider").sortWithinPartitions("provider", "run")
    return ordered.select("provider", "run", "run_at", "keys", "delivered").mapInPandas(lambda it: _fold(it, repeat_hours), ALERT_RUN)


def alert_report(failures: DataFrame, group: str, order: list[str], shown: int = REPORTED) -> DataFrame:
    """The first ``shown`` failures of a run, long errors cut, with a new/repeat mark and how many are left out."""
    w = Window.partitionBy(group).orderBy(*order)
    text = F.when(F.length("error") > ERROR_CHARS, F.concat(F.substring("error", 1, ERROR_CHARS), F.lit("..."))).otherwise(F.col("error"))
    total = F.count("*").over(Window.partitionBy(group))
    rows = failures.withColumn("rn", F.row_number().over(w)).withColumn("left_out", F.greatest(total - shown, F.lit(0).cast("long"))).where(F.col("rn") <= shown)
    return rows.withColumn("error", text).withColumn("mark", F.when(F.col("fresh"), "new").otherwise("repeat"))


def listing_totals(total: Column, size: Column, links: Column) -> Column:
    """Pages from a total and a page size, or the largest linked page number."""
    return F.greatest(F.array_max(links), F.ceil(total / size), F.lit(1).cast("long"))
