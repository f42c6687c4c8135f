"""Intervals of fetched time: merging, frontiers, gaps, retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scan import laid_out, running_max


def interval_merge(windows: DataFrame, key: str) -> DataFrame:
    """(key, since, until) with touching and overlapping intervals joined; intervals that end before they begin are left out.

    An interval begins an island if it begins behind all that the earlier ones of its key reach; it
    belongs to the last island begun.  Both are running maxima over range partitions, so one key may fill many tasks.
    """
    order = ["since", "until"]
    laid = laid_out(windows.where("since <= until").select(key, *order), key, order)
    reach = running_max(laid, key, order, F.col("until"), "_reach", inclusive=False)
    first = F.when(F.col("_reach").isNull() | (F.col("since") > F.col("_reach")), F.col("since"))
    island = running_max(reach, key, order, first, "_island")
    return island.groupBy(key, "_island").agg(F.max("until").alias("until")).select(key, F.col("_island").alias("since"), "until")


def frontier_advance(windows: DataFrame, marks: DataFrame, key: str) -> DataFrame:
    """marks(key, boundary) -> key, frontier, pending: the end of the island that holds the boundary; islands behind a gap wait."""
    j = marks.join(interval_merge(windows, key), key, "left")
    covers = (F.col("since") <= F.col("boundary")) & (F.col("until") >= F.col("boundary"))
    return j.groupBy(key).agg(
        F.greatest(F.max("boundary"), F.max(F.when(covers, F.col("until")))).alias("frontier"), F.count_if(F.col("since") > F.col("boundary")).alias("pending")
    )


def interval_clamp(windows: DataFrame, cutoff: Column, now: Column) -> DataFrame:
    """Without intervals that ended before the cutoff; starts moved up to it, ends down to now."""
    return windows.where(F.col("until") >= cutoff).withColumn("since", F.greatest("since", cutoff)).withColumn("until", F.least("until", now)).where("since <= until")


def bootstrap_mark(catalog: DataFrame, news: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """provider, start, empty: the newest edit, else publication, else now less ``days``; never later than now."""
    seen = news.groupBy("provider").agg(F.max("updated_at").alias("u"), F.max("published_at").alias("p"))
    j = catalog.join(seen, "provider", "left")
    start = F.least(now, F.coalesce("u", "p", now - F.make_dt_interval(F.lit(days))))
    return j.select("provider", start.alias("start"), (F.col("u").isNull() & F.col("p").isNull()).alias("empty"))


def coverage_gap(feed: DataFrame, wanted: DataFrame, key: str, t: str) -> DataFrame:
    """key, since, until of what a source no longer holds: from the wanted start to its oldest entry."""
    oldest = feed.groupBy(key).agg(F.min(t).alias("until"))
    return wanted.join(oldest, key).where("until > since").select(key, "since", "until")


def sync_status(catalog: DataFrame, windows: DataFrame, retries: DataFrame, errors: DataFrame) -> DataFrame:
    """provider, pending_windows, pending_retries, status: error before partial before up_to_date."""
    n = lambda df, name: df.groupBy("provider").agg(F.count("*").alias(name))
    j = catalog.join(n(windows, "pending_windows"), "provider", "left").join(n(retries, "pending_retries"), "provider", "left").join(n(errors, "_errors"), "provider", "left")
    j = j.fillna(0, ["pending_windows", "pending_retries", "_errors"])
    status = F.when(F.col("_errors") > 0, "error").when(F.col("pending_windows") + F.col("pending_retries") > 0, "partial").otherwise("up_to_date")
    return j.withColumn("status", status).drop("_errors")


def run_flags(runs: DataFrame) -> DataFrame:
    """runs(provider, fetched, pending, errors) -> caught_up, no_progress."""
    done = (F.col("pending") == 0) & (F.col("errors") == 0)
    return runs.select("*", done.alias("caught_up"), (~done & (F.col("fetched") == 0)).alias("no_progress"))


def retry_expire(retries: DataFrame, cutoff: Column, now: Column) -> DataFrame:
    """Retries with ``expired``: record date, else saved date, else listing date with the age of the failure, has left the window."""
    evidence = F.coalesce("record_at", "news_at", F.when(F.col("failed_at") < now - F.make_dt_interval(F.lit(7)), F.col("listed_at")))
    return retries.withColumn("expired", F.coalesce(evidence < cutoff, F.lit(False)))


def retry_resolve(retries: DataFrame, successes: DataFrame, stored: DataFrame) -> DataFrame:
    """Retries that stay: no success at or after the required time, or the row is not stored."""
    best = successes.groupBy("provider", "identity").agg(F.max("observed_at").alias("_ok"))
    there = stored.select("provider", "identity", F.lit(True).alias("_there")).distinct()
    j = retries.join(best, ["provider", "identity"], "left").join(there, ["provider", "identity"], "left")
    cleared = F.coalesce(F.col("_ok") >= F.col("required_at"), F.lit(False)) & F.col("_there").isNotNull()
    return j.where(~cleared).drop("_ok", "_there")


def window_complete(windows: DataFrame, failures: DataFrame) -> DataFrame:
    """Windows with ``complete``: enumerated, and nothing of the provider is pending."""
    n = failures.groupBy("provider").agg(F.count("*").alias("_n"))
    return windows.join(n, "provider", "left").withColumn("complete", F.col("enumerated") & F.col("_n").isNull()).drop("_n")
