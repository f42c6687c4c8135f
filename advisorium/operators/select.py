"""Selection: first or best per key, change logs, stop rules of ordered scans, paging."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def best_per_key(rows: DataFrame, keys: list[str], rank: list[Column]) -> DataFrame:
    """The row with the largest rank of each key, as one aggregate: no sort, and partial maxima before the shuffle."""
    best = rows.groupBy(*keys).agg(F.max(F.struct(F.struct(*[c.alias(f"r{i}") for i, c in enumerate(rank)]).alias("_rank"), F.struct(*rows.columns).alias("_row"))).alias("_best"))
    return best.select("_best._row.*")


def delta_updated_since(log: DataFrame, boundary: Column) -> DataFrame:
    """Change log without deletions whose own time, else the batch time, reaches the boundary; newest first."""
    at = F.coalesce("changed", "fetch_time")
    return log.where((F.col("action") != "deleted") & (at >= boundary)).withColumn("at", at).orderBy(F.desc("at"), "cve")


def delta_latest_in_window(log: DataFrame, since: Column, until: Column) -> DataFrame:
    """Per id the entry of the newest batch in [since, until], the first of that batch.  Deletions are skipped, so they hide nothing."""
    inside = log.where((F.col("action") != "deleted") & F.col("fetch_time").between(since, until))
    order = F.when(F.col("action") == "new", 0).otherwise(1)
    return first_per_key(inside, ["cve"], [F.desc("fetch_time"), order, "pos"])


def _before_stop(rows: DataFrame, feed: list[str], order: list[str], stop: Column) -> DataFrame:
    """Rows of each feed that come before its first row with ``stop``; feeds without one stay whole.

    Where a feed stops is one minimum, so no task holds a feed; rows with the order of the stopping row stop too.
    """
    place = F.struct(*order)
    stops = rows.groupBy(*feed).agg(F.min(F.when(stop, place)).alias("_stop")).where("_stop is not null")
    stops = stops.select(*[F.col(f).alias(f"_stop_{f}") for f in feed], "_stop")
    same = functools.reduce(lambda a, b: a & b, [F.col(f).eqNullSafe(F.col(f"_stop_{f}")) for f in feed])
    return rows.join(stops, same, "left").where(F.col("_stop").isNull() | (place < F.col("_stop"))).select(*rows.columns)


def stop_after_known(rows: DataFrame, feed: list[str], order: list[str], known: str, seen_new_first: bool = True) -> DataFrame:
    """Rows before the first known one, which only stops the scan after something new if ``seen_new_first``."""
    if not seen_new_first:
        return _before_stop(rows, feed, order, F.col(known))
    news = rows.groupBy(*feed).agg(F.min(F.when(~F.col(known), F.struct(*order))).alias("_new"))
    keyed = rows.join(news, feed)
    return _before_stop(keyed, feed, order, F.col(known) & (F.struct(*order) > F.col("_new"))).drop("_new")


def stop_after_known_pages(rows: DataFrame, feed: list[str], known: str, pages: int = 2) -> DataFrame:
    """Rows up to the page that completes ``pages`` fully known pages in a row."""
    w = Window.partitionBy(*feed).orderBy("page")
    p = rows.groupBy(*feed, "page").agg(F.bool_and(known).alias("_all"))
    run = F.sum(F.col("_all").cast("int")).over(w.rowsBetween(-(pages - 1), 0))
    p = p.withColumn("_hit", (run == pages).cast("int"))
    p = p.withColumn("_before", F.coalesce(F.max("_hit").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where("_before = 0")
    return rows.join(p.select(*feed, "page"), [*feed, "page"], "left_semi")


def stop_after_old_page(rows: DataFrame, feed: list[str], old: Column) -> DataFrame:
    """Rows up to and with the first page on which every row is old."""
    w = Window.partitionBy(*feed).orderBy("page")
    p = rows.withColumn("_old", old).groupBy(*feed, "page").agg(F.bool_and("_old").alias("_all"))
    p = p.withColumn("_before", F.coalesce(F.max(F.col("_all").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where("_before = 0")
    return rows.join(p.select(*feed, "page"), [*feed, "page"], "left_semi")


def stop_at_boundary(rows: DataFrame, feed: list[str], order: list[str], t: Column, since: Column, ordered: bool = True) -> DataFrame:
    """Rows before the first older one; a feed without order just skips older ones."""
    if not ordered:
        return rows.where(t >= since)
    return _before_stop(rows, feed, order, F.coalesce(t < since, F.lit(False)))


def newest(rows: DataFrame, time: str, key: str, n: int) -> DataFrame:
    """The n newest rows, a top-k without a full sort."""
    return rows.orderBy(F.desc(time), F.desc(key)).limit(n)


def keyset_page(rows: DataFrame, time: str, key: str, after: tuple[Column, Column], n: int) -> DataFrame:
    """The page behind (time, key) in newest-first order."""
    behind = (F.col(time) < after[0]) | ((F.col(time) == after[0]) & (F.col(key) < after[1]))
    return newest(rows.where(behind), time, key, n)


def top_per_group(rows: DataFrame, group: str, time: str, key: str, n: int) -> DataFrame:
    w = Window.partitionBy(group).orderBy(F.desc(time), F.desc(key))
    return rows.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
