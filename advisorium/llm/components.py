"""Connected components of an undirected edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    hop = down.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hop.unionByName(low.select("a", F.col("m").alias("b")))


def _are_stars(edges: DataFrame) -> bool:
    """Whether edges(a, b), a > b, are done: every a has one b, and no b is an a."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> (id, component): every id in an edge, with the smallest id that it reaches.

    Every round is two joins whose hot sides AQE may split; the table is written to the shared
    folder after each, so no lineage grows and no label ever visits the driver.  Rounds end as soon as
    all edges are stars, which one aggregate tells, so none is spent to see that nothing moves any more.
    The number of rounds grows with the logarithm of the longest path.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _are_stars(now):
        now = written(_small_star(_large_star(now).distinct()).distinct(), "stars")
    members = now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component")
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return members.unionByName(roots)
