"""Running values along an ordered sequence that may be longer than any one task.

The rows of all keys are laid out in range partitions of (key, order), so a key with a third of all rows lies
in many.  A running maximum is taken inside each partition; what the earlier partitions of
the key reached is one row a partition and key, and is carried in from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.landing import write_snapshot

PART = "_part"


def laid_out(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows in range partitions of the key and the order, written, with the number of each row's partition."""
    return write_snapshot(rows.repartitionByRange(key, *order).withColumn(PART, F.spark_partition_id()), "laid-out")


def running_max(laid: DataFrame, key: str, order: list[str], value: Column, name: str, inclusive: bool = True) -> DataFrame:
    """``laid`` with the maximum of ``value`` over the earlier rows of the key, and the row itself if ``inclusive``.  Nulls do not count."""
    valued = laid.withColumn("_value", value)
    inside = Window.partitionBy(PART, key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    reached = valued.groupBy(key, PART).agg(F.max("_value").alias("_top"))
    before = Window.partitionBy(key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    carried = reached.select(F.col(key).alias("_key"), F.col(PART).alias("_in"), F.max("_top").over(before).alias("_carried")).where("_carried is not null")
    own = valued.withColumn("_own", F.max("_value").over(inside))
    joined = own.join(carried, own[key].eqNullSafe(carried["_key"]) & (own[PART] == carried["_in"]), "left")
    return joined.withColumn(name, F.greatest("_own", "_carried")).drop("_value", "_own", "_key", "_in", "_carried")
