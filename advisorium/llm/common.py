"""Small helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIRS: dict[str, str] = {}
BROADCAST_IDS = 1_000_000  # 8 MB of ids
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, a temporary one on a local master, an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    return _OWN_DIRS.setdefault(app, tempfile.mkdtemp(prefix="spark-"))


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors.

    Spark is asked to delete the shuffle files of this one write when it is done, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before) if before is not None else spark.conf.unset(SHUFFLE_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the table does not have yet, in upper or lower case."""
    there = {c.lower() for c in df.columns}
    while base.lower() in there:
        base += "_"
    return base


def small_batches(rows: int = 1000) -> None:
    """Texts are long: hand them to Python in batches of at most ``rows``, so that a worker holds little."""
    spark, name = SparkSession.getActiveSession(), "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark is not None and not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))


def by_ids(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join with a written table of doc_ids: broadcast where it was counted to have at most BROADCAST_IDS rows, else by shuffle."""
    ids = ids.select("doc_id")
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", how)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, name: str, limit: int, by_class: bool = False) -> DataFrame:
    """docs(doc_id, text) with the 0/1 label ``name``, for at most ``limit`` labelled rows.

    Of several labels of a document the larger one counts.  The rows are the first in the order of a
    keyed hash, so the same ones on every run; with
    ``by_class`` each class has half of the limit.  Only their ids and labels (16 bytes a row, so
    bounded by ``limit``) are broadcast; the texts are filtered where they lie.
    """
    rows = labels.where(F.col(name).isin(0, 1)).groupBy("doc_id").agg(F.max(F.col(name).cast("int")).alias(name))
    first = lambda part, n: part.orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(n)
    if by_class:
        picked = first(rows.where(F.col(name) == 1), limit // 2).unionByName(first(rows.where(F.col(name) == 0), limit // 2))
    else:
        picked = first(rows, limit)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(picked), "doc_id")
