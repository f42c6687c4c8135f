"""Exact deduplication by a log-structured merge index of text digests (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

FILTERS = {"parquet.bloom.filter.enabled#digest": "true", "parquet.bloom.filter.expected.ndv#digest": "100000"}


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def flush(keyed: DataFrame, keep: str) -> DataFrame:
    """Memtables -> sorted runs: one entry for each digest of a memtable, written with block filters."""
    best = F.max("doc_id") if keep == "max" else F.min("doc_id")
    runs = keyed.groupBy("digest", "run").agg(best.alias("run_keep"), F.count("*").alias("run_rows"))
    return written(runs.sortWithinPartitions("digest", "run"), "runs", **FILTERS)


def compact(runs: DataFrame, keep: str) -> DataFrame:
    """Merge all runs: one entry for each digest, with the identifier that stays."""
    best = F.max("run_keep") if keep == "max" else F.min("run_keep")
    merged = runs.groupBy("digest").agg(best.alias("keep_id"), F.sum("run_rows").alias("group_size"))
    return written(merged.sortWithinPartitions("digest"), "level", **FILTERS)


def exact_dedup(
    docs: DataFrame, keep: str = "min", memtable_rows: int = 1024, digest: Callable[[Column], Column] = sha256_digest
) -> DataFrame:
    """docs(doc_id, text) -> doc_id, keep_id, group_size, kept, text_sha256; one row per input row.

    Rows go to memtables of about ``memtable_rows`` by a hash of their id.  Each memtable flushes
    one entry per digest as a sorted run; compaction merges the runs and keeps the smallest
    (``keep="min"``) or largest identifier.  Lookups join on (digest, memtable), so copies of one
    text, however many, stay spread over the memtables.  Hits are compared byte by byte with the
    text that stays; digests under which texts differ are regrouped by the texts themselves.

    Null text counts as empty.  Rows that share a doc_id are separate rows of a group; each one
    with the kept id has ``kept`` true.  A null doc_id never stays unless its whole group has none.
    An empty table gives an empty result; other columns are ignored.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    tables = max(1, -(-docs.count() // memtable_rows))
    memtable = F.pmod(F.xxhash64("doc_id"), F.lit(tables)).cast("int")
    keyed = docs.select("doc_id", "text", digest(F.col("text")).alias("digest"), memtable.alias("run"))
    log = written(keyed.select("doc_id", "digest", "run", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")), "log")
    runs = flush(log, keep)
    entries = written(runs.select("digest", "run").join(compact(runs, keep), "digest"), "entries")

    hits = entries.where("group_size > 1").select("digest", "run", "keep_id")
    found = written(keyed.join(hits, ["digest", "run"]), "hits")
    stays = found.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("digest", "text").dropDuplicates(["digest"])
    probes = hits.select("digest", "run").join(stays.withColumnRenamed("text", "kept_text"), "digest")
    differs = written(found.join(probes, ["digest", "run"]).where("text <> kept_text").select("digest").distinct(), "differs")

    out = log.join(entries, ["digest", "run"])
    if not differs.isEmpty():
        best = F.max("doc_id") if keep == "max" else F.min("doc_id")
        clash = found.join(differs, "digest")
        again = clash.groupBy("digest", "text").agg(best.alias("keep_id"), F.count("*").alias("group_size"))
        fixed = clash.select("doc_id", "digest", "text").join(again, ["digest", "text"])
        fixed = fixed.select("doc_id", "keep_id", "group_size", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
        out = out.join(differs, "digest", "left_anti").select("doc_id", "keep_id", "group_size", "text_sha256").unionByName(fixed)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
