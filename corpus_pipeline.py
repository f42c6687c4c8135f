"""From raw documents to packed training sequences: language, toxicity, exact copies, near copies, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from advisorium.llm.common import by_ids, fold, free_name, written
from advisorium.llm.exact_dedup import exact_dedup
from advisorium.llm.language_id import fit_language_model, language_of, resembles_a_language, similarity_floors
from advisorium.llm.ngram_join import ngram_jaccard_groups
from advisorium.llm.packing import pack_documents
from advisorium.llm.toxicity import fit_toxicity_model, toxicity_of

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOXIC_FROM = 0.5


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and texts that resemble no learned language.

    Learned from the rows whose crc32(doc_id as text) mod 4 is not 2; a text goes if its best cosine
    lies below the floor that all learned texts of its length set.  Null and empty texts go; rows
    that repeat or have no id are judged each by its text; if nothing was learned only texts
    without a letter go.
    """
    learned = docs.where(fold(F.col("doc_id"), 4) != 2)
    model = fit_language_model(learned)
    floors = similarity_floors(learned, model)
    if not model.langs:
        return docs.where(F.col("text").rlike("\\p{L}"))
    name = free_name(docs, "_language")
    scored = docs.withColumn(name, language_of("text", model))
    return scored.where(resembles_a_language("text", F.col(name), floors)).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts whose toxicity is at least ``TOXIC_FROM``.  Null and empty texts and rows without an id are judged by their text like all others."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold(F.col("doc_id"), 5) != 0)
    model = fit_toxicity_model(docs, labels)
    name = free_name(docs, "_toxicity")
    scored = docs.withColumn(name, toxicity_of("text", model))
    return scored.where(F.col(f"{name}.score") < TOXIC_FROM).select(*docs.columns)


def _ids_are_unique(docs: DataFrame) -> bool:
    return docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty()


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays, null counting as empty and a missing doc_id as the smallest.

    Where doc_ids are missing or shared, rows are dropped by id and text together, so texts that
    share a doc_id are each kept; of rows that repeat both, one stays.  Else ids suffice and the
    texts stay where they are.
    """
    sha = free_name(docs, "_sha")
    judged = written(exact_dedup(docs, keep="max").select("doc_id", F.col("text_sha256").alias(sha), "kept"), "judged")
    if _ids_are_unique(docs):
        return by_ids(docs, judged.where("not kept"), "left_anti").select(*docs.columns)
    keyed = docs.withColumn(sha, F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    same = lambda other: keyed["doc_id"].eqNullSafe(other["doc_id"]) & (keyed[sha] == other[sha])
    dropped = judged.where("not kept").select("doc_id", sha).distinct()
    repeated = written(judged.where("kept").groupBy("doc_id", sha).count().where("count > 1").select("doc_id", sha), "repeated")
    single = keyed.join(dropped, same(dropped), "left_anti")
    if repeated.isEmpty():
        return single.select(*docs.columns)
    keyed = single
    once = single.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", sha])
    return single.join(repeated, same(repeated), "left_anti").unionByName(once).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word n-grams at 0.8 or more the smallest doc_id stays, a missing doc_id counting as the largest.

    Texts without a word link with nothing and stay.  Where doc_ids are missing or shared, rows are
    numbered and compared as rows, so no row goes for another one's text.
    """
    options = dict(words=5, threshold=(80, 100), count_links=False)
    if _ids_are_unique(docs):
        groups = ngram_jaccard_groups(docs, **options)
        dropped = written(groups.where("doc_id <> component_id").select("doc_id"), "dropped")
        return by_ids(docs, dropped, "left_anti").select(*docs.columns)
    row = free_name(docs, "_row")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = ngram_jaccard_groups(numbered.select(F.col(row).alias("doc_id"), "text"), **options)
    named = groups.select(F.col("doc_id").alias(row), "component_id").join(numbered.select(row, "doc_id"), row)
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    best = named.groupBy("component_id").agg(F.min(rank).alias("best")).select(F.col(f"best.{row}").alias(row))
    return numbered.join(best, row, "left_semi").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text that is left in pieces of sequences of 1024 tokens; each row is packed for itself, null counting as empty."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_language),
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: Learned filters, near copies and tokenisation are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
