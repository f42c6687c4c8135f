"""The registered query of every operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_tools import ToolSchemas, format_chat
from .common import fold
from .exact_dedup import exact_dedup
from .html_wrapper import extract_main_text
from .language_id import fit_language_model, predict_language
from .lexical_search import ranked_search
from .minhash import minhash_groups
from .ngram_join import ngram_jaccard_groups
from .packing import pack_documents
from .piece_codec import encode_and_decode
from .quality import fit_quality_model, score_quality
from .token_alignment import alignment_counts
from .toxicity import fit_toxicity_model, score_toxicity
from .vector_topk import exact_topk


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ngram_jaccard_groups(_table(spark, sf_dir, "documents"), words=3, threshold=(90, 100))
    return groups.select("doc_id", "n_shingles", "component_id", "class_id", "n_links")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(_table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", k=10)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold(F.col("doc_id"), 5) != 0)
    scored = score_toxicity(docs, fit_toxicity_model(docs, labels))
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"), F.get(F.col("spans.start"), F.lit(0)).alias("first_span_start"),
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_language_model(docs.where(fold(F.col("doc_id"), 4) != 2))
    scored = predict_language(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = docs.withColumn("coded", encode_and_decode("text", "doc_id", seed=1, dropout=0.1))
    return coded.select(
        "doc_id", F.size("coded.ids").cast("long").alias("n_pieces"), F.xxhash64("coded.ids").alias("ids_hash"), (F.col("coded.back") == F.col("text")).alias("lossless")
    )


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"), keep="max")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality").where(fold(F.col("doc_id"), 3) != 1)
    scored = score_quality(docs, fit_quality_model(docs, labels))
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


TOOLS: ToolSchemas = {
    "search": {"query": ("string", True), "limit": ("integer", True)},
    "lookup": {"key": ("string", True), "exact": ("boolean", False)},
    "rank": {"items": ("integer", True), "weight": ("number", False)},
}


def derived_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tool calls and results for every assistant turn, by integer rules: the table itself has no tool traffic.

    Among them are tools without a schema, missing and ill-typed arguments, calls without a
    result, results without a call, and chains in which a turn uses the call two turns before.
    """
    said = conversations.where("role = 'assistant'").select("conv_id", "turn", "text").distinct()
    k, call_id = F.col("conv_id") + F.col("turn"), F.format_string("call_%d_%d", "conv_id", "turn")
    name = F.element_at(F.array(*[F.lit(x) for x in ("search", "lookup", "rank", "fetch")]), (k % 4 + 1).cast("int"))
    text = F.coalesce("text", F.lit(""))
    arguments = F.map_from_arrays(
        F.array(F.when(k % 4 == 0, "query").when(k % 4 == 1, "key").otherwise("items"), F.when(k % 4 == 0, "limit").when(k % 4 == 1, "exact").otherwise("weight")),
        F.array(F.when(k % 4 == 2, F.length(text).cast("string")).otherwise(text), F.when(k % 6 == 0, "many").when(k % 4 == 1, "true").when(k % 4 == 0, F.length(text).cast("string")).otherwise("0.5")),
    )
    arguments = F.when(k % 9 == 0, F.map_filter(arguments, lambda key, _: key != "limit")).otherwise(arguments)
    uses = F.when(k % 3 != 0, F.array(F.format_string("call_%d_%d", F.col("conv_id"), F.col("turn") - 2))).otherwise(F.array().cast("array<string>"))
    calls = said.select("conv_id", "turn", call_id.alias("call_id"), name.alias("name"), arguments.alias("arguments"), uses.alias("uses"))
    answered = said.where(k % 5 != 0).select("conv_id", call_id.alias("call_id"), text.alias("content"))
    lost = said.where(k % 7 == 0).select("conv_id", F.concat(F.lit("lost_"), call_id).alias("call_id"), F.lit("late").alias("content"))
    return calls, answered.unionByName(lost)


def op10_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    calls, results = derived_calls(conversations)
    return format_chat(conversations, calls, results, TOOLS)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = minhash_groups(_table(spark, sf_dir, "documents"), words=3, threshold=(85, 100))
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_counts(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_exact_topk": op2_exact_topk,
    "op3_toxicity": op3_toxicity,
    "op4_language_id": op4_language_id,
    "op5_piece_codec": op5_piece_codec,
    "op6_html_extraction": op6_html_extraction,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_quality": op8_quality,
    "op9_packing": op9_packing,
    "op10_chat_tools": op10_chat_tools,
    "op11_ranked_search": op11_ranked_search,
    "op12_minhash_near_dedup": op12_minhash_near_dedup,
    "op13_token_alignment": op13_token_alignment,
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Linked sets and what they reach, with the share of common 3-word shingles in hundredths to be filled in.
_LINKED = rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
        g AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS g
              FROM w WHERE len(w) > 0),
        c AS (SELECT min(doc_id) AS cls, g, len(g) AS n FROM g GROUP BY g), e AS (SELECT cls, n, unnest(g) AS gram FROM c),
        k AS (SELECT a.cls AS a, b.cls AS b FROM e AS a JOIN e AS b ON a.gram = b.gram AND a.cls < b.cls AND 100 * least(a.n, b.n) >= {{share}} * greatest(a.n, b.n)
              GROUP BY a.cls, b.cls, a.n, b.n HAVING 100 * count(*) >= {{share}} * (a.n + b.n - count(*))),
        both_ways AS (SELECT a, b FROM k UNION ALL SELECT b, a FROM k),
        reach AS (SELECT cls AS id, cls AS to_id FROM c UNION SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON reach.to_id = both_ways.a),
        m AS (SELECT id, min(to_id) AS component_id FROM reach GROUP BY id),"""

ORACLE_SQL: dict[str, str] = {
    "op2_exact_topk": """
        WITH e AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
                   FROM embeddings WHERE embedding IS NOT NULL),
        s AS (SELECT q.vec_id AS query_id, e.vec_id, list_sum(list_transform(range(1, len(e.v) + 1), lambda i: q.v[i] * e.v[i])) AS score
              FROM e AS q JOIN e ON q.vec_id <> e.vec_id AND len(q.v) = len(e.v) WHERE q.vec_id % 100 = 0),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM s)
        SELECT * FROM r WHERE rank <= 10""",
    "op7_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.text) AS text_sha256
        FROM t JOIN g ON t.text = g.text""",
    "op11_ranked_search": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        l AS (SELECT doc_id, len(w) AS n FROM d WHERE len(w) > 0), s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM l),
        q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
        f AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
        i AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))) AS impact FROM p JOIN f USING (term) JOIN l USING (doc_id), s),
        r AS (SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM q JOIN i USING (term) GROUP BY item_id, doc_id HAVING sum(impact) > 0),
        o AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM r)
        SELECT * FROM o WHERE rank <= 10""",
    "op12_minhash_near_dedup": _LINKED.format(share=85)
    + """
        o AS (SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id
              FROM documents AS d LEFT JOIN g ON d.doc_id = g.doc_id LEFT JOIN c ON g.g = c.g LEFT JOIN m ON c.cls = m.id)
        SELECT *, doc_id = component_id AS kept FROM o""",
    "op1_ngram_jaccard_join": _LINKED.format(share=90)
    + """
        size AS (SELECT c.cls, count(*) AS docs FROM g JOIN c ON g.g = c.g GROUP BY c.cls),
        deg AS (SELECT s.cls, s.docs - 1 + coalesce(sum(t.docs), 0) AS n_links FROM size AS s LEFT JOIN both_ways AS w ON w.a = s.cls LEFT JOIN size AS t ON t.cls = w.b GROUP BY s.cls, s.docs)
        SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id, coalesce(c.cls, d.doc_id) AS class_id, CAST(coalesce(deg.n_links, 0) AS BIGINT) AS n_links
        FROM documents AS d LEFT JOIN g ON d.doc_id = g.doc_id LEFT JOIN c ON g.g = c.g LEFT JOIN m ON c.cls = m.id LEFT JOIN deg ON deg.cls = c.cls""",
}
