"""Ranked lexical search with no random access (NRA) over impact-sorted postings.

Three passes, none of which shuffles a posting or a text:

1. Every text is split into terms once.  A task keeps (document, length, and the terms of the
   queries with their counts) as a row, and adds up N, L and the document frequencies of the query
   terms; the rows are written.
2. From N, L and the frequencies follow the weights of the terms and the impact of each posting.  A
   task takes its rows in shards of a bounded number of postings.  In a shard every term has a list
   sorted by falling impact.  A query reads its lists in step, block after block.  A document that
   was met has a lower bound, the impacts seen, and an upper bound, that and the impact at which
   each list stands where the document was not seen.  Documents that were not met yet have the sum
   of these as their upper bound.  Reading goes on until no other document can reach the k best,
   equal scores included, and until the bounds of the k best are one number.
3. The k best of a query in one shard are the floor below which the next shards of that task stop, and
   the k best of all tasks are one window with a limit, which Spark applies before its shuffle.

A hot term is thus spread over all tasks, and memory depends on the size of a shard alone.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, written

SHARD_POSTINGS = 1_000_000  # postings that a task holds at a time, 24 bytes each
SHARD_CELLS = 1 << 25  # documents of a shard times terms of the longest query: a byte each
QUERY_TERMS = 200_000  # distinct query terms that a pass over the documents serves
DEPTH = 256  # postings that a query reads of each list before it looks at the bounds; doubled each time
_SPLIT = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all characters beyond ASCII; A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_SPLIT).split()


def _reduced(batches: Iterator[pa.RecordBatch], number: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Rows with the number of terms and the query terms of each text."""
    for batch in batches:
        lengths, ends, found, counts = [], [0], [], []
        for text in batch["text"].to_pylist():
            terms = terms_of(text)
            hits = Counter(k for k in map(number.get, terms) if k is not None)
            lengths.append(len(terms))
            found += hits.keys()
            counts += hits.values()
            ends.append(len(found))
        lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (found, counts)]
        yield pa.record_batch([batch["doc_id"], pa.array(lengths, pa.int64()), *lists], names=["doc_id", "n", "terms", "tf"])


def _impacts(tf: np.ndarray, m: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def nra(lists: list[tuple[np.ndarray, np.ndarray]], size: int, k: int, tie: np.ndarray, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of ``size`` documents (places, scores) with a score above 0 and of at least ``floor``; equal scores by ``tie``.

    ``lists`` holds for each term the places of its documents and their impacts, sorted by falling impact.
    """
    lower, seen = np.zeros(size, np.int64), np.zeros((size, len(lists)), bool)
    at, depth = np.zeros(len(lists), np.int64), DEPTH
    live: np.ndarray | None = None  # places that can still be among the k best, once no unseen one can
    while True:
        bounds = np.zeros(len(lists), np.int64)
        for j, (places, impacts) in enumerate(lists):
            stop = min(at[j] + depth, len(places))
            part, value = places[at[j] : stop], impacts[at[j] : stop]
            lower[part] += value  # a list holds a document once
            seen[part, j] = True
            at[j] = stop
            bounds[j] = impacts[stop] if stop < len(places) else 0
        met = np.flatnonzero(lower > 0) if live is None else live
        least = max(floor, int(np.partition(lower[met], len(met) - k)[len(met) - k]) if len(met) >= k else 1)
        if live is None and bounds.sum() < least:  # a document not met so far cannot even tie
            live = met
        if live is not None:
            upper = lower[live] + (~seen[live]) @ bounds
            keep = upper >= least
            live, upper = live[keep], upper[keep]
            if (upper == lower[live]).all():
                break
        depth *= 2
    best = live[np.lexsort((tie[live], -lower[live]))][:k]
    return best, lower[best]


class _Best:
    """The k best of every query so far: one entry for a document, equal scores by ascending id."""

    def __init__(self, k: int):
        self.k, self.rows = k, defaultdict(dict)

    def floor(self, query: int) -> int:
        rows = self.rows[query]
        return min(rows.values()) if len(rows) >= self.k else 1

    def add(self, query: int, docs: np.ndarray, scores: np.ndarray) -> None:
        rows = self.rows[query]
        for doc, score in zip(docs.tolist(), scores.tolist()):
            rows[doc] = max(score, rows.get(doc, 0))
        self.rows[query] = dict(sorted(rows.items(), key=lambda x: (-x[1], x[0]))[: self.k])


def _ranked(batches: Iterator[pa.RecordBatch], queries: list[list[int]], weight: np.ndarray, total: int, length: int, k: int) -> Iterator[pa.RecordBatch]:
    """The k best of this task for each query: query, doc_id, score."""
    best, held, postings, rows = _Best(k), [], 0, 0
    room = SHARD_CELLS // max(map(len, queries))
    for batch in batches:
        held.append(batch)
        postings, rows = postings + len(batch["terms"].flatten()), rows + len(batch)
        if postings >= SHARD_POSTINGS or rows >= room:
            _search(pa.Table.from_batches(held).combine_chunks(), queries, weight, total, length, best)
            held, postings, rows = [], 0, 0
    if held:
        _search(pa.Table.from_batches(held).combine_chunks(), queries, weight, total, length, best)
    rows = [(q, doc, score) for q, found in best.rows.items() for doc, score in found.items()]
    yield pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], []))], names=["query", "doc_id", "score"])


def _search(shard: pa.Table, queries: list[list[int]], weight: np.ndarray, total: int, length: int, best: _Best) -> None:
    if not len(shard):
        return
    docs, lists = shard["doc_id"].to_numpy(), shard["terms"].chunk(0)
    m = 10 + (90 * shard["n"].to_numpy() * total) // length
    term, tf = lists.flatten().to_numpy(), shard["tf"].chunk(0).flatten().to_numpy().astype(np.int64)
    place = np.repeat(np.arange(len(docs)), np.diff(lists.offsets.to_numpy()))
    impact = _impacts(tf, m[place], weight[term])
    order = np.lexsort((-impact, term))
    order = order[impact[order] > 0]
    term, place, impact = term[order], place[order], impact[order]
    numbers = np.arange(len(weight))
    starts, ends = np.searchsorted(term, numbers), np.searchsorted(term, numbers, side="right")
    for q, wanted in enumerate(queries):
        own = [(place[starts[t] : ends[t]], impact[starts[t] : ends[t]]) for t in wanted if ends[t] > starts[t]]
        if own:
            best.add(q, *_distinct(own, docs, best.k, best.floor(q)))


def _distinct(lists: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """``nra`` for the k best ids: where rows share an id, more rows are asked for until k ids are there."""
    room = k
    while True:
        places, scores = nra(lists, len(ids), room, ids, floor)
        found, first = np.unique(ids[places], return_index=True)
        if len(found) >= k or len(places) < room:
            return found, scores[first]
        room *= 2


def _query_blocks(queries: DataFrame, limit: int) -> Iterator[list[Row]]:
    """(item_id, text) rows, one an item, in blocks of about ``limit`` terms.  Only one block is on the driver at a time."""
    block, size = [], 0
    whole = queries.where("item_id is not null").groupBy("item_id").agg(F.array_join(F.collect_list("text"), " ").alias("text"))
    for row in whole.toLocalIterator():
        block.append(row)
        size += len(set(terms_of(row.text)))
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    one = found.groupBy("item_id", "doc_id").agg(F.max("score").alias("score"))
    return one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = 10, query_terms: int = QUERY_TERMS) -> DataFrame:
    """docs(doc_id, text), queries(item_id, text) -> item_id, rank, doc_id, score: the k best documents of each query.

    Scores are integers: a sum over the query's distinct terms of weight times saturated frequency.
    Only scores above 0 count; equal scores go by ascending doc_id.  Null, empty and term-less texts
    count in neither N nor L and match nothing; queries without terms give no rows.  Repeated rows
    each count in N, L and the frequencies; a doc_id is listed once, with its best row, and rows
    without a doc_id are counted but not listed.  Queries that share an item_id are one query, those
    without one are left out.  Very long texts are read whole.  Empty tables give an empty result;
    other columns are ignored.  Queries are served in blocks of ``query_terms`` terms, each of which
    reads all documents.
    """
    small_batches()
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = [found for block in _query_blocks(queries.select(F.col("item_id").cast("long").alias("item_id"), "text"), query_terms) if (found := _block(spark, docs, block, k)) is not None]
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return _top(whole, k) if len(parts) == 1 else _top(written(whole, "ranked"), k)


def _block(spark: SparkSession, docs: DataFrame, block: list[Row], k: int) -> DataFrame | None:
    """item_id, doc_id, score of the k best of each task, for one block of queries; None where no query or no document has a term."""
    number: dict[bytes, int] = {}
    wanted: dict[int, dict[int, None]] = defaultdict(dict)
    for row in block:
        for term in terms_of(row.text):
            wanted[row.item_id][number.setdefault(term, len(number))] = None
    if not number:
        return None
    items, queries = list(wanted), [list(t) for t in wanted.values()]
    reduced = written(docs.mapInArrow(lambda it: _reduced(it, number), "doc_id long, n long, terms array<int>, tf array<int>"), "terms")
    total, length = reduced.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not total:
        return None
    df = np.zeros(len(number), np.int64)
    for term, n in reduced.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():  # as many rows as the block has terms, at most
        df[term] = n
    weight = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    rows = reduced.where("doc_id is not null and size(terms) > 0").select("doc_id", "n", "terms", "tf")
    ranked = rows.mapInArrow(lambda it: _ranked(it, queries, weight, total, length, k), "query long, doc_id long, score long")
    ids = spark.createDataFrame([(q, item) for q, item in enumerate(items)], "query long, item_id long")
    return ranked.join(F.broadcast(ids), "query").select("item_id", "doc_id", "score")
