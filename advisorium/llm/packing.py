"""Packing of tokenised documents into windows of fixed length by non-negative least squares.

Every document is cut into full windows and a tail shorter than a window.  The histogram of tail
lengths (fewer numbers than the window has tokens) goes to the driver, where combinations of two
to four lengths that fill a window exactly are enumerated; non-negative least squares says how
often each is used, counts are rounded down, and what is left over is laid end to end and cut at
window boundaries.  Where a tail goes follows from its length and its rank among the tails of that
length alone, so no document is gathered anywhere and a length that a third of all documents share
is dealt over all tasks.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import small_batches, written

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
WINDOW = 1024
END_ID = 0
SWEEPS = 60
LONG_RUN = 1000  # white-space characters in a row from which a text goes through the tokenizers library itself


@lru_cache(maxsize=2)
def _encoder(path: str):
    """text -> ids, equal to the tokenizers library on the json beside ``path``, whose added tokens are ids of their own.  Where no two white-space characters meet, the split pattern needs no look-ahead, which is faster and splits alike."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    pattern, listed = public_tokenizers.PATTERN, Path(path).with_suffix(".json")
    added = {t["content"]: t["id"] for t in json.loads(listed.read_text("utf-8"))["added_tokens"]} if listed.exists() else {}
    full = tiktoken.Encoding("full", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
    plain = tiktoken.Encoding("plain", pat_str=pattern.replace(r"|\s+(?!\S)", ""), mergeable_ranks=ranks, special_tokens={})
    pair, run = re.compile(r"\s\s"), re.compile(rf"\s{{{LONG_RUN}}}")
    whole = Tokenizer.from_file(str(listed)) if listed.exists() else None

    def encode(text: str) -> list[int]:
        if whole is not None and run.search(text):  # the look-ahead of the split pattern overflows the stack on very long runs
            return whole.encode(text, add_special_tokens=False).ids
        if any(t in text for t in added):
            return full.encode(text, allowed_special="all")
        return (full if pair.search(text) else plain).encode_ordinary(text)

    return encode


def _cut(batches: Iterator[pd.DataFrame], path: str, window: int) -> Iterator[pd.DataFrame]:
    """Ids of each text with the end id: checksums of its full windows, its tail, and its rank among this task's tails of that length."""
    encode, part = _encoder(path), TaskContext.get().partitionId()
    ranks, filled = np.zeros(window, np.int64), 0
    for pdf in batches:
        rows = []
        for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
            ids = encode(text or "")
            ids.append(END_ID)
            ids = np.array(ids, "<u4")
            whole, tail = divmod(len(ids), window)
            sums = [zlib.crc32(ids[k * window : (k + 1) * window].tobytes()) for k in range(whole)]
            rows.append((doc_id, part, tail, ranks[tail], len(ids), filled, sums, ids[whole * window :].tobytes()))
            ranks[tail] += 1
            filled += whole
        yield pd.DataFrame(rows, columns=["doc_id", "part", "tail", "rank", "n", "first_full", "full_sums", "tail_ids"])


CUT_SCHEMA = "doc_id long, part int, tail int, rank long, n long, first_full long, full_sums array<long>, tail_ids binary"


def combinations(window: int, lengths: np.ndarray) -> list[tuple[int, ...]]:
    """Two to four of the given lengths that fill the window: every pair, and every length with one or two twins of it."""
    there, found = set(lengths.tolist()), set()
    for a in there:
        for twins in (1, 2, 3):
            rest = window - twins * a
            if rest in there:
                found.add(tuple(sorted((*[a] * twins, rest), reverse=True)))
            half = rest // 2
            if rest > 0 and twins < 3 and rest % 2 == 0 and half in there:
                found.add(tuple(sorted((*[a] * twins, half, half), reverse=True)))
    return sorted(found, reverse=True)


def solve_counts(combos: list[tuple[int, ...]], histogram: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """min |A x - h|, x >= 0, by coordinate descent over the sparse columns of A; rounded down and never above what is there."""
    columns = [np.unique(c, return_counts=True) for c in combos]
    left, x = histogram.astype(float).copy(), np.zeros(len(combos))
    norms = [float((m * m).sum()) for _, m in columns]
    for _ in range(sweeps):
        moved = 0.0
        for k, (at, m) in enumerate(columns):
            step = max(-x[k], float(left[at] @ m) / norms[k])
            if step:
                x[k] += step
                left[at] -= step * m
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    counts, rest = np.zeros(len(combos), np.int64), histogram.astype(np.int64).copy()
    for half in (np.floor(x + 1e-6), np.full(len(combos), np.iinfo(np.int64).max // 2)):  # the rounded solution, then greedily what still fits
        for k, (at, m) in enumerate(columns):
            use = int(min(half[k], (rest[at] // m).min()))
            counts[k] += use
            rest[at] -= use * m
    return counts


@dataclass(frozen=True)
class PackingPlan:
    window: int
    places: dict[int, tuple[np.ndarray, list[tuple[int, int, int, list[int]]]]]  # length -> ends of rank ranges, (start, twins, first sequence, offsets)
    taken: np.ndarray
    stream_at: np.ndarray
    stream_tokens: int
    first_stream_sequence: int

    def boundaries(self) -> np.ndarray:
        """Where the end of the stream is cut: the last part of a window goes to sequences with powers of two as lengths."""
        whole, rest = divmod(self.stream_tokens, self.window)
        cuts = [whole * self.window]
        for bit in range(self.window.bit_length() - 1, -1, -1):
            if rest >> bit & 1:
                cuts.append(cuts[-1] + (1 << bit))
        return np.array(cuts)

    def pieces(self, tail: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the tail, length, sequence, offset) of the tail with this rank among the tails of its length."""
        if not tail:
            return []
        if rank < self.taken[tail]:
            ends, slots = self.places[tail]
            start, twins, first, offsets = slots[int(np.searchsorted(ends, rank, side="right"))]
            at, twin = divmod(rank - start, twins)
            return [(0, tail, first + at, offsets[twin])]
        lo = int(self.stream_at[tail] + (rank - self.taken[tail]) * tail)
        out, at, cuts = [], lo, self.boundaries()
        while at < lo + tail:
            if at < cuts[0]:
                sequence = at // self.window
                begin, end = sequence * self.window, (sequence + 1) * self.window
            else:
                k = int(np.searchsorted(cuts, at, side="right"))
                sequence, begin, end = int(cuts[0]) // self.window + k - 1, int(cuts[k - 1]), int(cuts[k])
            stop = min(lo + tail, end)
            out.append((at - lo, stop - at, self.first_stream_sequence + sequence, at - begin))
            at = stop
        return out


def make_plan(histogram: np.ndarray, window: int) -> PackingPlan:
    combos = combinations(window, np.flatnonzero(histogram))
    counts = solve_counts(combos, histogram)
    taken, sequence, places = np.zeros(window, np.int64), 0, {}
    for combo, count in zip(combos, counts.tolist()):
        if not count:
            continue
        offsets = np.concatenate([[0], np.cumsum(combo)[:-1]]).tolist()
        for length in set(combo):
            own = [o for o, c in zip(offsets, combo) if c == length]
            places.setdefault(length, []).append((int(taken[length]), len(own), sequence, own))
            taken[length] += count * len(own)
        sequence += count
    left = (histogram - taken) * np.arange(window)
    ranges = {k: (np.array([s[0] for s in v[1:]] + [int(taken[k])]), v) for k, v in places.items()}
    return PackingPlan(window, ranges, taken, np.concatenate([[0], np.cumsum(left)[:-1]]), int(left.sum()), sequence)


def _pieces(batches: Iterator[pd.DataFrame], plan: PackingPlan) -> Iterator[pd.DataFrame]:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    for pdf in batches:
        rows = []
        for r in pdf.itertuples(index=False):
            for k, crc in enumerate(r.full_sums):
                rows.append((r.doc_id, k * plan.window, plan.window, crc, r.n, ((r.part << 32) + r.first_full + k) * 2 + 1, 0))
            before = len(r.full_sums) * plan.window
            for start, length, sequence, offset in plan.pieces(r.tail, r.rank + r.before):
                crc = zlib.crc32(r.tail_ids[4 * start : 4 * (start + length)])
                rows.append((r.doc_id, before + start, length, crc, r.n, sequence * 2, offset))
        yield pd.DataFrame(rows, columns=names)


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW) -> DataFrame:
    """docs(doc_id, text) -> one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Each text is its ids and the end id; null counts as empty, so it is the end id alone.  Full
    windows have odd sequence ids, shared windows even ones.  Only the end of the left-over stream
    is shorter than a window, and is cut into powers of two, so nothing needs padding.  Repeated
    rows are packed each for itself; an empty table gives an empty result; other columns are not
    read.  ``window`` is a power of two.
    """
    small_batches()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = written(rows.mapInPandas(lambda it: _cut(it, vocabulary, window), CUT_SCHEMA), "cut")
    counts = cut.groupBy("tail", "part").agg(F.count("*").alias("rows"))
    histogram = np.zeros(window, np.int64)
    for r in counts.groupBy("tail").agg(F.sum("rows").alias("rows")).collect():  # at most `window` rows
        histogram[r.tail] = r.rows
    histogram[0] = 0
    plan = make_plan(histogram, window)
    earlier = Window.partitionBy("tail").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("tail", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    placed = cut.join(before, ["tail", "part"])
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return placed.mapInPandas(lambda it: _pieces(it, plan), schema)
