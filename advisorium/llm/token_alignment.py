"""Alignment of two tokenizers of the same text, and how often their tokens meet in a corpus.

Tokenizer A is byte-level BPE (``tokenizers``, reading a space and the text), B a SentencePiece model,
which puts that space before the text itself.  Both cut the same bytes.

* Coarse cuts come from the libraries' own spans: character offsets of A, and the begin and end of
  each piece of B's proto.
* A span says nothing exact about a token that ends inside a character: A's parts of a multibyte
  character all span the whole of it, B's byte-fallback pieces have empty spans but for the last.
  The ends of these tokens alone are refined with the lengths of the tokens' decoded bytes.
* Where a token of A and one of B end at the same byte, a group ends.
* Both cut before a single space inside text, so a text is aligned segment by segment, and segments met again are looked up.

Pairs of tokens that share a group are links.  Their document counts are one partial aggregate; the
most frequent pairs, at most ``HEAD_PAIRS``, are then looked up inside the tasks, all others meet
their counts in a join, whose keys are rare by construction.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import small_batches, written

TOKENIZER_A = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER_B = public_tokenizers.path("piece_bpe_32k.model")
HEAD_PAIRS = 1 << 19  # pairs whose counts every task holds: 17 bytes each
CHUNK = 200_000  # characters whose results a task holds before it hands them on
KEPT_SEGMENTS, KEPT_CHARS = 300_000, 40  # a worker keeps up to twice as many segments, no longer ones
JOINED = 4000  # new segments that are encoded as one text
WIDE = 4096  # token pairs of one group from which they are counted by distinct ids
B_BITS = 20  # ids of both tokenizers are below 2 ** B_BITS, the texts of one chunk below 2 ** 23
_CUT = re.compile(r"(?<=[^\W_]|[!-~]) (?=[^\W_]|[!-~])")
_CLEAN = re.compile(r"(?:[^\W_]|[!-~])(?:.*(?:[^\W_]|[!-~]))?", re.S)


def _byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others for 256 and on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Segment(NamedTuple):
    """The groups of a stretch of text and what follows from them."""

    shown: str  # a1,a2|b1;a3|b2,b3
    n_a: int
    n_b: int
    n_groups: int
    pairs: bytes  # id of A << B_BITS | id of B, of every pair of tokens that share a group, 8 bytes each
    wide: dict[int, int] | None  # the same for groups with more than WIDE pairs: how often each pair is there


class Aligner:
    """Aligns texts segment by segment; segments seen lately are kept.

    A segment ends before a single space between letters, digits or ASCII signs.  Both tokenizers cut there whatever stands
    around it: byte-level pre-tokenisation joins a space to what follows it, and no piece of B holds
    a space behind its first character.  Where either does not hold of the given files, texts are one
    segment.  For the same reason the new segments of many texts are encoded as one text, with a space between them.
    """

    def __init__(self, path_a: str, path_b: str):
        self.one, self.two = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.one.encode_special_tokens = True
        alphabet = _byte_alphabet()
        self.bytes_a = [b""] * self.one.get_vocab_size()
        for token, at in self.one.get_vocab().items():
            self.bytes_a[at] = bytes(map(alphabet.__getitem__, token)) if alphabet.keys() >= set(token) else token.encode()
        names = [self.two.id_to_piece(i) for i in range(self.two.get_piece_size())]
        self.fallback = np.array([self.two.is_byte(i) for i in range(len(names))])
        self.bytes_b = [bytes([int(x[3:5], 16)]) if byte else x.replace("▁", " ").encode() for x, byte in zip(names, self.fallback)]
        cut = json.loads(self.one.to_str())
        plain = cut["normalizer"] is None and cut["pre_tokenizer"]["type"] == "ByteLevel" and cut["pre_tokenizer"]["use_regex"] and not cut["pre_tokenizer"]["add_prefix_space"]
        self.splits = plain and not any("▁" in x[1:] and x.strip("▁") for x in names)
        if max(len(self.bytes_a), len(names)) > 1 << B_BITS:
            raise ValueError(f"vocabularies of at most {1 << B_BITS} tokens")
        self.shown = pa.concat_arrays([_written(len(self.bytes_a), ",", "|"), _written(len(names), ",", ";")])
        self.young: dict[str, Segment | None] = {}
        self.old: dict[str, Segment | None] = {}

    def align(self, texts: list[str]) -> list[list[Segment]]:
        """The segments of each text; none for an empty one, and where the bytes of either tokenizer are not those of the text behind a space."""
        gc.disable()  # collections would walk all kept segments again and again
        try:
            return self._aligned(texts)
        finally:
            gc.enable()

    def _aligned(self, texts: list[str]) -> list[list[Segment]]:
        parts = [(_CUT.split(t) if self.splits else [t]) if t else [] for t in texts]
        known, new = {}, []
        for part in set(chain.from_iterable(parts)):
            if part in self.young:
                known[part] = self.young[part]
            elif part in self.old:
                known[part] = self.young[part] = self.old[part]
            else:
                new.append(part)
        clean = [x for x in new if self.splits and _CLEAN.fullmatch(x)]
        for lo in range(0, len(clean), JOINED):
            some = clean[lo : lo + JOINED]
            known.update(zip(some, self._encoded(some) or [(self._encoded([x]) or [None])[0] for x in some]))
        known.update((x, (self._encoded([x]) or [None])[0]) for x in new if x not in known)
        self.young.update((x, known[x]) for x in new if len(x) <= KEPT_CHARS)
        if len(self.young) >= KEPT_SEGMENTS:
            self.young, self.old = {}, self.young
        found = ([known[x] for x in text] for text in parts)
        return [x if None not in x else [] for x in found]

    def _encoded(self, parts: list[str]) -> list[Segment] | None:
        """The segments of parts that are encoded as one text; None where a tokenizer does not give its bytes back."""
        text = " ".join(parts)
        raw, coded = (" " + text).encode(), self.one.encode(" " + text, add_special_tokens=False)
        pieces = self.two.encode(text, return_type="proto").pieces
        a, b = coded.ids, [p.id for p in pieces]
        bytes_a, bytes_b = [*map(self.bytes_a.__getitem__, a)], [*map(self.bytes_b.__getitem__, b)]
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            return None
        spans = np.fromiter(chain.from_iterable(coded.offsets), np.int64, 2 * len(a)).reshape(-1, 2)
        at = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)  # the first byte of each character
        ends_a, ends_b = np.append(at, len(raw))[spans[:, 1]], np.array([p.end for p in pieces]) + 1  # the space before the text
        if (odd := np.append(spans[1:, 0] < spans[:-1, 1], False)).any():  # ends inside a character: the next one begins before
            ends_a[odd] = np.cumsum([*map(len, bytes_a)])[odd]
        a, b = np.array(a), np.array(b)
        if (odd := self.fallback[b]).any():
            ends_b[odd] = np.cumsum([*map(len, bytes_b)])[odd]
        return _cut(a, b, ends_a, ends_b, np.cumsum([len(x) + 1 if x.isascii() else len(x.encode()) + 1 for x in parts]), self.shown, len(self.bytes_a))


def _places(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each run of so many."""
    ends = np.cumsum(many)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + many, many)


def _cut(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, borders: np.ndarray, shown: pa.Array, ids_a: int) -> list[Segment]:
    """Groups end where both tokenizers do, segments at the borders.  ``shown`` has what ``_written`` gives for the ``ids_a`` ids of A, then for those of B."""
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    stop_a, stop_b = np.searchsorted(ends_a, common) + 1, np.searchsorted(ends_b, common) + 1
    n_a, n_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
    first_a, first_b = stop_a - n_a, stop_b - n_b
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[stop_a - 1] = last_b[stop_b - 1] = 1
    order = np.empty(len(a) + len(b), np.int64)  # the tokens of both in the order in which they are written
    order[np.arange(len(a)) + np.repeat(first_b, n_a)] = 2 * a + last_a
    order[np.arange(len(b)) + np.repeat(stop_a, n_b)] = 2 * b + last_b + 2 * ids_a
    text = shown.take(pa.array(order))
    data, at = text.buffers()[2].to_pybytes().decode("ascii"), np.frombuffer(text.buffers()[1], np.int32)
    many = np.where(n_a * n_b > WIDE, 0, n_a * n_b)
    inside, by = _places(np.zeros(len(many), np.int64), many), np.repeat(n_b, many)
    pairs = (a[np.repeat(first_a, many) + inside // by] << B_BITS | b[np.repeat(first_b, many) + inside % by]).tobytes()
    ends = np.searchsorted(common, borders) + 1
    wide: dict[int, Counter] = {}
    for g in np.flatnonzero(n_a * n_b > WIDE).tolist():
        one, two = (Counter(x[k - n : k].tolist()) for x, k, n in ((a, stop_a[g], n_a[g]), (b, stop_b[g], n_b[g])))
        wide.setdefault(int(np.searchsorted(ends, g, side="right")), Counter()).update({p << B_BITS | q: n * k for p, n in one.items() for q, k in two.items()})
    to_a, to_b, paired = stop_a[ends - 1], stop_b[ends - 1], 8 * np.cumsum(many)[ends - 1]
    sizes = zip(np.diff(to_a, prepend=0).tolist(), np.diff(to_b, prepend=0).tolist(), np.diff(ends, prepend=0).tolist())
    written, paired = [0, *at[to_a + to_b].tolist()], [0, *paired.tolist()]
    return [
        Segment(data[lo : hi - 1], *size, pairs[x:y], wide.get(k))
        for k, (lo, hi, size, x, y) in enumerate(zip(written, written[1:], sizes, paired, paired[1:]))
    ]


def _written(size: int, within: str, behind: str) -> pa.Array:
    """How each id is written within its side of a group and at the end of it, two entries an id."""
    return pa.array([f"{i}{sign}" for i in range(size) for sign in (within, behind)])


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def groups_text(segments: list[Segment]) -> str:
    """``a1,a2|b1;a3|b2,b3``: ids in order, groups apart by semicolons."""
    return ";".join(x.shown for x in segments)


def links_of(texts: list[list[Segment]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct pairs and how many pairs of occurrences each stands for; all texts are counted in one sort."""
    joined = [b"".join([x.pairs for x in text]) for text in texts]
    flat = np.frombuffer(b"".join(joined), np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(x) // 8 for x in joined])
    keys, times = np.unique(owner << 2 * B_BITS | flat, return_counts=True)
    cuts = np.searchsorted(keys, np.arange(1, len(texts)) << 2 * B_BITS)
    found = list(zip(np.split(keys & (1 << 2 * B_BITS) - 1, cuts), np.split(times, cuts)))
    for k, text in enumerate(texts):
        if any([x.wide for x in text]):
            more = sum([x.wide for x in text if x.wide], Counter(dict(zip(found[k][0].tolist(), found[k][1].tolist()))))
            found[k] = np.array(sorted(more), np.int64), np.array([more[p] for p in sorted(more)], np.int64)
    return found


def ids_of(segments: list[Segment]) -> tuple[list[int], list[int], list[int], list[int]]:
    """The ids of both tokenizers and behind how many of each the groups end."""
    out = ([], [], [], [])
    for one, _, two in [g.partition("|") for x in segments for g in x.shown.split(";")]:
        out[0].extend(map(int, one.split(",")))
        out[1].extend(map(int, two.split(",")))
        out[2].append(len(out[0]))
        out[3].append(len(out[1]))
    return out


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of rows with about CHUNK characters; null is empty."""
    texts, first, size = [], 0, 0
    for k, text in enumerate(batch["text"]):
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= CHUNK:
            yield first, texts
            texts, first, size = [], k + 1, 0
    if texts:
        yield first, texts


def _lists(kind: pa.DataType, parts: list) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *parts]), kind))


def token_groups(docs: DataFrame, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B) -> DataFrame:
    """docs(doc_id, text) -> doc_id, ids_a, ids_b, cuts_a, cuts_b: the ids of both tokenizers, and behind how many tokens of each the groups end.

    Empty arrays for null and empty texts and for texts that a tokenizer does not give back byte for
    byte.  Rows repeat and keep a null doc_id as they come; other columns are ignored.
    """
    small_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for batch in batches:
            for first, texts in _chunks(batch):
                columns = [_lists(pa.int32(), [*x]) for x in zip(*map(ids_of, own.align(texts)))]
                yield pa.record_batch([batch["doc_id"].slice(first, len(texts)), *columns], names=["doc_id", "ids_a", "ids_b", "cuts_a", "cuts_b"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids_a array<int>, ids_b array<int>, cuts_a array<int>, cuts_b array<int>")


MEASURES = ("n_a", "n_b", "n_groups", "n_links")
_MEASURED = "row long, doc_id long, " + ", ".join(f"{m} long" for m in MEASURES) + ", groups_sha256 string, pairs array<long>, times array<long>"


def _measured(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    own, row = aligner(path_a, path_b), TaskContext.get().partitionId() << 40
    for batch in batches:
        for first, texts in _chunks(batch):
            numbers, digests, pairs, times = [], [], [], []
            aligned = own.align(texts)
            for x, (found, count) in zip(aligned, links_of(aligned)):
                numbers.append((sum([s.n_a for s in x]), sum([s.n_b for s in x]), sum([s.n_groups for s in x]), int(count.sum())))
                digests.append(hashlib.sha256(groups_text(x).encode()).hexdigest() if x else "")
                pairs.append(found)
                times.append(count)
            rows = pa.array(np.arange(row, row + len(texts)))
            row += len(texts)
            columns = [pa.array(c, pa.int64()) for c in zip(*numbers)] + [pa.array(digests), _lists(pa.int64(), pairs), _lists(pa.int64(), times)]
            yield pa.record_batch([rows, batch["doc_id"].slice(first, len(texts)), *columns], names=["row", "doc_id", *MEASURES, "groups_sha256", "pairs", "times"])


def pair_counts(measured: DataFrame) -> DataFrame:
    """pair, n, best: how many documents hold the pair linked, and whether no pair of its A id is held by more."""
    counts = written(measured.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    token = F.shiftright("pair", B_BITS)
    most = counts.groupBy(token.alias("a")).agg(F.max("n").alias("most"))  # as many rows as A has ids, at most
    return counts.withColumn("a", token).join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _head_from(counts: DataFrame, most: int) -> int:
    """The smallest count from which there are at most ``most`` pairs.  64 rows come to the driver for powers of two, and as many again to cut one of them."""
    total, low = 0, 1
    power = F.length(F.bin("n")) - 1
    for p, n in sorted(((r.p, r.k) for r in counts.groupBy(power.alias("p")).agg(F.count("*").alias("k")).collect()), reverse=True):
        if total + n > most:
            low = 2 ** (p + 1)
            part = F.floor((F.col("n") - 2**p) * 64 / 2**p)
            for q, k in sorted(((r.q, r.k) for r in counts.where(power == p).groupBy(part.alias("q")).agg(F.count("*").alias("k")).collect()), reverse=True):
                if total + k > most:
                    break
                total, low = total + k, 2**p + -(-q * 2**p // 64)
            break
        total += n
    return low


def _with_head(batches: Iterator[pa.RecordBatch], pairs: np.ndarray, n: np.ndarray, best: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Adds what the most frequent pairs give; the others stay in ``pairs`` and ``times``."""
    for batch in batches:
        lists, times = batch["pairs"], batch["times"].flatten().to_numpy()
        owner = np.repeat(np.arange(len(batch)), np.diff(lists.offsets.to_numpy()))
        flat = lists.flatten().to_numpy()
        at = np.minimum(np.searchsorted(pairs, flat), max(len(pairs) - 1, 0))
        hit = pairs[at] == flat if len(pairs) else np.zeros(len(flat), bool)
        sums, bests = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
        np.add.at(sums, owner[hit], times[hit] * n[at[hit]])
        np.add.at(bests, owner[hit], times[hit] * best[at[hit]])
        ends = pa.array(np.append(0, np.bincount(owner[~hit], minlength=len(batch)).cumsum()), pa.int32())
        columns = [batch[c] for c in ("row", "doc_id", *MEASURES, "groups_sha256")]
        columns += [pa.ListArray.from_arrays(ends, pa.array(v[~hit])) for v in (flat, times)] + [pa.array(bests), pa.array(sums)]
        yield pa.record_batch(columns, names=["row", "doc_id", *MEASURES, "groups_sha256", "pairs", "times", "n_best", "count_sum"])


def alignment_counts(docs: DataFrame, path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B, head: int = HEAD_PAIRS) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_links`` counts the A-B pairs of token occurrences that share a group, ``count_sum`` sums the
    corpus-wide document count of each, ``n_best`` counts those whose count is the highest of their
    A id, ties included.  Every row counts as a document, repeated rows and rows without a doc_id
    too.  Null and empty texts, and texts that a tokenizer does not give back byte for byte, have
    zeros and ''.  Very long texts are worked whole; token pairs of one long group are counted by
    distinct ids.  An empty table gives an empty result; other columns are ignored.
    """
    small_batches()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    measured = written(docs.mapInArrow(lambda it: _measured(it, path_a, path_b), _MEASURED), "aligned", compression="zstd")
    counts = written(pair_counts(measured), "pairs", compression="zstd")
    least = _head_from(counts, head)
    top = counts.where(F.col("n") >= least).toPandas().sort_values("pair")  # at most ``head`` rows
    pairs, n, best = top["pair"].to_numpy(), top["n"].to_numpy(), top["best"].to_numpy().astype(np.int64)
    part = written(measured.mapInArrow(lambda it: _with_head(it, pairs, n, best), f"{_MEASURED}, n_best long, count_sum long"), "with-head", compression="zstd")
    rare = part.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times")
    rare = rare.join(counts.where(F.col("n") < least), F.col("pairs") == F.col("pair"))
    more = rare.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    total = lambda x, y: (F.col(x) + F.coalesce(F.col(y), F.lit(0))).alias(x)
    return part.join(more, "row", "left").select("doc_id", *MEASURES, total("n_best", "more_best"), total("count_sum", "more_sum"), "groups_sha256")
