"""Near-duplicate groups by circulant MinHash.

The word n-grams of a set are hashed into D = 2**32 places.  Two permutations of these places, both
bijective 32-bit mixers, give the whole signature: ``sigma`` scatters the set once, and coordinate k
is the smallest value of ``pi`` over the places of the set moved k places round the circle,
``min pi((sigma(x) + k) mod D)``.  So no table of hash functions exists, however long the signature.

Signatures are cut into bands of ``ROWS`` coordinates; sets that agree in a band are candidates, and
candidates are confirmed on their full sets.  Two sets of similarity s disagree in all of b bands
with probability (1 - s**ROWS)**b; the number of bands follows from the threshold so that this stays
below ``MISS`` for every pair that is to be linked.  Buckets of any size are worked off by the same
steps as the keys of the n-gram join: stars first, then blocks whose pairs are bounded by their
members, exact verification, and connected components; no bucket is capped.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ngram_join import _mix, jaccard_groups

ROWS = 4  # coordinates of a band
MISS = 1e-10  # chance that a pair at the threshold shares no band
_BLOCK = 512  # places that are permuted at once, for all coordinates
_U32, _U64 = np.uint32, np.uint64


def _sigma(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U32(16))) * _U32(0x85EBCA6B)
    x = (x ^ (x >> _U32(13))) * _U32(0xC2B2AE35)
    return x ^ (x >> _U32(16))


def _pi(x: np.ndarray) -> np.ndarray:
    """The second permutation, worked out in place."""
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        x ^= x >> _U32(shift)
        x *= _U32(factor)
    x ^= x >> _U32(16)
    return x


def circulant_signature(grams: np.ndarray, count: int) -> np.ndarray:
    """``count`` coordinates (uint32) of a set of 64-bit n-gram hashes that is not empty."""
    places, shifts = _sigma((grams >> _U64(32)).astype(_U32)), np.arange(count, dtype=_U32)
    best = np.full(count, 0xFFFFFFFF, _U32)
    for lo in range(0, len(places), _BLOCK):
        np.minimum(best, _pi(places[lo : lo + _BLOCK, None] + shifts).min(axis=0), out=best)
    return best


def bands_for(similarity: float, rows: int = ROWS, miss: float = MISS) -> int:
    """The fewest bands in which a pair of this similarity disagrees throughout with probability ``miss`` at most."""
    return 1 if similarity >= 1 else math.ceil(math.log(miss) / math.log1p(-(similarity**rows)))


class Banding:
    """Sets to band keys: what ``jaccard_groups`` asks of a plan."""

    def __init__(self, similarity: float, rows: int = ROWS, miss: float = MISS):
        self.rows, self.bands = rows, bands_for(similarity, rows, miss)

    def keys(self, grams: np.ndarray) -> np.ndarray:
        if not len(grams):
            return np.empty(0, np.int64)
        parts = circulant_signature(grams, self.rows * self.bands).reshape(self.bands, self.rows).astype(_U64)
        key = np.arange(self.bands, dtype=_U64)
        for j in range(self.rows):
            key = _mix(key * _U64(0x9E3779B97F4A7C15) + parts[:, j])
        return key.view(np.int64)


def minhash_groups(docs: DataFrame, words: int = 5, threshold: tuple[int, int] = (80, 100), count_links: bool = False) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_shingles, class_id, component_id, kept (and n_links where asked for).

    ``class_id`` is the smallest doc_id with the same n-gram set, ``component_id`` the smallest that
    links reach, and ``kept`` says that the two ids of a row and its component are one.  Null, empty
    and blank texts have no n-grams, link with nothing and are kept; a text with fewer words than
    ``words`` is one n-gram; very long texts are worked whole, in blocks.  Repeated rows come back
    repeated; rows that share a doc_id but not the n-grams are compared each for itself, and
    components do not depend on the order of rows.  Rows without a doc_id take part; a group of
    nothing but such rows has null as its ids and counts as kept.  An empty table gives an empty
    result; columns other than doc_id and text are ignored.
    """
    num, den = threshold
    groups = jaccard_groups(docs, words, threshold, Banding(num / den), count_links)
    return groups.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
