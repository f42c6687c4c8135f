import random

import numpy as np
import pytest
from test_ngram_join import brute, corpus

from advisorium.llm.minhash import Banding, _pi, _sigma, bands_for, circulant_signature, minhash_groups


@pytest.mark.parametrize("words,limit,seed", [(3, (85, 100), 1), (5, (80, 100), 2), (2, (85, 100), 3)])
def test_equals_brute_force(spark, words, limit, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, component_id string, kept int")
    found = minhash_groups(docs, words, limit).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert got == brute(rows, words, *limit)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_both_mixers_are_permutations():
    places = np.arange(1 << 20, dtype=np.uint32) * np.uint32(4093)
    assert len(np.unique(_sigma(places))) == len(np.unique(_pi(places.copy()))) == len(places)


def test_signature_is_the_shifted_permutation():
    grams = np.random.default_rng(1).integers(0, 2**64, 1500, dtype=np.uint64)
    moved = _sigma((grams >> np.uint64(32)).astype(np.uint32)).astype(np.uint64)
    want = [int(_pi(((moved + np.uint64(k)) % np.uint64(2**32)).astype(np.uint32)).min()) for k in range(70)]
    assert circulant_signature(grams, 70).tolist() == want


@pytest.mark.parametrize("similarity", [0.3, 0.6, 0.85])
def test_signature_estimates_jaccard(similarity):
    r, found = np.random.default_rng(2), []
    for _ in range(60):
        common = int(2 * 400 * similarity / (1 + similarity))
        grams = r.integers(0, 2**64, 800 - common, dtype=np.uint64)
        found.append((circulant_signature(grams[:400], 128) == circulant_signature(grams[400 - common :], 128)).mean())
    assert abs(np.mean(found) - similarity) < 0.02


def test_bands_follow_from_the_threshold():
    assert (1 - 0.85**4) ** bands_for(0.85) <= 1e-10 < (1 - 0.85**4) ** (bands_for(0.85) - 1)
    assert len(Banding(0.85).keys(np.arange(9, dtype=np.uint64))) == bands_for(0.85)


def test_group_with_one_hot_band(spark):
    """A line that every text shares puts all of them into common buckets; only real copies are linked."""
    r = random.Random(4)
    line = " ".join(f"c{i}" for i in range(40))
    rows = [(i, line + " " + " ".join(f"u{r.randrange(10**6)}" for _ in range(12))) for i in range(150)]
    rows += [(200 + i, rows[i][1] + " tail") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in minhash_groups(docs, 3, (85, 100)).collect()}
    assert got == brute(rows, 3, 85, 100)


def test_missing_ids_empty_table_and_repeats(spark):
    kind = "doc_id long, text string"
    assert minhash_groups(spark.createDataFrame([], kind)).collect() == []
    rows = [(None, "a b c d e f g h"), (None, "A B C D E F G H"), (7, "q"), (7, "q"), (8, "q"), (9, "x " * 30_000)]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash_groups(spark.createDataFrame(rows, kind)).collect()), key=str)
    assert got == sorted([(None, None, True), (None, None, True), (7, 7, True), (7, 7, True), (8, 7, False), (9, 9, True)], key=str)
