import math
import random
import re
from collections import Counter

import numpy as np
import pytest

import advisorium.llm.lexical_search as m

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    total, words = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    wanted = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        best = {}
        for i, b, n in bags:
            length = 100 - 90 + (90 * n * total) // words
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1000000000 * b[t]) // (1000 * b[t] + 8 * length)) for t in own if b[t])
            if score > 0 and i is not None:
                best[i] = max(best.get(i, 0), score)
        out += [(item, r, i, s) for r, (i, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], 1)]
    return sorted(out)


def corpus(seed, n=200):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["Ñandú", "İstanbul", "日本語", "ß", "x²"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    text = lambda size: r.choice([" ", ", ", "\n", "-"]).join(r.choice([str, str.upper])(w) for w in r.choices(vocab, weights, k=size))
    docs = [(i, text(r.choice([0, 1, 5, 30, 200]))) for i in range(n)]
    docs += [(n + i, docs[i][1]) for i in range(20)] + [docs[3], docs[4], (5, "w1 w2 other"), (None, "w1 w1 w1 w2"), (500, None), (501, ""), (502, " .,;_ \x00\t"), (503, "w0_w1/w2"), (504, "w1 " * 30_000)]
    items = [(i, text(r.choice([1, 3, 8, 20]))) for i in range(25)] + [(1, "w59 w58"), (30, None), (31, ""), (32, "unseen words"), (None, "w1")]
    return docs, items


@pytest.mark.parametrize("seed,shard,depth,terms_a_pass", [(1, 10**6, 256, 10**5), (2, 300, 2, 10**5), (3, 50, 1, 30)])
def test_equals_brute_force(spark, monkeypatch, seed, shard, depth, terms_a_pass):
    docs, items = corpus(seed)
    monkeypatch.setattr(m, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(m, "DEPTH", depth)
    left = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, score int").repartition(5)
    right = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, rank int")
    for k in (1, 10):
        assert sorted(map(tuple, m.ranked_search(left, right, k, terms_a_pass).collect())) == brute(docs, items, k)


@pytest.mark.parametrize("seed", range(40))
def test_nra_equals_full_sums(monkeypatch, seed):
    monkeypatch.setattr(m, "DEPTH", 1 + seed % 5)
    r = np.random.default_rng(seed)
    size, lists, sums = 80, [], np.zeros(80, np.int64)
    for _ in range(r.integers(1, 6)):
        places = r.permutation(size)[: r.integers(1, size)]
        impacts = -np.sort(-r.integers(1, 6, len(places)))  # few values: many ties
        lists.append((places, impacts))
        sums[places] += impacts
    ids, floor = r.permutation(1000)[:size], int(r.integers(0, 9))
    found, scores = m.nra(lists, size, 7, ids, floor)
    want = sorted(((-s, i) for s, i in zip(sums.tolist(), ids.tolist()) if s >= max(floor, 1)))[:7]
    assert [(-s, i) for s, i in zip(scores.tolist(), ids[found].tolist())] == want


def test_nra_stops_before_the_end(monkeypatch):
    read = []

    class Seen(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                read.append(key.stop)
            return super().__getitem__(key)

    monkeypatch.setattr(m, "DEPTH", 4)
    places = np.arange(10_000)
    impacts = np.concatenate([np.arange(1000, 990, -1), np.ones(9990, np.int64)])
    m.nra([(places.view(Seen), impacts)], 10_000, 5, places)
    assert max(read) < 100


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert m.ranked_search(docs, items).collect() == []
    some = spark.createDataFrame([(1, "a")], docs.schema)
    result = m.ranked_search(some, spark.createDataFrame([], items.schema))
    assert result.collect() == [] and result.columns == ["item_id", "rank", "doc_id", "score"]
