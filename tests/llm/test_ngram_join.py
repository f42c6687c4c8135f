import random

import pytest

from advisorium.llm.ngram_join import ngram_jaccard_groups


def brute(rows, words, num, den):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed, n=120):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [r.choice(vocab) for _ in range(60)]
    rows, bases = [], [[r.choice(vocab) for _ in range(r.choice([3, 9, 11, 20, 60, 130, 400]))] for _ in range(12)]
    for i in range(n):
        w = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5])):
            w[r.randrange(len(w))] = r.choice(vocab)
        if r.random() < 0.2:
            w += passage
        rows.append((i, " ".join(w) if r.random() > 0.1 else " ".join(w).upper()))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "one"), (n + 4, "ONE"), (n + 5, "a b"), (n + 6, "a b")]


@pytest.mark.parametrize("words,limit,seed", [(3, (90, 100), 1), (5, (80, 100), 2), (3, (80, 100), 3)])
def test_equals_brute_force(spark, words, limit, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_groups(docs, words, limit).collect()}
    assert got == brute(rows, words, *limit)


def test_large_group_of_near_copies_across_blocks(spark, monkeypatch):
    r = random.Random(5)
    base = [f"v{r.randrange(10**6)}" for _ in range(80)]
    rows = []
    for i in range(300):
        w = list(base)
        for _ in range(r.choice([1, 2, 3, 4])):
            w[r.randrange(80)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    import advisorium.llm.ngram_join as m

    monkeypatch.setattr(m, "BLOCK", 16)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_jaccard_groups(docs, 3, (90, 100)).collect()}
    assert got == brute(rows, 3, 90, 100)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_jaccard_groups(docs).collect() == []


def test_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "a b c d")], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in ngram_jaccard_groups(docs).collect()) == [(1, 1), (1, 1), (2, 1)]


def degrees(rows, words, num, den):
    """Links of each document by brute force."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    linked = lambda a, b: a and b and den * len(a & b) >= num * len(a | b)
    return {i: sum(1 for j in sets if j != i and linked(sets[i], sets[j])) for i in sets}


@pytest.mark.parametrize("words,limit,seed", [(3, (90, 100), 1), (3, (80, 100), 3)])
def test_links_of_each_document_equal_brute_force(spark, monkeypatch, words, limit, seed):
    import advisorium.llm.ngram_join as m

    rows = corpus(seed)
    rows += [(1000 + k, rows[k % 7][1]) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (4096, 5):
        monkeypatch.setattr(m, "LINK_BLOCK", block)
        assert {r.doc_id: r.n_links for r in ngram_jaccard_groups(docs, words, limit).collect()} == degrees(rows, words, *limit)


def test_every_member_of_a_group_that_all_links_counts_all(spark):
    base = " ".join(f"b{k}" for k in range(200))
    docs = spark.createDataFrame([(i, f"{base} own{i}") for i in range(60)], "doc_id long, text string")
    assert {r.n_links for r in ngram_jaccard_groups(docs).collect()} == {59}


def unlinked_with_one_key(n, seed, change=14, size=120):
    """Texts that share a passage, hence keys, and lie just under the limit from each other; some groups of near copies among them."""
    r = random.Random(seed)
    base = [f"p{k}" for k in range(size)]
    rows = []
    for i in range(n):
        w = list(base)
        for at in r.sample(range(0, size, 3), change):
            w[at] = f"u{i}x{at}"
        rows.append((i, " ".join(w)))
        if i % 9 == 0:
            w[r.randrange(size)] = f"n{i}"
            rows.append((n + i, " ".join(w)))
    return rows


@pytest.mark.parametrize("change", [2, 3, 14])
def test_one_key_with_many_unlinked_texts_gives_few_rows(spark, monkeypatch, change):
    import advisorium.llm.ngram_join as m

    rows = unlinked_with_one_key(250, change, change)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = {}
    keep = m.written

    def counted(df, label, **options):
        out = keep(df, label, **options)
        made[label] = max(made.get(label, 0), out.count())
        return out

    monkeypatch.setattr(m, "written", counted)
    for block in (8192, 60):
        monkeypatch.setattr(m, "BLOCK", block)
        got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_jaccard_groups(docs, 3, (90, 100), count_links=False).collect()}
        assert got == brute(rows, 3, 90, 100)
    assert made["nearest"] <= (m.PER_MEMBER + 1) * made["blocks"] and made.get("uniting", 0) <= made["blocks"]


def test_in_place_verification_equals_all_pairs():
    """A block whose pairs all pass the sketches: exactly the components that brute force finds."""
    import numpy as np
    import pyarrow as pa

    import advisorium.llm.ngram_join as m

    rows = unlinked_with_one_key(90, 4, 3)
    sets = [m.shingle_hashes(t, 3) for _, t in rows]
    table = pa.table({
        "key": [1] * len(rows), "bi": [0] * len(rows), "bj": [0] * len(rows), "block": [0] * len(rows), "id": [i for i, _ in rows], "comp": [i for i, _ in rows],
        "n": [len(s) for s in sets], "wide": [m._sketches(s)[1] for s in sets], "grams": [s.view(np.int64) for s in sets],
    })
    edges = m._uniting(table, 90, 100).to_pylist()
    want = {i: c for i, (_, c) in brute(rows, 3, 90, 100).items()}
    parent = {i: i for i in want}
    for e in edges:
        lo, hi = sorted((parent[e["a"]], parent[e["b"]]))
        assert lo != hi  # every edge joins two components
        parent = {i: lo if p == hi else p for i, p in parent.items()}
    assert parent == want


def test_missing_and_shared_ids(spark):
    base = " ".join(f"b{k}" for k in range(200))
    rows = [(1, f"{base} x1"), (1, "another text of words"), (2, f"{base} x2"), (None, f"{base} x3"), (None, "alone with words here"), (3, "another text of words")]
    got = ngram_jaccard_groups(spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n long")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.n_links) for r in got) == [(0, 2, None, 0), (0, 199, 1, 2), (1, 2, 1, 1), (1, 199, 1, 2), (2, 199, 1, 2), (3, 2, 1, 1)]


def test_very_long_text(spark):
    r = random.Random(3)
    w = [f"w{r.randrange(10**6)}" for _ in range(60_000)]
    rows = [(1, " ".join(w)), (2, " ".join(w[:-900])), (3, " ".join(w[:30_000]))]
    got = {x.doc_id: x.component_id for x in ngram_jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_components_take_no_round_to_see_that_they_are_done(spark, monkeypatch):
    from advisorium.llm import components

    rounds, written = [], components.written
    monkeypatch.setattr(components, "written", lambda df, label: rounds.append(label) or written(df, label))
    found = lambda edges: dict(map(tuple, components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found([(1, 2), (3, 1), (1, 2), (7, 7), (5, 9)]) == {1: 1, 2: 1, 3: 1, 5: 5, 9: 5} and rounds == ["edges"]
    assert found([(k, k + 1) for k in range(20)] + [(40, 30), (40, 35)]) == {k: 0 for k in range(21)} | {k: 30 for k in (30, 35, 40)}
