"""The pipeline against a brute-force version on a small corpus."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from advisorium.llm.packing import VOCABULARY, _encoder

WORDS = {"aa": "abcdefgh", "bb": "ghijklmn"}


def shingles(text, n=5):
    w = text.encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    r = random.Random(8)
    make = lambda lang, n: " ".join("".join(r.choice(WORDS[lang]) for _ in range(r.randrange(3, 8))) for _ in range(n))
    rows, labels = [], []
    for i in range(160):
        lang = "aa" if i % 2 else "bb"
        text = make(lang, r.choice([8, 30, 90]))
        if i % 5 == 0:
            text = text + " zzidiot zzmoron zzscum"
        rows.append((i, text, lang))
        labels.append((i, int(i % 5 == 0)))
    for i in range(160, 190):
        text, lang = rows[i - 160][1:]
        rows.append((i, text, lang))  # exact copies
    for i in range(190, 230):
        w = rows[i - 190][1].split()
        if len(w) > 20:
            w[r.randrange(len(w))] = "changed"  # near copies
        rows.append((i, " ".join(w), rows[i - 190][2]))
    rows += [(300, None, None), (301, "", "aa"), (302, "123 456", None)]
    rows += [(310, "".join(r.choice("αβγδεζηθ ") for _ in range(300)), None)]  # a script that was never learned
    path = str(tmp_path_factory.mktemp("sf"))
    docs = spark.createDataFrame([(i, t, g, "s", len(t or "")) for i, t, g in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, {i: t for i, t, _ in rows}


def test_stages_equal_brute_force(spark, tables):
    path, texts = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = []
    for name, stage in cp.STAGES[:-1]:
        out = cp.written(stage(spark, docs, path), name)
        assert out.columns == docs.columns
        kept.append({r.doc_id for r in out.select("doc_id").collect()})
        docs = out
    lang, clean, single, final = kept
    assert lang == {i for i, t in texts.items() if t and any(c.isalpha() for c in t) and i != 310}
    assert clean == {i for i in lang if "zz" not in texts[i]}
    assert single == {i for i in clean if not any(j > i and texts[j] == texts[i] for j in clean)}
    parent = {i: i for i in single}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    sets = {i: shingles(texts[i]) for i in single}
    for a in single:
        for b in single:
            common = len(sets[a] & sets[b])
            if a < b and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    assert final == {i for i in single if root(i) == i} and len(final) < len(single)
    packed = cp.run(spark, path).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in packed} == {i: len(_encoder(VOCABULARY)(texts[i])) + 1 for i in final}


def test_names_and_empty_input(spark, tables):
    path, _ = tables
    assert [n for n, _ in cp.STAGES] == ["language_id", "toxicity", "exact_dedup", "near_dedup", "packing"]
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, path).collect() == []


def test_rows_are_dropped_as_rows(spark, tables):
    """Shared, missing and repeated ids, and columns named as the stages' own, lose no text."""
    path, _ = tables
    long = " ".join(f"word{k}" for k in range(60))
    rows = [(1, "a b"), (1, "c d"), (2, "a b"), (2, "a b"), (None, "a b"), (None, "e f"), (None, "e f"), (3, long), (3, long + " one"), (None, long + " two"), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, None, "s", 1, 2) for i, t in rows], "doc_id long, text string, lang string, _row string, _language int, _toxicity int")
    exact = cp.drop_exact_copies(spark, docs, path)
    assert exact.columns == docs.columns
    got = sorted((r.doc_id or 0, r.text or "") for r in exact.collect())
    assert got == sorted([(1, "c d"), (2, "a b"), (0, "e f"), (3, long), (3, long + " one"), (0, long + " two"), (5, "")])
    near = cp.drop_near_copies(spark, cp.written(exact, "exact"), path)
    assert near.columns == docs.columns
    left = [(r.doc_id, r.text) for r in near.collect()]
    assert len(left) == 5 and {t for _, t in left if t and len(t) < 9} == {"a b", "c d", "e f"} and sum(i == 3 for i, _ in left) == 1
    assert cp.keep_known_language(spark, docs, path).columns == docs.columns and cp.drop_toxic(spark, docs, path).columns == docs.columns and cp.pack(spark, docs, path).where("start = 0").count() == len(rows)


def test_exact_copies_go_by_id_where_ids_are_unique(spark, tmp_path, monkeypatch):
    calls, by_ids = [], cp.by_ids
    monkeypatch.setattr(cp, "by_ids", lambda *a: calls.append(a[2]) or by_ids(*a))
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b"), (6, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, cp.drop_exact_copies(spark, docs, "").collect())) == [(4, ""), (5, "b"), (6, "a")] and calls == ["left_anti"]
    shared = spark.createDataFrame([*rows, (6, "c"), (None, "b")], "doc_id long, text string")
    assert sorted(map(tuple, cp.drop_exact_copies(spark, shared, "").collect())) == [(4, ""), (5, "b"), (6, "a"), (6, "c")] and calls == ["left_anti"]


def test_letter_products_take_a_byte_a_dimension():
    from advisorium.llm.language_id import bind, trigrams

    grams = trigrams("some text")
    assert bind(grams, 64, 1).nbytes == 64 * len(grams)
