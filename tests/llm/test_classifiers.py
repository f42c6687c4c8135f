import random

import numpy as np
import pytest

from advisorium.llm.language_id import bind, fit_language_model, predict_language, trigrams
from advisorium.llm.quality import FEATURES, RIDGE, fit_quality_model, nth_smallest, score_quality, text_features
from advisorium.llm.toxicity import chain_marginals, fit_toxicity_model, score_toxicity

LETTERS = {"aa": "abcdefgh", "bb": "ghijklmn", "cc": "nopqrst"}


def words(r, letters, n):
    return " ".join("".join(r.choice(letters) for _ in range(r.randrange(2, 7))) for _ in range(n))


def test_language_held_out_and_edges(spark):
    r = random.Random(2)
    rows = [(i, words(r, LETTERS[lang], 40), lang) for i, lang in enumerate(list(LETTERS) * 20)]
    rows += [(900, None, "aa"), (901, "x", None)]
    model = fit_language_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    test = [(i, words(r, LETTERS[lang], 30), lang) for i, lang in enumerate(list(LETTERS) * 10)]
    test += [(100, None, None), (101, "", None), (102, "12 .. 二"[:5], None), (103, words(r, LETTERS["bb"], 20000), "bb")]
    got = {x.doc_id: x for x in predict_language(spark.createDataFrame(test, "doc_id long, text string, lang_pred string"), model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in test if lang)
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and all(0 <= x.score <= 1 for x in got.values())


def test_bundle_is_the_sum_of_bound_trigrams():
    g = trigrams("Ab c")
    whole = bind(g, 64, 1).sum(axis=0)
    u, n = np.unique(g, return_counts=True)
    assert np.allclose(whole, n @ bind(u, 64, 1)) and len(trigrams("...")) == 0


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    docs = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id long, text string")
    assert {r.lang_pred for r in predict_language(docs, fit_language_model(none)).collect()} == {"und"}
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert [r.score for r in score_toxicity(docs, fit_toxicity_model(docs, labels)).collect()] == [0.0, 0.0]
    assert all(0 <= r.score <= 1 for r in score_quality(docs, fit_quality_model(docs, labels)).collect())


@pytest.fixture(scope="module")
def toxic(spark):
    r = random.Random(3)
    docs, labels = [], []
    for i in range(300):
        w = words(r, "abcdefghijklmnop", r.choice([5, 40, 200])).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(["zzidiot", "zzmoron", "lowei" + r.choice(["x", "y", "qq", "rr"])]))
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_held_out_and_spans(spark, toxic):
    docs, labels = toxic
    model = fit_toxicity_model(docs, labels.where("doc_id % 3 > 0"))
    got = {r.doc_id: r for r in score_toxicity(docs, model).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [i for i in truth if i % 3 == 0]
    assert np.mean([(got[i].score >= 0.5) == bool(truth[i]) for i in held]) > 0.97
    texts = {r.doc_id: r.text for r in docs.collect()}
    spans = [texts[i][s.start : s.end] for i in held for s in got[i].spans]
    assert spans and all(s.startswith(("zz", "lowei")) for s in spans)
    edge = spark.createDataFrame([(1, None), (2, ""), (3, "ZZIDIOT"), (4, "a " * 30000 + "zzmoron")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in score_toxicity(edge, model).collect()}
    assert scores[1] == scores[2] == 0 and scores[3] > 0.5 and scores[4] > 0.5
    longer = "İstanbul İİx zzmoron ẞ ΑΣ ZZIDIOT"  # lower case of the first letter is two characters
    (row,) = score_toxicity(spark.createDataFrame([(1, longer)], "doc_id long, text string"), model).collect()
    assert [longer[s.start : s.end] for s in row.spans] == ["zzmoron", "ZZIDIOT"]


@pytest.mark.parametrize("x", [[0, 0, 3, 0, 1, 2, 0], [1, 2, 0, 3], [0, 2, 1], [3, 3, 1], [2]])
def test_marginals_and_score_equal_enumeration(toxic, x):
    docs, labels = toxic
    model = fit_toxicity_model(docs, labels)
    t = np.exp(model.transition)
    e = [np.exp([0.0, model.emission[f]]) if f else np.array([1.0, 0.0]) for f in x]  # other tokens are clean with certainty
    total, clean, toxic_at = 0.0, 0.0, np.zeros(len(x))
    for code in range(2 ** len(x)):
        y = [code >> i & 1 for i in range(len(x))]
        p = np.exp(model.start[y[0]]) * np.prod([e[i][y[i]] for i in range(len(x))]) * np.prod([t[a, b] for a, b in zip(y, y[1:])])
        total += p
        clean += p if not code else 0
        toxic_at += p * np.array(y)
    at = [i for i, f in enumerate(x) if f]
    marginals, score = chain_marginals(model, at, [x[i] for i in at], len(x))
    assert np.allclose(marginals, (toxic_at / total)[at]) and np.isclose(score, 1 - clean / total)


def test_fit_climbs_the_likelihood_of_every_run():
    """The gradient that the fit uses leads to a point where enumeration finds no better neighbour."""
    import pandas as pd

    from advisorium.llm.toxicity import ToxicityModel, _fit_chain, run_marginals

    runs = pd.DataFrame({"x": [[1], [1, 2], [2], [2, 2, 1], [1]], "first": [False, True, False, False, True], "last": [False, False, True, False, False], "toxic": [1, 1, 0, 1, 0], "n": [9, 4, 7, 3, 2]})

    def likelihood(e, t, s):
        m, out = ToxicityModel({}, e, t - t[0, 0], s - s[0], 0.5), 0.0
        for r in runs.itertuples():
            log = run_marginals(m, r.x, r.first, r.last)[1]
            own = (m.start[1] if r.first else m.transition[0, 1]) + m.emission[r.x].sum() + m.transition[1, 1] * (len(r.x) - 1) + (0 if r.last else m.transition[1, 0])
            out += r.n * ((own if r.toxic else 0.0) - log)
        penalty = (e**2).sum() + (t**2).sum() + (s**2).sum()
        return out - 0.01 * penalty

    e, t, s = _fit_chain(runs, 2, rounds=4000)
    best = likelihood(e, t, s)
    for k in range(1, 3):
        for step in (-0.3, 0.3):
            moved = e.copy()
            moved[k] += step
            assert likelihood(moved, t, s) < best + 1e-6
    for at in ((0, 1), (1, 0), (1, 1)):
        for step in (-0.3, 0.3):
            moved = t.copy()
            moved[at] += step
            assert likelihood(e, moved, s) < best + 1e-6


def test_repeated_rows_and_clashing_names(spark, toxic):
    docs, labels = toxic
    wide = docs.union(docs.limit(3)).selectExpr("*", "1 as score", "'x' as toxic", "2 as label", "array(1) as spans")
    both = labels.unionByName(labels.selectExpr("doc_id", "1 - toxic as toxic").where("doc_id = 1"))  # two labels: the larger counts
    one, two = fit_toxicity_model(docs, labels.where("doc_id <> 1").union(labels.where("doc_id = 1").selectExpr("doc_id", "1"))), fit_toxicity_model(docs, both)
    assert one.lexicon == two.lexicon and np.allclose(one.emission, two.emission)
    got = score_toxicity(wide, one)
    assert got.columns == ["doc_id", "score", "spans"] and got.count() == docs.count() + 3
    assert got.groupBy("doc_id").agg({"score": "min"}).join(got.groupBy("doc_id").agg({"score": "max"}), "doc_id").where("`min(score)` <> `max(score)`").count() == 0
    quality = fit_quality_model(docs, labels.withColumnRenamed("toxic", "quality"))
    scored = score_quality(wide, quality)
    assert scored.columns == ["doc_id", "score"] and scored.count() == docs.count() + 3


def test_language_equals_brute_force(spark):
    """Every prediction and score against letter vectors bound and bundled one trigram at a time."""
    from advisorium.llm.language_id import letter_vector

    r = random.Random(5)
    letters = {"aa": "abcdé", "bb": "dефгж", "cc": "日本語文字"}
    rows = [(i, words(r, letters[lang], 12), lang) for i, lang in enumerate(list(letters) * 6)]
    rows += rows[:3] + [(90, "", "aa"), (91, None, "bb"), (92, "...", "cc")]
    d, seed = 256, 7
    model = fit_language_model(spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, lang string, score long"), d, seed)

    def vector(text):
        symbols, total = [0], np.zeros(d)
        for ch in text or "":
            symbol = ord(ch.lower()) if ch.isalpha() else 0
            if symbol or symbols[-1]:
                symbols.append(symbol)
        if symbols[-1]:
            symbols.append(0)
        for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
            total += np.roll(letter_vector(a, d, seed), 2) * np.roll(letter_vector(b, d, seed), 1) * letter_vector(c, d, seed).astype(int)
        return total

    own = {lang: sum(vector(t) for _, t, g in rows if g == lang) for lang in letters}
    test = [(i, words(r, letters[lang], 3)) for i, lang in enumerate(list(letters) * 4)] + [(50, "ab日本 zz"), (51, "B"), (51, "B"), (52, None), (53, "12")]
    for got in predict_language(spark.createDataFrame(test, "doc_id long, text string"), model).collect():
        v = vector(dict(test)[got.doc_id])
        if not v.any():
            assert (got.lang_pred, got.score) == ("und", 0.0)
            continue
        cosine = {lang: float(v @ p / np.linalg.norm(v) / np.linalg.norm(p)) for lang, p in own.items()}
        best = max(sorted(cosine), key=cosine.get)
        assert got.lang_pred == best and abs(got.score - max(0.0, cosine[best])) < 1e-5


def test_floors_keep_learned_languages_and_reject_noise(spark):
    from pyspark.sql import functions as F

    from advisorium.llm.language_id import language_of, resembles_a_language, similarity_floors

    r = random.Random(6)
    rows = [(i, words(r, LETTERS[lang], r.choice([5, 20, 80])), lang) for i, lang in enumerate(list(LETTERS) * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_language_model(docs)
    floors = similarity_floors(docs, model)
    test = [(i, words(r, LETTERS[lang], r.choice([5, 20, 80])), 1) for i, lang in enumerate(list(LETTERS) * 20)]
    test += [(100 + i, words(r, letters, 60), 0) for i, letters in enumerate(["αβγδεζη", "уфхцчшщъ", "日本語文字化け"])] + [(200, None, 0), (201, "", 0), (202, "1 2", 0)]
    p = F.col("p")
    got = spark.createDataFrame(test, "doc_id long, text string, want int").withColumn("p", language_of("text", model)).select("want", resembles_a_language("text", p, floors).alias("ok"))
    assert {(x.want, x.ok) for x in got.collect()} == {(1, True), (0, False)}


def test_floors_predict_each_text_once(spark, monkeypatch):
    """Two predictions in a row would hold two Python workers a task."""
    from advisorium.llm.language_id import similarity_floors

    docs = spark.createDataFrame([(1, "one two three", "en"), (2, "1 2", "en"), (3, "1234567", "en")], "doc_id long, text string, lang string")
    model, plans, collect = fit_language_model(docs), [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df))
    assert similarity_floors(docs, model).keys() == {3}  # texts of classes 1 and 2 have no letter
    assert [p.count("ArrowEvalPython") for p in plans] == [1]


def test_quality_held_out_and_edges(spark):
    r = random.Random(4)
    docs, labels = [], []
    for i in range(300):
        w = words(r, "abcdefghijklmnop", r.choice([10, 60, 300]))
        if i % 3 == 0:
            w = r.choice([lambda s: s.upper() + "!!", lambda s: s.replace(" ", "$$$ "), lambda s: s.replace(" ", " | "), lambda s: (s.split()[0] + " ") * 30])(w)
        docs.append((i, w))
        labels.append((i, int(i % 3 > 0)))
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    model = fit_quality_model(docs, labels.where("doc_id % 5 > 0"))
    got = {x.doc_id: x.score for x in score_quality(docs, model).collect()}
    assert np.mean([(got[i] >= 0.5) == (i % 3 > 0) for i in got if i % 5 == 0]) > 0.95
    edge = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "x" * 200000)], "doc_id long, text string")
    assert all(0 <= x.score <= 1 for x in score_quality(edge, model).collect())
    assert not text_features(None).any()


def test_quality_learns_from_every_labelled_row_and_every_pair(spark):
    """The slope over all pairs, taken one by one, is zero at the fitted weights; the threshold is the quantile of all rows."""
    r = random.Random(8)
    docs = [(i, words(r, "abcdefgh", r.choice([5, 40])) + ("$$ | X" * r.randrange(4) if i % 3 == 0 or i % 10 == 1 else "")) for i in range(240)]
    labels = [(i, int(i % 3 > 0)) for i, _ in docs]
    model = fit_quality_model(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"))
    f, good = np.stack([text_features(t) for _, t in docs]), np.array([q for _, q in labels])
    assert np.allclose(model.mean, f.mean(axis=0), atol=1e-5) and np.allclose(model.scale, f.std(axis=0), atol=1e-4)
    z = np.clip((f - model.mean) / model.scale, -8, 8)
    diff = (z[good == 1][:, None] - z[good == 0][None, :]).reshape(-1, len(FEATURES))
    slope = (diff / (1 + np.exp(np.clip(diff @ model.weights, -30, 30)))[:, None]).mean(axis=0) - RIDGE * model.weights
    assert np.abs(slope).max() < 2e-3
    order = np.sort(z @ model.weights)
    assert abs(model.threshold - (order[79] + order[80]) / 2) < 1e-2


@pytest.mark.parametrize("values", [[5], [3, 3, 3, 9], [-(2**50), 0, 7, 2**50], list(range(0, 90_000, 9))])
def test_ranks_of_whole_numbers(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "raw long")
    for n in {0, len(values) // 2, len(values) - 1}:
        assert nth_smallest(df, "raw", n) == sorted(values)[n]
