"""Language identification with hyperdimensional n-gram profiles.

Every letter symbol has a fixed random vector of +1 and -1.  The vector of a letter trigram is the
product of its letters' vectors, the first permuted twice and the second once (binding keeps the
order).  A text is the sum of its trigram vectors (bundling); a language is the sum over all of its
training texts.  A text gets the language whose prototype has the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

GAP = 0  # the symbol between words; every other symbol is the code point of a lower-case letter
DIMENSIONS = 512
KNOWN_GRAMS = 16_384  # trigram vectors kept ready in a task; all others are bound when met
KNOWN_LETTERS = 50_000
COUNTED_CHARS = 500_000  # of texts whose trigrams are counted together
SEED = 20_240
REJECT_QUANTILE, REJECT_SHARE = 0.001, 0.75
_BITS = 21  # of a code point


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    """The symbol of each code point: of letters the lower-case letter, of all else the gap."""
    out = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        if (ch := chr(cp)).isalpha():
            out[cp] = ord(ch.lower()[0])
    return out


def trigrams(text: str | None) -> np.ndarray:
    """The trigram numbers of a text, word gaps included; empty where it has no letter."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    code = _codes()[points]
    if not code.any():
        return np.empty(0, np.int64)
    code = np.concatenate([np.zeros(1, np.uint32), code, np.zeros(1, np.uint32)])
    code = code[np.concatenate([[True], (code[1:] != GAP) | (code[:-1] != GAP)])].astype(np.int64)
    return code[:-2] << 2 * _BITS | code[1:-1] << _BITS | code[2:]


_LETTERS: dict[tuple[int, int, int], np.ndarray] = {}


def letter_vector(symbol: int, dimensions: int, seed: int) -> np.ndarray:
    """The random vector of one letter, the same on every machine."""
    key = (symbol, dimensions, seed)
    if key not in _LETTERS:
        if len(_LETTERS) >= KNOWN_LETTERS:
            _LETTERS.clear()
        _LETTERS[key] = np.random.default_rng([seed, symbol]).integers(0, 2, dimensions, np.int8) * 2 - 1
    return _LETTERS[key]


def bind(grams: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    """A vector for each trigram: the product of its letters' vectors, the first permuted twice, the second once."""
    out = np.ones((len(grams), dimensions), np.int8)
    for turn, shift in ((2, 2 * _BITS), (1, _BITS), (0, 0)):
        symbols, at = np.unique(grams >> shift & (1 << _BITS) - 1, return_inverse=True)
        if len(symbols):
            out *= np.roll(np.stack([letter_vector(s, dimensions, seed) for s in symbols.tolist()]), turn, axis=1)[at]
    return out


@dataclass(frozen=True)
class LanguageModel:
    langs: list[str]
    prototypes: np.ndarray  # one unit vector for each language
    known: np.ndarray
    dimensions: int
    seed: int


def _gram_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A count table for each language and a few texts, so the shuffle carries counts and not texts, and a task holds little."""
    for pdf in batches:
        for lang, texts in pdf.groupby("lang")["text"]:
            size = texts.str.len().cumsum() // COUNTED_CHARS
            for _, part in texts.groupby(size):
                gram, n = np.unique(np.concatenate([np.empty(0, np.int64), *map(trigrams, part)]), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": gram, "n": n})


def fit_language_model(docs: DataFrame, dimensions: int = DIMENSIONS, seed: int = SEED) -> LanguageModel:
    """Learn from every row of docs(text, lang) with a lang and at least one letter.

    What reaches the driver is one prototype vector a language, summed on the executors from a
    count of each trigram, and KNOWN_GRAMS trigram numbers.
    """
    small_batches()
    rows = docs.where("lang is not null and text is not null").select("text", "lang")
    counts = rows.mapInPandas(_gram_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).persist()

    def bundle(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(dimensions)
        gram, n = pdf["gram"].to_numpy(), pdf["n"].to_numpy()
        for lo in range(0, len(gram), 4096):
            total += n[lo : lo + 4096] @ bind(gram[lo : lo + 4096], dimensions, seed).astype(np.float64)
        return pd.DataFrame({"lang": pdf["lang"].iloc[:1], "vector": [total / max(np.linalg.norm(total), 1e-12)]})

    found = sorted(counts.groupBy("lang").applyInPandas(bundle, "lang string, vector array<double>").collect())
    top = counts.groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(KNOWN_GRAMS).collect()
    counts.unpersist()
    vectors = np.array([r.vector for r in found], np.float32).reshape(len(found), dimensions)
    return LanguageModel([r.lang for r in found], vectors, np.array(sorted(r.gram for r in top), np.int64), dimensions, seed)


def _predict(texts: pd.Series, model: LanguageModel, vectors: np.ndarray) -> pd.DataFrame:
    langs, scores = [], []
    for text in texts:
        grams, n = np.unique(trigrams(text), return_counts=True)
        lang, score = "und", 0.0
        if len(grams) and model.langs:
            at = np.minimum(np.searchsorted(model.known, grams), len(model.known) - 1)
            there = model.known[at] == grams
            n = n.astype(np.float32)
            total = n[there] @ vectors[at[there]].astype(np.float32)
            if not there.all():
                total = total + n[~there] @ bind(grams[~there], model.dimensions, model.seed).astype(np.float32)
            cosine = model.prototypes @ total / max(float(np.linalg.norm(total)), 1e-12)
            best = int(np.argmax(cosine))
            lang, score = model.langs[best], float(min(1.0, max(0.0, cosine[best])))
        langs.append(lang)
        scores.append(score)
    return pd.DataFrame({"lang_pred": langs, "score": scores})


def language_of(text: Column | str, model: LanguageModel) -> Column:
    """The struct (lang_pred, score) of a text column.

    Null texts and texts without a letter get ``und`` and 0, and so does every text if nothing was
    learned.  Ties go to the language that sorts first.  Equal texts are scored alike.
    """

    small_batches()

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vectors = bind(model.known, model.dimensions, model.seed)
        for texts in batches:
            yield _predict(texts, model, vectors)

    return predict(text)


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """docs(doc_id, text) -> doc_id, lang_pred, score; an empty table gives an empty result, other columns are not read."""
    return docs.select("doc_id", language_of("text", model).alias("p")).select("doc_id", "p.lang_pred", "p.score")


def length_class(text: Column | str) -> Column:
    """Texts of 2**k to 2**(k+1) - 1 characters are class k; empty ones are class 0."""
    return F.floor(F.log2(F.greatest(F.length(text), F.lit(1)))).cast("int")


def similarity_floors(docs: DataFrame, model: LanguageModel, quantile: float = REJECT_QUANTILE, share: float = REJECT_SHARE) -> dict[int, float]:
    """For each length class the similarity below which a text resembles no learned language.

    That is ``share`` of a low quantile of the similarity of all learned texts of that length, so
    hardly a text of a learned language falls below it.  Short texts are less like their language
    than long ones, hence a floor for each length.  At most 32 numbers reach the driver.
    Texts without a language are left out inside the aggregate: as a filter Spark would predict each
    text twice, in two Python workers a task.
    """
    learned = docs.where("lang is not null and text is not null").select(length_class("text").alias("k"), language_of("text", model).alias("p"))
    score = F.when(F.col("p.lang_pred") != "und", F.col("p.score"))
    rows = learned.groupBy("k").agg(F.percentile_approx(score, quantile, 10_000).alias("low")).collect()
    return {r.k: share * r.low for r in rows if r.low is not None}


def resembles_a_language(text: Column | str, prediction: Column, floors: dict[int, float]) -> Column:
    """True where the predicted language is a learned one and the score reaches the floor of the text's length; lengths never learned take the nearest one's."""
    if not floors:
        return prediction["lang_pred"] != "und"
    table = F.array(*[F.lit(floors[min(floors, key=lambda f, k=k: (abs(f - k), f))]) for k in range(32)])
    return (prediction["lang_pred"] != "und") & (prediction["score"] >= F.element_at(table, length_class(text) + 1))
