"""Document quality from preference pairs: a Bradley-Terry model over text statistics.

Every good labelled document is preferred to every bad one, and all of these pairs count.  The chance
that a beats b is the logistic function of w . (f(a) - f(b)), so a pair depends on two scores:
each Newton step sums all labelled rows by class and score, to 1/32, and weighs the sums against each other.
All sums are of whole numbers and so the same in any order.  The threshold is the exact
quantile of all labelled scores at the share of bad documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, small_batches, written

ROUNDS = 15  # most Newton steps
RIDGE = 1e-3
ONE = 1 << 16  # features and weights as whole numbers
BIN = 27  # bits of a score within a bin: 1/32 of ONE * ONE
BINS = 1024  # on either side of 0
FEATURES = [
    "symbols", "upper", "digits", "marks", "pipes", "letters", "repeats", "distinct", "word_length", "lines", "log_words",
    "tagged_words", "top_word",
]


def text_features(text: str | None) -> np.ndarray:
    """Statistics of a whole text, each of them 0 for an empty one."""
    text = text or ""
    words = text.split()
    if not words:
        return np.zeros(len(FEATURES))
    n, w = len(text), len(words)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    ascii_counts = np.bincount(points[points < 128], minlength=128)
    upper = int(ascii_counts[65:91].sum() + ((points >= 0xC0) & (points <= 0xDE)).sum())
    letters = int(ascii_counts[65:91].sum() + ascii_counts[97:123].sum() + (points >= 0xC0).sum())
    symbols = int(ascii_counts[[35, 36, 37, 38, 42, 64, 94, 95, 96, 126, 92, 60, 62, 61, 43]].sum())
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    twins = sum(map(str.__eq__, words[1:], words[:-1]))
    ends = sum(not x[-1].isalnum() and x[-1] not in ".,;:" for x in words)
    return np.array([
        symbols / n, upper / max(1, letters), int(ascii_counts[48:58].sum()) / n, int(ascii_counts[33] + ascii_counts[63]) / n,
        int(ascii_counts[124]) / w, letters / n, twins / w, len(counts) / w**0.8, letters / w / 10, (text.count("\n") + 1) / w,
        np.log1p(w) / 10, ends / w, max(counts.values()) / w,
    ])


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    spread: float

    def score(self, features: np.ndarray) -> np.ndarray:
        raw = np.clip((features - self.mean) / self.scale, -8, 8) @ self.weights
        return 1 / (1 + np.exp(-np.clip((raw - self.threshold) / self.spread, -30, 30)))


def labelled_features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """f, quality of every labelled document, written; of several labels of a document the larger one counts."""
    rows = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("quality"))
    rows = F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows
    small_batches()

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"f": [text_features(t) for t in pdf["text"]], "quality": pdf["quality"]})

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(rows, "doc_id")
    return written(texts.select("text", "quality").mapInPandas(measure, "f array<double>, quality int"), "quality-features")


def _whole(f: pd.Series, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.rint(np.clip((np.stack(f.to_numpy()) - mean) / scale, -8, 8) * ONE).astype(np.int64)


def _by_score(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each class: the bins that have rows, their numbers of rows, and their sums of features.  At most 2 * BINS rows a class reach the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                z = _whole(pdf["f"], mean, scale)
                key = pdf["quality"].to_numpy() * (4 * BINS) + np.clip((z @ weights) >> BIN, -BINS, BINS - 1) + BINS
                found, place = np.unique(key, return_inverse=True)
                total = np.zeros((len(found), z.shape[1]), np.int64)
                np.add.at(total, place, z)
                yield pd.DataFrame({"key": found, "n": np.bincount(place, minlength=len(found)), "s": list(total)})

    parts = rows.mapInPandas(run, "key long, n long, s array<long>").groupBy("key")
    sums = sorted(parts.agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[k]).alias(f"s{k}") for k in range(len(mean))]).collect(), key=lambda r: r.key)
    out = {}
    for label in (0, 1):
        mine = [r for r in sums if r.key // (4 * BINS) == label]
        out[label] = (np.array([r.key % (4 * BINS) - BINS for r in mine]), np.array([float(r.n) for r in mine]), np.array([[float(x) for x in r[2:]] for r in mine]) / ONE)
    return out


def _weighed(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, heights: np.ndarray) -> np.ndarray:
    """The sum of heights[class, bin] * z z' over all rows."""
    width = len(mean)
    upper = np.triu_indices(width)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(upper[0]), np.int64)
        for pdf in batches:
            if len(pdf):
                z = _whole(pdf["f"], mean, scale)
                h = heights[pdf["quality"].to_numpy(), np.clip((z @ weights) >> BIN, -BINS, BINS - 1) + BINS]
                x = z / ONE
                total += np.rint(h[:, None] * x[:, upper[0]] * x[:, upper[1]] * (1 << 30)).astype(np.int64).sum(axis=0)
        yield pd.DataFrame({"s": [total]})

    tasks = rows.mapInPandas(run, "s array<long>").collect()  # one row a task
    got = [sum(r.s[k] for r in tasks) for k in range(len(upper[0]))]
    out = np.zeros((width, width))
    out[upper] = [float(x) / (1 << 30) for x in got]
    return out + out.T - np.diag(out.diagonal())


def _newton(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, n: dict[int, int]) -> np.ndarray:
    """Whole-number weights (times ONE) that the ridge-penalised mean loss over all pairs asks for."""
    w = np.zeros(len(mean))
    for _ in range(ROUNDS):
        whole = np.rint(w * ONE).astype(np.int64)
        of = _by_score(rows, mean, scale, whole)
        (low, n0, s0), (high, n1, s1) = of[0], of[1]
        lost = 1 / (1 + np.exp(np.clip((high[:, None] - low[None, :]) / 32, -30, 30)))  # the chance that the good one loses
        bend = lost * (1 - lost)
        pairs = float(n[0]) * n[1]
        slope = (s1.T @ (lost @ n0) - s0.T @ (lost.T @ n1)) / pairs - RIDGE * w
        heights = np.zeros((2, 2 * BINS))
        heights[1, high + BINS], heights[0, low + BINS] = bend @ n0 / n[0], bend.T @ n1 / n[1]
        heights[1] /= n[1]
        heights[0] /= n[0]
        heights *= min(n.values())  # so that whole numbers keep their digits
        cross = s1.T @ bend @ s0 / pairs
        curve = _weighed(rows, mean, scale, whole, heights) / min(n.values()) - cross - cross.T + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        step *= min(1.0, 3 / max(1e-12, float(np.abs(step).max())))
        w = w + step
        if np.abs(step).max() < 1e-3:
            break
    return np.rint(w * ONE).astype(np.int64)


def nth_smallest(values: DataFrame, name: str, n: int) -> int:
    """The value of rank ``n``, from 0, of a column of whole numbers: each pass counts 4,096 equal steps and goes on in the one that holds the rank."""
    low, high = values.agg(F.min(name), F.max(name)).first()
    while low < high:
        step = (high - low) // 4096 + 1
        inside = values.where(F.col(name).between(low, high)).groupBy(F.expr(f"({name} - {low}L) div {step}L").alias("b")).count()
        for b, rows in sorted((r.b, r["count"]) for r in inside.collect()):  # at most 4,096
            if n < rows:
                low, high = low + b * step, min(high, low + (b + 1) * step - 1)
                break
            n -= rows
    return low


def fit_quality_model(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """docs(doc_id, text), labels(doc_id, quality): fitted on all labelled rows."""
    width = len(FEATURES)
    rows = labelled_features(docs, labels)
    n = {0: 0, 1: 0} | {r.quality: r["count"] for r in rows.groupBy("quality").count().collect()}
    none = np.zeros(width)
    if not n[0] + n[1]:
        return QualityModel(none, np.ones(width), none, -1.0, 1.0)
    whole = lambda k: F.round(F.col("f")[k] * (1 << 20)).cast("decimal(18,0)")
    total = rows.agg(*[F.sum(whole(k)) for k in range(width)], *[F.sum(whole(k) * whole(k)) for k in range(width)]).first()
    count = n[0] + n[1]
    mean = np.array([float(x) for x in total[:width]]) / count / (1 << 20)
    scale = np.sqrt(np.maximum(0.0, np.array([float(x * count - y * y) for x, y in zip(map(int, total[width:]), map(int, total[:width]))]))) / count / (1 << 20) + 1e-9
    if not n[0] or not n[1]:
        return QualityModel(mean, scale, none, -1.0 if n[1] else 1.0, 1.0)
    weights = _newton(rows, mean, scale, n)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({"raw": _whole(pdf["f"], mean, scale) @ weights})

    raw = written(rows.mapInPandas(scored, "raw long"), "quality-scores")
    below = nth_smallest(raw, "raw", n[0] - 1)
    above = nth_smallest(raw, "raw", n[0])
    one = float(ONE) * ONE
    exact = F.col("raw").cast("decimal(19,0)")
    s, squares = (int(x) for x in raw.agg(F.sum(exact), F.sum(exact * exact)).first())
    spread = float(max(0, squares * count - s * s)) ** 0.5 / count / one / 8
    return QualityModel(mean, scale, weights / ONE, (below + above) / 2 / one, max(spread, 1e-6))


def quality_of(text: Column | str, model: QualityModel) -> Column:
    """The quality score of a text column, 0 to 1 and 0.5 at the threshold; null counts as empty, equal texts score alike."""

    small_batches()

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model.score(np.stack([text_features(t) for t in texts])))

    return score(text)


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """docs(doc_id, text) -> doc_id, score; an empty table gives an empty result, other columns are not read."""
    return docs.select("doc_id", quality_of("text", model).alias("score"))
