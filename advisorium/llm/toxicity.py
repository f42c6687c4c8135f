"""Toxic spans with a linear-chain conditional random field.

Only whole documents carry labels, so tokens are labelled first: words and word beginnings that
are far more frequent in toxic than in clean documents make a lexicon, and a token of a toxic
document that is in it is labelled toxic.  A two-label chain (clean, toxic) is then fitted on these
token sequences.  Tokens outside the lexicon are never labelled toxic, and the chain knows that:
they are clean with certainty.  It therefore falls apart into runs of lexicon tokens between clean
ones, in fitting as in scoring, and the forward and backward passes over a whole text, of any
length, step through those runs alone and stay exact.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample, small_batches, written

TOKEN = re.compile(r"\w+")


def lowered(text: str) -> str:
    """Lower case, character by character: a letter whose lower case is longer stays, so places in the text are the same."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) > 1 else c.lower() for c in text)


PREFIXES = (4, 5, 6)
SAMPLE_ROWS = 20_000  # labelled documents that the model is fitted on, at most
EVIDENCE = 20.0  # about one chance entry in 100,000 candidates
SURE = 36.0
ODDS = 3.7  # about 40 times more frequent in toxic documents
CACHED_RUNS = 50_000  # of a task
RUN = 64  # lexicon tokens in a row; longer runs are cut there for fitting, not for scoring


def _marks(word: str) -> list[str]:
    """The word and its beginnings, the longest first."""
    return [word] + [word[:k] + "*" for k in reversed(PREFIXES) if len(word) > k]


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: dict[str, int]  # a word, or a beginning with a star
    emission: np.ndarray  # log weight of "toxic" for each entry, 0 is not used
    transition: np.ndarray  # 2 x 2 log weights, clean to clean is 0
    start: np.ndarray  # log weights of the first token's labels, clean is 0
    threshold: float  # marginal from which a token belongs to a span


def feature_of(lexicon: dict[str, int], word: str) -> int:
    """The longest entry that covers the word; 0 if none does.  One rule for fitting and for scoring."""
    return next((lexicon[m] for m in _marks(word) if m in lexicon), 0)


def runs_of(features: list[int]) -> list[tuple[int, int]]:
    """(start, end) of the runs of lexicon tokens."""
    out: list[tuple[int, int]] = []
    for i, f in enumerate(features):
        if f:
            if out and out[-1][1] == i:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((i, i + 1))
    return out


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for pdf in batches:
        for text, toxic in zip(pdf["text"], pdf["toxic"]):
            seen = set(TOKEN.findall(lowered(text)))
            counts[int(toxic)].update({m for w in seen for m in _marks(w)})
    marks = list(counts[0].keys() | counts[1].keys())
    if marks:
        yield pd.DataFrame({"mark": marks, "clean": [counts[0][m] for m in marks], "toxic": [counts[1][m] for m in marks]})


def _ratio(t: np.ndarray, c: np.ndarray, n_toxic: float, n_clean: float) -> np.ndarray:
    """Log-likelihood ratio of entries found in t toxic and c clean documents."""
    share = n_toxic / max(1.0, n_toxic + n_clean)
    part = lambda x, p: np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / np.maximum((t + c) * p, 1e-9)), 0.0)
    return np.where(t / max(n_toxic, 1) > c / max(n_clean, 1), 2 * (part(t, share) + part(c, 1 - share)), 0.0)


def cover(toxic_docs: list[np.ndarray], clean: np.ndarray, n_clean: int) -> list[int]:
    """Entries that are certain by themselves, then entries that explain documents in which none of those occurs.

    Each round takes the entry with the most evidence among the documents that nothing chosen
    explains, so rare words that only ride along with chosen ones are left out.
    """
    size = len(clean)
    counts = lambda docs: np.bincount(np.concatenate([np.empty(0, int), *docs]), minlength=size)
    chosen = np.flatnonzero(_ratio(counts(toxic_docs), clean, len(toxic_docs), n_clean) > SURE).tolist()
    left = [d for d in toxic_docs if not np.isin(d, chosen).any()]
    while left and size:
        ratio = _ratio(counts(left), clean, len(left), n_clean)
        best = int(ratio.argmax())
        if ratio[best] < EVIDENCE:
            break
        chosen.append(best)
        left = [d for d in left if best not in d]
    return chosen


def _lexicon(sample: DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """Candidates that are clearly more frequent in toxic documents, then those of them that explain the documents."""
    texts = written(sample.groupBy("text").agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id")), "tox-distinct")
    sums = texts.mapInPandas(_word_counts, "mark string, clean long, toxic long").groupBy("mark").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    t, c, share = F.col("t"), F.col("c"), n_toxic / max(1, n_toxic + n_clean)
    odds = F.log((t + 0.5) / (n_toxic + 1)) - F.log((c + 0.5) / (n_clean + 1))
    ratio = 2 * (t * F.log(t / ((t + c) * share)) + F.when(c > 0, c * F.log(c / ((t + c) * (1 - share)))).otherwise(0.0))
    kept = sums.where("t >= 3").withColumn("odds", odds).withColumn("ratio", ratio).where(f"odds > {ODDS} and ratio > {EVIDENCE / 2}")
    rows = kept.orderBy(F.desc("ratio"), "mark").collect()  # bounded by the sample
    marks, number = [r.mark for r in rows], {r.mark: k for k, r in enumerate(rows)}

    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [sorted({number[m] for w in set(TOKEN.findall(lowered(x))) for m in _marks(w) if m in number}) for x in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "hits": found})

    docs = texts.where("toxic = 1").mapInPandas(hits, "doc_id long, hits array<int>").orderBy("doc_id").toPandas()  # bounded by the sample
    return [marks[k] for k in cover([np.asarray(h, int) for h in docs["hits"]], np.array([r.c for r in rows], float), n_clean)]


def _runs(batches: Iterator[pd.DataFrame], lexicon: dict[str, int]) -> Iterator[pd.DataFrame]:
    """Every run of lexicon tokens of every text: feature numbers, and whether it begins and ends the text."""
    for pdf in batches:
        rows = []
        for text, toxic in zip(pdf["text"], pdf["toxic"]):
            x = [feature_of(lexicon, w) for w in TOKEN.findall(lowered(text))]
            for lo, hi in runs_of(x):
                for at in range(lo, hi, RUN):
                    end = min(hi, at + RUN)
                    rows.append((x[at:end], at == 0, end == len(x), int(toxic)))
        yield pd.DataFrame(rows, columns=["x", "first", "last", "toxic"])


def _fit_chain(runs: pd.DataFrame, size: int, rounds: int = 80) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradient ascent on the conditional log-likelihood of all runs: observed minus expected feature counts.

    ``runs`` has x, first, last, toxic and n, the number of times that the run occurs.  Before a run
    that does not begin its text and behind one that does not end it stands a clean token.
    """
    emission, transition, start = np.zeros(size + 1), np.zeros((2, 2)), np.zeros(2)
    grads: list = [None] * 3
    groups = []
    for width, part in runs.groupby(runs["x"].map(len)):
        groups.append((width, np.stack(part["x"].to_numpy()), *(part[c].to_numpy() for c in ("first", "last")), part["toxic"].to_numpy().astype(int), part["n"].to_numpy(float)))
    use = np.ones(size + 1)
    for _, x, _, _, _, n in groups:
        use += np.bincount(x.ravel(), np.repeat(n, x.shape[1]), size + 1)
    for _ in range(rounds):
        slope_e, slope_t, slope_s = np.zeros(size + 1), np.zeros((2, 2)), np.zeros(2)
        t, s = np.exp(transition), np.exp(start)
        for w, x, first, last, y, n in groups:
            p = np.stack([np.ones(x.shape), np.exp(emission[x])], axis=2)
            enter, leave = np.where(first[:, None], s, t[0]), np.where(last[:, None], 1.0, t[:, 0])
            f, b = np.empty(p.shape), np.empty(p.shape)
            f[:, 0] = enter * p[:, 0]
            f[:, 0] /= f[:, 0].sum(axis=1, keepdims=True)
            for i in range(1, w):
                f[:, i] = f[:, i - 1] @ t * p[:, i]
                f[:, i] /= f[:, i].sum(axis=1, keepdims=True)
            b[:, -1] = leave
            for i in range(w - 2, -1, -1):
                joint = f[:, i, :, None] * t * (p[:, i + 1] * b[:, i + 1])[:, None, :]
                slope_t -= (joint / joint.sum(axis=(1, 2), keepdims=True) * n[:, None, None]).sum(axis=0)
                b[:, i] = (p[:, i + 1] * b[:, i + 1]) @ t.T
                b[:, i] /= b[:, i].sum(axis=1, keepdims=True)
            marg = f * b
            marg = marg / marg.sum(axis=2, keepdims=True)
            slope_e += np.bincount(x.ravel(), ((y[:, None] - marg[:, :, 1]) * n[:, None]).ravel(), size + 1)
            slope_t[1, 1] += (n * y).sum() * (w - 1)
            slope_t[0, 0] += (n * (1 - y)).sum() * (w - 1)
            seen = np.stack([1 - y, y], axis=1)
            slope_s += ((seen - marg[:, 0]) * (n * first)[:, None]).sum(axis=0)
            slope_t[0] += ((seen - marg[:, 0]) * (n * ~first)[:, None]).sum(axis=0)
            slope_t[:, 0] += ((seen - marg[:, -1]) * (n * ~last)[:, None]).sum(axis=0)
        slope_t[0, 0] = slope_s[0] = 0.0  # only differences count, so these two stay 0
        total = max(1.0, sum(g[5].sum() for g in groups))
        for k, (value, slope, scale) in enumerate(((emission, slope_e, np.sqrt(use)), (transition, slope_t, np.sqrt(total)), (start, slope_s, np.sqrt(total)))):
            slope = (slope - 0.02 * value) / scale
            grads[k] = slope**2 + (1e-9 if grads[k] is None else grads[k])
            value += 0.5 * slope / np.sqrt(grads[k] + 1e-9)
    return emission, transition, start


def fit_toxicity_model(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = 0.5) -> ToxicityModel:
    """docs(doc_id, text), labels(doc_id, toxic): fitted on at most ``sample_rows`` rows, half of them toxic where there are as many."""
    small_batches()
    sample = written(labelled_sample(docs, labels, "toxic", sample_rows, by_class=True), "tox-sample")
    by = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    lexicon = {m: i + 1 for i, m in enumerate(_lexicon(sample, by.get(1, 0), by.get(0, 0)))} if by.get(1) and by.get(0) else {}
    runs = sample.mapInPandas(lambda it: _runs(it, lexicon), "x array<int>, first boolean, last boolean, toxic int")
    got = runs.groupBy("x", "first", "last", "toxic").agg(F.count("*").alias("n")).orderBy("x", "first", "last", "toxic").toPandas()  # bounded by the sample
    if not len(got) or not lexicon:
        return ToxicityModel({}, np.zeros(1), np.zeros((2, 2)), np.zeros(2), threshold)
    emission, transition, start = _fit_chain(got, len(lexicon))
    return ToxicityModel(lexicon, emission, transition, start, threshold)


def run_marginals(model: ToxicityModel, features: list[int], first: bool, last: bool) -> tuple[np.ndarray, float]:
    """The toxic marginal of each token of a run, by forward-backward, and the log of Z over the weight of all tokens being clean."""
    t, emit = np.exp(model.transition - model.transition[0, 0]), np.exp(np.stack([np.zeros(len(features)), model.emission[features]], axis=1))
    state = (np.exp(model.start - model.start[0]) if first else t[0]) * emit[0]
    forward, log = [], 0.0
    for k in range(len(features)):
        if k:
            state = state @ t * emit[k]
        log += float(np.log(state.sum()))
        state = state / state.sum()
        forward.append(state)
    back = np.ones(2) if last else t[:, 0]
    log += float(np.log(state @ back))
    backward = [back]
    for k in range(len(features) - 1, 0, -1):
        back = t @ (emit[k] * back)
        back = back / back.sum()
        backward.append(back)
    both = np.array(forward) * np.array(backward[::-1])
    return both[:, 1] / both.sum(axis=1), log


def chain_marginals(model: ToxicityModel, at: list[int], features: list[int], length: int, known: dict | None = None) -> tuple[np.ndarray, float]:
    """The toxic marginal of each lexicon token of a text with ``length`` tokens, and the chance that any token is toxic: 1 - Z(all clean) / Z."""
    known, marginals, log, k = {} if known is None else known, [], 0.0, 0
    while k < len(at):
        end = k + 1
        while end < len(at) and at[end] == at[end - 1] + 1:
            end += 1
        key = (tuple(features[k:end]), at[k] == 0, at[end - 1] == length - 1)
        if key not in known:
            known[key] = run_marginals(model, list(key[0]), *key[1:])
        marginals.append(known[key][0])
        log += known[key][1]
        k = end
    return np.concatenate(marginals) if marginals else np.empty(0), float(-np.expm1(-log))


def _score(texts: pd.Series, model: ToxicityModel, words: set[str], heads: list[tuple[int, set[str]]], cache: dict[str, int], known: dict) -> pd.DataFrame:
    scores, found = [], []
    for text in texts:
        text = text or ""
        tokens = TOKEN.findall(lowered(text))
        hits = {w for w in set(tokens) if w in words or any(w[:k] in s and len(w) > k for k, s in heads)}
        score, spans = 0.0, []
        if hits:
            for w in hits - cache.keys():
                cache[w] = feature_of(model.lexicon, w)
            at = [i for i, w in enumerate(tokens) if w in hits]
            if len(known) > CACHED_RUNS:
                known.clear()
            marg, score = chain_marginals(model, at, [cache[tokens[i]] for i in at], len(tokens), known)
            score = min(1.0, max(0.0, score))
            if (marg >= model.threshold).any():
                places = [m.span() for m in TOKEN.finditer(lowered(text))]
                spans = [(*places[i], float(p)) for i, p in zip(at, marg) if p >= model.threshold]
        scores.append(score)
        found.append(spans)
    return pd.DataFrame({"score": scores, "spans": found})


def toxicity_of(text: Column | str, model: ToxicityModel) -> Column:
    """The struct (score, spans(start, end, marginal)) of a text column.

    ``score`` is the chance that at least one token is toxic, 1 - Z(all clean) / Z; spans are
    character offsets of the tokens over the threshold.  Null and empty texts score 0 without
    spans, and so does every text if there was nothing to learn from.  Equal texts score alike.
    """

    small_batches()

    @F.pandas_udf("score double, spans array<struct<start:int,end:int,marginal:double>>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = {m for m in model.lexicon if not m.endswith("*")}
        heads = [(k, {m[:-1] for m in model.lexicon if m.endswith("*") and len(m) == k + 1}) for k in PREFIXES]
        cache: dict[str, int] = {}
        known: dict = {}
        for texts in batches:
            yield _score(texts, model, words, [(k, s) for k, s in heads if s], cache, known)

    return score(text)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """docs(doc_id, text) -> doc_id, score, spans; an empty table gives an empty result, other columns are not read."""
    return docs.select("doc_id", toxicity_of("text", model).alias("p")).select("doc_id", "p.score", "p.spans")
