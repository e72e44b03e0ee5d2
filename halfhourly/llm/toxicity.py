"""Toxicity by multiple-instance learning.

A document is a bag of sentences with a label for the bag only.  A sentence's score is
logistic over its words' features (the word and its first letters); a document's is the
noisy-or of its sentences, 1 - prod(1 - p).  The likelihood of the document labels is
maximised by full-batch Adam, so the learner itself decides which sentences of a
labelled document carry the label; the offending sentences are those at 0.5 or more.

Training uses at most TRAIN_ROWS labelled documents, those whose doc_id hashes are smallest
(the sample's bound; their texts are read whole).  It runs in one task of bounded
size; the weights, at most MAX_FEATURES, are the only thing that reaches the driver.
Scoring is one pass over all texts.

Defined cases: null or empty text: no sentence, the noisy-or of none is 0; without any positive
or negative label the model scores 0 everywhere; several labels for a document: toxic if
any is; a null label is no label; labels without a document are ignored; repeated rows score alike; null
doc_id is scored, is not held out and never trains; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halfhourly.llm.common import rebatch

TRAIN_ROWS = 12_000
MIN_DOCS = 8          # training documents that must hold a feature
MIN_LIFT = 4.0        # how much more frequent it must be among toxic ones
MAX_FEATURES = 50_000
PREFIX = 4
ROUNDS = 120
RATE, DECAY, START = 0.15, 2e-3, -6.0
FOLDS = 5

_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
_WORD = re.compile(r"\w+")
SCORED = ("doc_id long, held_out boolean, score double, predicted int, n_sentences long, "
          "offending array<struct<start: long, end: long, score: double>>")


def features(word: str) -> tuple[str, ...]:
    return (word, word[:PREFIX] + "*") if len(word) > PREFIX else (word,)


def sentences(text: str) -> Iterator[tuple[int, int, set[str]]]:
    for m in _SENTENCE.finditer(text):
        words = set(_WORD.findall(m[0].lower()))
        if words:
            yield m.start(), m.end(), words


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(texts: list[str], toxic: np.ndarray) -> tuple[float, dict[str, float]]:
    """Bias and feature weights of the noisy-or model."""
    if not len(toxic) or toxic.all() or not toxic.any():
        return -50.0, {}
    seen: dict[bool, Counter] = {True: Counter(), False: Counter()}
    for text, y in zip(texts, toxic, strict=True):
        seen[bool(y)].update({f for _, _, words in sentences(text) for w in words for f in features(w)})
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    lift = {f: ((n + 0.5) / n1) / ((seen[False][f] + 0.5) / n0) for f, n in seen[True].items()
            if n + seen[False][f] >= MIN_DOCS}
    chosen = sorted((f for f, x in lift.items() if x >= MIN_LIFT), key=lambda f: (-lift[f], -seen[True][f], f))[:MAX_FEATURES]
    index = {f: i for i, f in enumerate(chosen)}
    del seen, lift
    cols, row_len, doc_len = [], [], []
    for text in texts:  # sentences without a chosen feature all score the bias; they are counted, not stored
        k = plain = 0
        for _, _, words in sentences(text):
            hit = [index[f] for w in words for f in features(w) if f in index]
            if hit:
                cols += hit
                row_len.append(len(hit))
                k += 1
            else:
                plain += 1
        doc_len.append((k, plain))
    col = np.array(cols, np.int32)
    rows = np.repeat(np.arange(len(row_len)), row_len)
    k, plain = np.array(doc_len).T
    doc = np.repeat(np.arange(len(texts)), k)
    y = toxic.astype(bool)
    w = np.zeros(len(chosen) + 1)
    w[-1] = START
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, ROUNDS + 1):
        z = w[-1] + np.bincount(rows, w[col], len(row_len))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        p0 = 1 / (1 + np.exp(-np.clip(w[-1], -30, 30)))
        log_none = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), len(texts)) + plain * np.log1p(-p0)
        none = np.exp(log_none)
        factor = np.where(y, -none / np.maximum(1 - none, 1e-6), 1.0)  # d loss / d z of a sentence, over its p
        dz = p * factor[doc]
        grad = np.r_[np.bincount(col, dz[rows], len(chosen)), dz.sum() + (plain * p0 * factor).sum()]
        grad[:-1] += DECAY * len(texts) / 1000 * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        w -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return float(w[-1]), {f: float(x) for f, x in zip(chosen, w[:-1], strict=True) if abs(x) > 1e-3}


def fit(docs: DataFrame, labels: DataFrame) -> tuple[float, dict[str, float]]:
    """Train on the labelled documents outside the held-out fold (at most TRAIN_ROWS)."""
    sample = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS))
    own = (docs.select("doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(sample), "doc_id")
           .dropDuplicates(["doc_id"]))  # TRAIN_ROWS rows at most

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        bias, weights = train(pdf["text"].tolist(), pdf["toxic"].to_numpy() == 1)
        return pd.DataFrame([("", bias), *weights.items()], columns=["feature", "weight"])
    rows = own.withColumn("all", F.lit("sample")).groupBy("all").applyInPandas(learn, "feature string, weight double").collect()
    weights = {r.feature: r.weight for r in rows}
    return weights.pop("", -50.0), weights


class _Words(dict):
    """Memo word -> weight."""

    def __init__(self, weights: dict[str, float], limit: int = 1_000_000):
        super().__init__()
        self.weights, self.limit = weights, limit

    def __missing__(self, word: str) -> float:
        if len(self) >= self.limit:
            self.clear()
        s = self[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return s


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: score, prediction and the offending sentences (code point spans)."""
    bias, weights = fit(docs, labels)

    def run(it):
        word = _Words(weights)
        for pdf in rebatch(it, "text"):
            out = []
            for text in pdf["text"]:
                spans, z = [], []
                for a, b, words in sentences(text or ""):
                    spans.append((a, b))
                    z.append(bias + sum(map(word.__getitem__, words)))
                p = 1 / (1 + np.exp(-np.clip(np.array(z), -30, 30)))
                total = float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())) if len(z) else 0.0
                out.append((total, int(total >= 0.5), len(z),
                            [(*spans[i], float(p[i])) for i in np.flatnonzero(p >= 0.5)]))
            frame = pd.DataFrame(out, columns=["score", "predicted", "n_sentences", "offending"])
            frame["offending"] = [[{"start": a, "end": b, "score": s} for a, b, s in x] for x in frame["offending"]]
            yield frame.assign(doc_id=pdf["doc_id"], held_out=pdf["held_out"])[
                ["doc_id", "held_out", "score", "predicted", "n_sentences", "offending"]]
    return docs.select("doc_id", "text", held_out().alias("held_out")).mapInPandas(run, SCORED)
