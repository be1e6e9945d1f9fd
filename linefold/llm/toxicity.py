"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only the bag has a label. A sentence's
probability is logistic in its distinct words, each of which gives the weights
of itself and of its beginnings (so that inflected forms and compounds share
what is learnt); a document's is the noisy-or of its sentences,
1 - prod(1 - p). Training fits the weights to the document labels through the
noisy-or, so it learns which sentences carry the label; scoring gives the
document's probability and the sentences that make it.

Training takes at most ``SAMPLE`` distinct labelled texts (those with the
smallest hashes) and at most ``VOCABULARY`` features, chosen by chi-square of
document counts; these two bounds size the model, whatever the corpus.
Scoring reads every whole text.

Nulls and edge cases: null, empty and wordless texts score 0; copies of a text
train once (label by majority, 1 on a tie); a row with a null id is scored, is
not held out and has no label; null labels are skipped; if the training labels
have one class only, every score is 1 or 0, that class (wordless texts 0);
with no labels every score is 0. Repeated rows are scored each. Only the id
and text columns are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import fold, written
from linefold.llm.quality_classifier import labels_of

SAMPLE = 20_000
VOCABULARY = 1_000
MIN_DOCS = 5
BEGINNINGS = (3, 4, 5, 6)  # bytes
STEPS = 300
RATE = 0.1
RIDGE = 1e-4

SENTENCE = re.compile(rb"[^.!?\n]+")
WORD = re.compile(rb"[a-z\x80-\xff]+")  # ASCII letters of lower-cased text and all else beyond ASCII


def sentences(text: bytes | None) -> Iterator[tuple[int, int, set[bytes]]]:
    """Start, end (bytes) and words of each sentence with a word."""
    for m in SENTENCE.finditer((text or b"").lower()):
        words = set(WORD.findall(m[0]))
        if words:
            yield m.start(), m.end(), words


def features(word: bytes) -> list[bytes]:
    """The word, as b"=word", and its shorter beginnings."""
    return [b"=" + word, *(word[:k] for k in BEGINNINGS if k < len(word))]


class Model(NamedTuple):
    weights: dict[bytes, float]
    bias: float


class WordWeights(dict):
    """word -> sum of its features' weights, filled as words are met."""

    def __init__(self, weights: dict[bytes, float], most: int = 500_000) -> None:
        super().__init__()
        self.weights, self.most = weights, most

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.most:
            self.clear()
        w = self[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return w


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def train_noisy_or(y: np.ndarray, doc: np.ndarray, sentence: np.ndarray, word: np.ndarray, plain: np.ndarray, n_words: int,
                   steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Word weights and bias by full-batch Adam on the noisy-or log loss.

    y: label of each document; doc: document of each sentence that holds a
    vocabulary word; sentence, word: the words of those sentences; plain: the
    number of other sentences of each document.
    """
    theta = np.zeros(n_words + 1)
    theta[-1] = -4.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        z = np.bincount(sentence, theta[word], len(doc)) + theta[-1]
        p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-theta[-1]))
        total = np.bincount(doc, softplus(z), len(y)) + plain * softplus(theta[-1])  # -log(1 - P)
        pull = np.where(y == 1, -1 / np.expm1(np.clip(total, 1e-9, 500)), 1.0) / len(y)
        dz = pull[doc] * p
        grad = np.append(np.bincount(word, dz[sentence], n_words), dz.sum() + (pull * plain).sum() * p0)
        grad[:-1] += RIDGE * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def fit(rows: DataFrame, labelled: DataFrame, sample: int = SAMPLE, vocabulary: int = VOCABULARY) -> Model | float | None:
    """From rows (id, t binary) and labels (id, y)."""
    hashed = rows.select("id", F.xxhash64("t").alias("h")).join(labelled, "id")
    chosen = (hashed.groupBy("h").agg(F.min("id").alias("id"), (F.avg("y") >= 0.5).cast("int").alias("y"))
              .orderBy("h").limit(sample))  # a bounded table, so it may be broadcast
    chosen = F.broadcast(written(chosen, "toxicity-sample-ids"))
    texts = written(rows.withColumn("h", F.xxhash64("t")).join(chosen, ["id", "h"]).dropDuplicates(["h"]).select("t", "y"), "toxicity-sample")

    def distinct_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted({f for _, _, words in sentences(t) for w in words for f in features(w)}) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.binary())), b.column(1)], names=["words", "y"])

    totals = dict(map(tuple, texts.groupBy("y").count().collect()))
    if len(totals) < 2:
        return float(next(iter(totals))) if totals else None
    n1, n0 = totals[1], totals[0]
    counted = (texts.select("t", "y").mapInArrow(distinct_features, "words array<binary>, y int")
               .select(F.explode("words").alias("w"), "y").groupBy("w").agg(F.sum("y").alias("a"), F.count(F.lit(1)).alias("n"))
               .filter(F.col("n") >= MIN_DOCS))
    a, n, total = F.col("a"), F.col("n"), n1 + n0
    chi = F.pow(a * F.lit(n0) - (n - a) * F.lit(n1), 2) * total / (n * (total - n + 1e-9) * float(n1 * n0))
    best = counted.orderBy(F.desc(chi), "w").limit(vocabulary).select("w").collect()  # bounded by vocabulary
    number = {bytes(r["w"]): k for k, r in enumerate(best)}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, sizes, plain = [], [], []
            for t in b.column(0).to_pylist():
                held = [[number[f] for w in words for f in features(w) if f in number] for _, _, words in sentences(t)]
                flat.append([x for s in held for x in s])
                sizes.append([len(s) for s in held if s])
                plain.append(len(held) - len(sizes[-1]))
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (flat, sizes)]
            yield pa.RecordBatch.from_arrays([*lists, pa.array(plain, pa.int64()), b.column(1)], names=["words", "sizes", "plain", "y"])

    # bounded by sample and vocabulary
    got = texts.select("t", "y").mapInArrow(encode, "words array<int>, sizes array<int>, plain bigint, y int").toPandas()
    word, size = (np.concatenate([np.zeros(0, np.int32), *got[c]]).astype(np.int32) for c in ("words", "sizes"))
    doc = np.repeat(np.arange(len(got)), [len(x) for x in got["sizes"]])
    sentence = np.repeat(np.arange(len(size)), size)
    weights, bias = train_noisy_or(got["y"].to_numpy(), doc, sentence, word, got["plain"].to_numpy(), len(number))
    return Model({w: float(weights[k]) for w, k in number.items()}, bias)


def score(text: bytes | None, weights: WordWeights, bias: float) -> tuple[float, list[dict]]:
    """The document's probability and its offending sentences (p >= 0.5)."""
    total, found = 0.0, []
    for start, end, words in sentences(text):
        z = bias + sum(map(weights.__getitem__, words))
        total += z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z))
        if z >= 0:
            found.append({"start": start, "end": end, "score": 1 / (1 + math.exp(-z))})
    return -math.expm1(-total), found


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def detect(docs: DataFrame, labels: DataFrame, held_out: int, folds: int, doc_id: str = "doc_id", text: str = "text",
           label: str = "toxic", threshold: float = 0.7) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted and
    ``sentences`` (byte spans and scores of offending sentences). Labels of
    rows in fold ``held_out`` of ``folds`` (by crc32 of the id) are not seen."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("t"))
    model = fit(rows, labels_of(labels, doc_id, label).filter(fold("id", folds) != held_out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = WordWeights(model.weights) if isinstance(model, Model) else None
        for b in batches:
            texts = b.column(1).to_pylist()
            if weights is not None:
                got = [score(t, weights, model.bias) for t in texts]
            else:
                got = [((model or 0.0) if next(sentences(t), None) else 0.0, []) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.float64()),
                                              pa.array([g[1] for g in got], SPANS)], names=["id", "score", "sentences"])

    out = rows.select("id", F.lit(0.0).alias("score"), F.lit(None).cast("array<struct<start:bigint,end:bigint,score:double>>").alias("sentences"))
    return rows.mapInArrow(run, out.schema).select(
        F.col("id").alias(doc_id), F.coalesce(fold("id", folds) == held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "sentences")


__all__ = ["sentences", "features", "Model", "WordWeights", "train_noisy_or", "fit", "score", "detect"]
