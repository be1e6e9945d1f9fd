"""Quality classifier: regularised quadratic discriminant analysis.

Each text becomes a short vector of transformed statistics (``features``).
Per class the count, mean and covariance come from one partial aggregate over
all labelled training rows (sums of products, so they merge and nothing is
sampled). The covariances are shrunk towards a multiple of the identity on
pooled, standardised features, factored once (Cholesky), and a text's score
is the logistic of the difference of the two log densities plus the log prior
odds: squared Mahalanobis distances by triangular solves.

Nulls and edge cases: null, empty and blank texts have the zero-word vector
and get a score like any other; a row with a null id is scored, is not held
out and never has a label; a document with several label rows has the
majority label (1 on a tie); null labels are skipped. If the training labels
have one class only, every score is 1 or 0, that class; with none it is 0.5.
Repeated rows are scored each. Only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import fold, written
from linefold.llm.textstats import word_counts

UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
MARKS = b".,;:!?"
#: transformed statistics, in the order ``features`` gives them
FEATURES = ("log_words", "word_length", "word_length_spread", "symbols", "dup_lines", "repeats", "upper", "digits",
            "marks", "variety", "words_per_line", "short_words")
SHRINKAGE = 0.05
PRIOR = 10  # words


def features(text: bytes | None) -> list[float]:
    n, chars, symbols, dup, repeats, lines = word_counts(text)
    if not n:
        return [0.0] * len(FEATURES)
    words = text.split()
    length = np.fromiter(map(len, words), np.int64, n)
    has = lambda kind: len(text) - len(text.translate(None, kind))
    # a few words say little: shares and means of short texts are drawn to fixed values
    w, c = n + PRIOR, len(text) + 6 * PRIOR
    return [math.log1p(n), (chars + 5 * PRIOR) / w, math.log1p(float(length.std()) * n / w), math.asinh(10 * symbols / w), dup / (lines + 5),
            repeats / w, math.sqrt(has(UPPER) / c), math.sqrt(has(DIGITS) / c), math.sqrt(has(MARKS) / w), math.log((len(set(words)) + PRIOR) / w),
            math.log1p(n / lines), float((length <= 3).sum()) / w]


def with_features(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, f array<double>) of each row."""
    schema = docs.select(F.col(doc_id).alias("id"), F.array(F.lit(0.0)).alias("f")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = pa.array([features(t) for t in b.column(1).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), f], names=["id", "f"])

    return docs.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("t")).mapInArrow(run, schema)


def labels_of(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """(id, y): the majority label of each document that has one."""
    return (labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("id"))
            .agg((F.avg(label) >= 0.5).cast("int").alias("y")))


class Model(NamedTuple):
    shift: np.ndarray  # features are standardised by these two
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]  # inverse Cholesky factors of the class covariances
    offsets: list[float]  # log prior minus half the log determinant


def fit(train: DataFrame, shrinkage: float = SHRINKAGE) -> Model | float:
    """From rows (f, y); a number if there are not two classes to tell apart."""
    d = len(FEATURES)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    f = [F.col("f")[i] for i in range(d)]
    rows = (train.select("y", *[x.alias(f"x{i}") for i, x in enumerate(f)]).groupBy("y")
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(d)],
                 *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i, j in pairs]).collect())  # a row per class
    if len(rows) < 2:
        return float(rows[0]["y"]) if rows else 0.5
    n, means, covs = [], [], []
    for r in sorted(rows, key=lambda r: r["y"]):
        m = np.array([r[f"s{i}"] for i in range(d)]) / r["n"]
        c = np.zeros((d, d))
        for i, j in pairs:
            c[i, j] = c[j, i] = r[f"p{i}_{j}"] / r["n"] - m[i] * m[j]
        n.append(r["n"])
        means.append(m)
        covs.append(c)
    share = np.array(n) / sum(n)
    shift = share[0] * means[0] + share[1] * means[1]
    pooled = sum(w * (np.diag(c) + (m - shift) ** 2) for w, c, m in zip(share, covs, means))
    scale = np.sqrt(np.maximum(pooled, 1e-12))
    factors, offsets = [], []
    for w, c in zip(share, covs):
        c = c / np.outer(scale, scale)
        c = (1 - shrinkage) * c + shrinkage * max(np.trace(c) / d, 1e-6) * np.eye(d)
        low = np.linalg.cholesky(c)
        factors.append(np.linalg.inv(low))
        offsets.append(float(math.log(w) - np.log(np.diag(low)).sum()))
    return Model(shift, scale, [(m - shift) / scale for m in means], factors, offsets)


def scores(model: Model | float, f: np.ndarray) -> np.ndarray:
    if isinstance(model, float):
        return np.full(len(f), model)
    z = (f - model.shift) / model.scale
    density = [o - 0.5 * (((z - m) @ k.T) ** 2).sum(axis=1) for m, k, o in zip(model.means, model.factors, model.offsets)]
    return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def classify(docs: DataFrame, labels: DataFrame, held_out: int, folds: int, doc_id: str = "doc_id", text: str = "text",
             label: str = "quality", threshold: float = 0.3) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted. Labels of
    rows in fold ``held_out`` of ``folds`` (by crc32 of the id) are not seen."""
    rows = written(with_features(docs, doc_id, text), "features")
    train = rows.join(labels_of(labels, doc_id, label).filter(fold("id", folds) != held_out), "id")
    model = fit(train)
    schema = rows.select("id", F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores(model, f))], names=["id", "score"])

    return rows.mapInArrow(run, schema).select(
        F.col("id").alias(doc_id), F.coalesce(fold("id", folds) == held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


__all__ = ["FEATURES", "features", "with_features", "labels_of", "Model", "fit", "scores", "classify"]
