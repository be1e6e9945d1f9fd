"""Language identification by rank-order n-gram profiles.

A text's letters (and the marks on them) are lower-cased one code point at a
time, everything else is a word boundary, and its runs of 1 to 3 characters
are counted; a run may start or end with one boundary, never span one. The
``PROFILE`` most frequent runs, in order of count and then of code, are the
text's profile. A language's profile is the same list over all training texts
of the language. The out-of-place distance sums, over the runs of the text's
profile, how far each is from its rank in the language's profile, or
``PROFILE`` where it has none; the nearest language wins.

Counting is exact and over whole texts: a text is read in pieces of ``CHUNK``
characters that carry the last two characters on, so memory does not grow
with its length. Training counts are partial sums per batch, then an ordinary
aggregate per (language, run): a language with most of the rows is combined
map-side. The model holds at most ``MAX_LANGUAGES`` languages (those with the
most rows) of ``PROFILE`` runs.

Nulls and edge cases: a null text and one without a letter give ``und`` with
score 0, as does any text if no language was learned; a language all of whose
training texts have no letter is not learned. Rows with a null language or a
null id are not learned from; a row with a null id is judged and not held out.
Equal distances go to the smaller language name. Repeated rows are judged
each. Only the id, text and language columns are read. The score is one minus
the distance over the largest possible one.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linefold.llm.common import fold, worker_cache

PROFILE = 400
MAX_LANGUAGES = 2000
CHUNK = 1 << 20
UNKNOWN = "und"
SPACE = 32
BITS = 21  # of a code point; three of them fit in a long


def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or mark, or else the space."""
    cache = worker_cache("language_id")
    if "letters" not in cache:
        def of(cp: int) -> int:
            c = chr(cp)
            if unicodedata.category(c)[0] not in "LM":
                return SPACE
            low = c.lower()
            return ord(low) if len(low) == 1 else cp
        cache["letters"] = np.fromiter(map(of, range(0x110000)), np.int64, 0x110000)
    return cache["letters"]


def merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Equal codes once, their counts added."""
    if len(codes) == 1:
        return codes[0], counts[0]
    out, where = np.unique(np.concatenate(codes), return_inverse=True)
    total = np.zeros(len(out), np.int64)
    np.add.at(total, where, np.concatenate(counts))
    return out, total


def gram_counts(text: str, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """(codes ascending, counts) of the runs of 1 to 3 characters of ``text``."""
    table = letter_table()
    codes, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    before = np.array([SPACE], np.int64)
    for at in range(0, len(text), chunk):
        raw = np.frombuffer(text[at:at + chunk].encode("utf-32-le", "surrogatepass"), np.uint32)
        s = np.concatenate([before, table[raw], np.full(int(at + chunk >= len(text)), SPACE)])
        gap = s == SPACE
        s = s[np.concatenate([[True], ~(gap[1:] & gap[:-1])])]  # one boundary between words
        gap = s == SPACE
        new = len(before)  # runs that end before it were counted with the last piece
        one = s[new:][~gap[new:]]
        two = (s[new - 1:-1] << BITS) | s[new:]
        lo = max(new, 2)
        three = ((s[lo - 2:-2] << 2 * BITS) | (s[lo - 1:-1] << BITS) | s[lo:])[~gap[lo - 1:-1]]
        c, n = np.unique(np.concatenate([one, two, three]), return_counts=True)
        codes, counts = map(list, zip(merged([codes[0], c], [counts[0], n])))
        before = s[-2:]
    return codes[0], counts[0]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def profile(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent codes, equal counts by code."""
    if len(codes) > size:  # only counts that can be among them
        few = counts >= np.partition(counts, len(counts) - size)[len(counts) - size]
        codes, counts = codes[few], counts[few]
    return codes[np.argsort(-counts, kind="stable")][:size]


class Profiles(NamedTuple):
    langs: list[str]     # ascending
    codes: np.ndarray    # all runs of any profile, ascending
    ranks: np.ndarray    # languages x runs, ``size`` where the profile has none
    size: int


def fit(train: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE, max_languages: int = MAX_LANGUAGES) -> Profiles:
    """From all rows with a text and a language."""
    rows = train.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("t")).filter("lang IS NOT NULL AND t IS NOT NULL")
    common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).select("lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts: dict[str, list[str]] = {}
            for one, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                texts.setdefault(one, []).append(t)
            for one, ts in texts.items():
                codes, counts = gram_counts("\n".join(ts))
                yield pa.RecordBatch.from_arrays([pa.array([one] * len(codes), pa.string()), pa.array(codes), pa.array(counts)], names=["lang", "g", "n"])

    counted = rows.join(F.broadcast(common), "lang", "left_semi").select("lang", "t").mapInArrow(count, "lang string, g bigint, n bigint")
    total = counted.groupBy("lang", "g").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "g"))
    best = total.withColumn("rank", rank).filter(F.col("rank") <= size).select("lang", "g", "rank").collect()  # at most max_languages x size
    langs = sorted({r["lang"] for r in best})
    codes = np.unique(np.array([r["g"] for r in best], np.int64))
    ranks = np.full((len(langs), len(codes) + 1), size, np.int64)
    for r in best:
        ranks[langs.index(r["lang"]), np.searchsorted(codes, r["g"])] = r["rank"] - 1
    return Profiles(langs, codes, ranks, size)


def distances(model: Profiles, runs: np.ndarray) -> np.ndarray:
    """Out-of-place distance of a text's profile to each language's."""
    at = np.searchsorted(model.codes, runs)
    at[(at == len(model.codes)) | (model.codes[np.minimum(at, len(model.codes) - 1)] != runs)] = len(model.codes)
    rank = model.ranks[:, at]
    return np.where(rank == model.size, model.size, np.abs(rank - np.arange(len(runs)))).sum(axis=1)


def judge(model: Profiles, text: str | None) -> tuple[str, float]:
    if not text or not model.langs or not has_letter(text):
        return UNKNOWN, 0.0
    runs = profile(*gram_counts(text), model.size)
    d = distances(model, runs)
    k = int(d.argmin())
    most = model.size * len(runs)
    return model.langs[k], float(most - d[k]) / most


def identify(docs: DataFrame, held_out: int, folds: int, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score. Rows in
    fold ``held_out`` of ``folds`` (by crc32 of the id) are not learned from."""
    model = fit(docs.filter(fold(doc_id, folds) != held_out), text, lang)
    schema = docs.select(F.col(doc_id).alias("id"), F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [judge(model, t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())],
                                             names=["id", "lang_pred", "score"])

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).mapInArrow(run, schema)
    return rows.select(F.col("id").alias(doc_id), F.coalesce(fold("id", folds) == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


__all__ = ["PROFILE", "gram_counts", "profile", "Profiles", "fit", "distances", "judge", "identify"]
