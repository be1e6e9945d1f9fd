"""Quality rules with adaptive thresholds.

1. Each text gets its counts (``textstats.word_counts``).
2. Fixed base rules reject what is too short or repeats itself.
3. The rows that pass feed quantile sketches, one per language, source and
   statistic. A sketch is a histogram over logarithmic buckets: a quantile is
   right within ``accuracy`` (relative), sketches merge by adding counts, and
   the result does not depend on order, partitioning or retries. So the
   sketches are an ordinary partial aggregate, and those of a language or of
   all rows are sums of the leaf sketches.
4. Each statistic's thresholds are fences around the group's median, ``reach``
   times its interquartile range (at least ``least``, for statistics that are
   almost always zero). A group of fewer than ``min_rows`` rows takes the
   thresholds of its language, a language with fewer those of all rows.
5. The thresholds are joined to the rows on (language, source), null-safe,
   and a row outside any fence is rejected.

Nulls and edge cases: a null, empty or blank text has no words and fails the
base rules; null languages and sources are groups of their own; repeated rows
are judged one by one; with no row passing the base rules there are no
thresholds and nothing more to reject. Columns of the input named like a
result column are replaced by it in ``annotate`` and ignored elsewhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linefold.llm.common import under_own_names, written
from linefold.llm.textstats import word_counts

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
ACCURACY = 0.01
TINY = 1e-6  # below it a value counts as zero
MIN_ROWS = 100
REACH = 8.0

#: statistic -> (SQL of its value, least spread, whether there is a lower fence)
RULES = {
    "word_length": ("word_chars / nullif(n_words, 0)", 0.1, True),
    "symbol_share": ("n_symbols / nullif(n_words, 0)", 0.02, False),
    "dup_line_share": ("n_dup_lines / nullif(n_lines, 0)", 0.05, False),
}


def annotate(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all but those named like a
    count) and the counts of ``text`` as bigint columns."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in COUNTS]
    schema = docs.select(*keep, *[F.lit(0).cast("long").alias(c) for c in COUNTS]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [word_counts(t) for t in b.column(b.num_columns - 1).to_pylist()]
            counts = [pa.array([f[k] for f in found], pa.int64()) for k in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *counts], names=[*keep, *COUNTS])

    return docs.select(*keep, F.col(text).cast("binary").alias("__raw")).mapInArrow(run, schema)


def base_failed(min_words: int = 20, max_repeat_percent: int = 30) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def sketches(rows: DataFrame, lang: str = "lang", source: str = "source", accuracy: float = ACCURACY) -> DataFrame:
    """(lang, source, stat, bucket, n): the leaf sketches of annotated rows."""
    base = math.log((1 + accuracy) / (1 - accuracy))
    stats = F.explode(F.array(*[F.struct(F.lit(k).alias("stat"), F.expr(v).cast("double").alias("x")) for k, (v, _, _) in RULES.items()]))
    bucket = F.when(F.col("s.x") >= TINY, F.ceil(F.log("s.x") / base)).otherwise(F.lit(-(2 ** 31))).cast("int")
    return (rows.select(F.col(lang).alias("lang"), F.col(source).alias("source"), stats.alias("s"))
            .filter("s.x is not null").groupBy("lang", "source", "s.stat", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")))


def quantiles(sketch: DataFrame, by: list[str], shares: dict[str, float], accuracy: float = ACCURACY) -> DataFrame:
    """Per group of ``by`` the number of rows and the given quantiles of
    merged sketches (columns bucket, n)."""
    gamma = (1 + accuracy) / (1 - accuracy)
    merged = sketch.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))
    # a sketch has a bounded number of buckets, whatever it has seen
    up = Window.partitionBy(*by).orderBy("bucket")
    value = F.when(F.col("bucket") == -(2 ** 31), 0.0).otherwise(2 * F.pow(F.lit(gamma), F.col("bucket")) / (gamma + 1))
    ranked = merged.select(*by, "n", value.alias("x"), F.sum("n").over(up).alias("below"),
                           F.sum("n").over(Window.partitionBy(*by)).alias("rows"))
    return ranked.groupBy(*by).agg(F.first("rows").alias("rows"), *[
        F.min(F.when(F.col("below") >= F.lit(q) * F.col("rows"), F.col("x"))).alias(name) for name, q in shares.items()])


def thresholds(rows: DataFrame, lang: str = "lang", source: str = "source", min_rows: int = MIN_ROWS, reach: float = REACH) -> DataFrame:
    """(lang, source, <stat>_low, <stat>_high ...) for every group of
    annotated rows that passed the base rules."""
    leaf = written(sketches(rows, lang, source), "sketches")
    shares = {"q1": 0.25, "q2": 0.5, "q3": 0.75}

    def level(by: list[str], tag: str) -> DataFrame:
        q = quantiles(leaf, by, shares)
        return q.select(*by, *[F.col(c).alias(f"{tag}_{c}") for c in ("rows", *shares)])

    found = level(["lang", "source", "stat"], "g")
    for by, tag in ((["lang", "stat"], "l"), (["stat"], "a")):
        up = level(by, tag)
        up = up.select(*[F.col(c).alias(f"{tag}_{c}") for c in by], *[c for c in up.columns if c not in by])
        on = [found[c].eqNullSafe(up[f"{tag}_{c}"]) for c in by]
        found = found.join(up, on, "left").drop(*[f"{tag}_{c}" for c in by])
    pick = {q: F.when(F.col("g_rows") >= min_rows, F.col(f"g_{q}")).when(F.col("l_rows") >= min_rows, F.col(f"l_{q}"))
            .otherwise(F.col(f"a_{q}")) for q in shares}
    least = F.create_map(*[F.lit(x) for k, (_, spread, _) in RULES.items() for x in (k, spread)])[F.col("stat")]
    reached = reach * F.greatest(pick["q3"] - pick["q1"], least)
    found = found.select("lang", "source", "stat", (pick["q2"] - reached).alias("low"), (pick["q2"] + reached).alias("high"))
    sides = [F.max(F.when(F.col("stat") == k, F.col(c))).alias(f"{k}_{c}") for k in RULES for c in ("low", "high")]
    return found.groupBy("lang", "source").agg(*sides)


def judge(rows: DataFrame, bounds: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Annotated ``rows`` with base_failed, kept and reason."""
    bounds = bounds.withColumnsRenamed({"lang": "__lang", "source": "__source"})
    joined = rows.join(bounds, rows[lang].eqNullSafe(bounds["__lang"]) & rows[source].eqNullSafe(bounds["__source"]), "left")
    reason = F.when(base_failed(), "base")
    for k, (value, _, two_sided) in RULES.items():
        value = F.expr(value)
        out = value > F.col(f"{k}_high")
        if two_sided:
            out = out | (value < F.col(f"{k}_low"))
        reason = reason.when(out, k)
    return (joined.withColumn("base_failed", base_failed()).withColumn("reason", reason)
            .withColumn("kept", F.col("reason").isNull()).drop(*bounds.columns))


def quality_rules(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                  keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` (columns ``keep``) with its counts,
    ``base_failed``, ``kept`` and the ``reason`` of a rejection."""
    drop = {*COUNTS, "base_failed", "kept", "reason"}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in drop]
    names = [f"__k{k}" for k in range(len(keep))]  # a fence of the thresholds may have the name of a column
    own = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text).alias("__text"), F.col(lang).alias("__of_lang"), F.col(source).alias("__of_source"))
    rows = written(annotate(own, "__text", [*names, "__of_lang", "__of_source"]), "quality")
    judged = judge(rows, thresholds(rows.filter(~base_failed()), "__of_lang", "__of_source"), "__of_lang", "__of_source")
    return judged.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], *COUNTS, "base_failed", "kept", "reason")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns as they came."""
    return under_own_names(docs, lambda d, **at: quality_rules(d, **at).filter("kept"), text=text, lang=lang, source=source)


__all__ = ["annotate", "base_failed", "sketches", "quantiles", "thresholds", "judge", "quality_rules", "keep_good"]
