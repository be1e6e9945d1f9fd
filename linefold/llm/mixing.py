"""Mixing sources to target weights by temperature.

A source with token share p gets the weight p ** a / sum of p ** a. The
exponent a is found by bisection, on totals that Spark sums over the sources:

* ``entropy``: the weights' entropy (in nats) is the target, or as near as
  exponents from 0 (all equal) to 1 (shares as they are) come to it;
* ``max_repeats``: the smallest exponent, so the flattest mix, with which no
  source is read more than so many times.

The weights are realised over a token budget; by default the smallest one in
which every source is read at least once, so that nothing is dropped. A source
that is read 2.3 times gives two whole permutations of its documents and
three tenths of a third one. A permutation orders hashed blocks of documents,
about the square root of the source's rows of them; the part takes whole
blocks while they fit its budget and, of the next block, documents in hash
order while they fit. So a hot source costs a sum per block and the ordering
of one block.

Tokens are estimated as a quarter of the text's UTF-8 bytes, rounded up, plus
one for the end of the document.

Nulls and edge cases: null sources are a source of their own; null and empty
texts count one token; repeated rows are rows of their own and, having equal
hashes, next to each other; with one source, or sources of equal size, every
document comes once; an empty table stays empty. Columns keep their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linefold.llm.common import under_own_names, written

BITS = 4  # halvings of the exponent's interval that one pass over the sources decides
HALVINGS = 40
SMALL_TABLE = 50_000  # rows of a table that may be broadcast


def estimated_tokens(text: Column) -> Column:
    return F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / 4).cast("long") + 1


def source_totals(rows: DataFrame) -> DataFrame:
    """(__source, total, rows, share) of rows (__source, __tokens)."""
    sums = written(rows.groupBy("__source").agg(F.sum("__tokens").alias("total"), F.count(F.lit(1)).alias("rows")), "sources")
    whole = sums.agg(F.sum("total")).first()[0] or 1
    return sums.withColumn("share", F.col("total") / F.lit(float(whole)))


def bisect_exponent(sources: DataFrame, entropy: float | None = None, max_repeats: float | None = None) -> float:
    """The exponent in [0, 1] that meets the target."""
    if (entropy is None) == (max_repeats is None):
        raise ValueError("give one target: entropy or max_repeats")
    if max_repeats is not None:
        # repeats are (largest share / share) ** (1 - a): a power of one number
        r = sources.agg(F.max("share").alias("high"), F.min("share").alias("low")).first()
        spread = math.log(r["high"] / r["low"]) if r["low"] else 0.0
        low, high = 0.0, 1.0
        if spread <= math.log(max(max_repeats, 1.0)):
            return 0.0
        for _ in range(HALVINGS):
            mid = (low + high) / 2
            low, high = (low, mid) if spread * (1 - mid) <= math.log(max(max_repeats, 1.0)) else (mid, high)
        return high
    low, high, parts = 0.0, 1.0, 2 ** BITS
    for _ in range(HALVINGS // BITS):
        points = [low + (high - low) * k / parts for k in range(1, parts)]
        p = F.col("share")
        sums = sources.agg(*[x for k, a in enumerate(points) for x in (
            F.sum(F.pow(p, F.lit(a))).alias(f"z{k}"), F.sum(F.pow(p, F.lit(a)) * F.log(p)).alias(f"l{k}"))]).first()
        if sums["z0"] is None:
            return 1.0
        # entropy falls as the exponent rises
        above = sum(math.log(sums[f"z{k}"]) - a * sums[f"l{k}"] / sums[f"z{k}"] >= entropy for k, a in enumerate(points))
        low, high = low + (high - low) * above / parts, low + (high - low) * (above + 1) / parts
    return (low + high) / 2


def weights(sources: DataFrame, exponent: float, budget: int | None = None) -> DataFrame:
    """``sources`` with weight, whole (permutations) and part (tokens of one more)."""
    power = F.pow("share", F.lit(exponent))
    r = sources.agg(F.sum(power).alias("z"), F.max(F.col("total") / power).alias("once")).first()
    if r["z"] is None:
        return sources.select("*", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("whole"), F.lit(0).cast("long").alias("part"))
    scale = r["once"] if budget is None else budget / r["z"]  # tokens per unit of power
    # a hair more than the quotient, so that a source read exactly once is whole
    tokens = F.floor(power * F.lit(float(scale)) + F.lit(1e-3)).cast("long")
    whole = F.floor(tokens / F.col("total")).cast("long")
    return sources.select("*", (power / F.lit(float(r["z"]))).alias("weight"), whole.alias("whole"), (tokens - whole * F.col("total")).alias("part"))


def _hash(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws("/", *parts).cast("binary"))


def block_order(seed: int, source: Column, block: Column, epoch: Column) -> Column:
    """The hash by which an epoch's permutation orders the blocks of a source."""
    name = F.when(epoch == 0, F.lit(str(seed))).otherwise(F.concat_ws(".", F.lit(str(seed)), epoch.cast("string")))
    return _hash(name, F.coalesce(source, F.lit("")), block.cast("string"))


def dealt(docs: DataFrame, entropy: float | None = None, max_repeats: float | None = None, budget: int | None = None,
          source: str = "source", doc_id: str = "doc_id", text: str = "text", seed: int = 0) -> DataFrame:
    """The rows of ``docs`` with __source, __block, __hash, __tokens, __whole
    (permutations of the source) and __copies."""
    rows = docs.withColumns({"__source": F.col(source).cast("string"), "__tokens": estimated_tokens(F.col(text)),
                             "__hash": _hash(F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))})
    sources = source_totals(rows.select("__source", "__tokens"))
    of = written(weights(sources, bisect_exponent(sources, entropy, max_repeats), budget).select(
        F.col("__source").alias("__of"), F.ceil(F.sqrt("rows")).cast("int").alias("__blocks"), F.col("whole").alias("__whole"), F.col("part").alias("__part")), "weights")
    if of.count() <= SMALL_TABLE:
        of = F.broadcast(of)
    number = F.conv(F.substring("__hash", 1, 7), 16, 10).cast("int")
    rows = rows.join(of, F.col("__source").eqNullSafe(F.col("__of"))).withColumn("__block", F.pmod(number, F.col("__blocks")))
    key = ["__source", "__block"]
    sums = rows.groupBy(*key).agg(F.sum("__tokens").alias("t"), F.first("__part").alias("part"))
    order = Window.partitionBy("__source").orderBy(block_order(seed, F.col("__source"), F.col("__block"), F.lit(0)), "__block")
    blocks = written(sums.withColumn("upto", F.sum("t").over(order)).select(
        F.col("__source").alias("__s"), F.col("__block").alias("__b"), (F.col("upto") - F.col("t")).alias("__before"), (F.col("upto") <= F.col("part")).alias("__full")), "blocks")
    if blocks.count() <= SMALL_TABLE:
        blocks = F.broadcast(blocks)
    rows = rows.join(blocks, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__block") == F.col("__b")))
    cut = ~F.col("__full") & (F.col("__before") < F.col("__part"))
    within = Window.partitionBy(*key).orderBy("__hash", "__tokens").rowsBetween(Window.unboundedPreceding, 0)
    whole_blocks = rows.filter(~cut).withColumn("__copies", F.col("__whole") + F.col("__full").cast("long"))
    last_block = rows.filter(cut).withColumn("__copies", F.col("__whole") + (F.col("__before") + F.sum("__tokens").over(within) <= F.col("__part")).cast("long"))
    return whole_blocks.unionByName(last_block).select(*docs.columns, "__source", "__block", "__hash", "__tokens", "__whole", "__copies")


def mix(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` with ``__copies``, the number of times each is read
    (may be 0); arguments as in ``dealt``."""
    return dealt(docs, **how).select(*docs.columns, "__copies")


def readings(docs: DataFrame, seed: int = 0, **how) -> DataFrame:
    """Each reading of each row of ``docs``, with its place in the mix:
    ``__epoch`` (0 the part of a permutation, then the whole ones),
    ``__rank`` (of the block in the epoch's permutation of the source's blocks)
    and ``__place`` (in the block), all from the result of ``dealt``. A source
    is read in the order of these three."""
    rows = dealt(docs, seed=seed, **how)
    last = F.col("__whole").cast("int")
    blocks = rows.groupBy("__source", "__block").agg(F.max(last).alias("__last"))
    blocks = blocks.select(F.col("__source").alias("__s"), F.col("__block").alias("__b"), F.explode(F.sequence(F.lit(0), "__last")).alias("__e"))
    order = Window.partitionBy("__s", "__e").orderBy(block_order(seed, F.col("__s"), F.col("__b"), F.col("__e")), "__b")
    ranks = written(blocks.withColumn("__rank", F.row_number().over(order)), "block-ranks")
    if ranks.count() <= SMALL_TABLE:
        ranks = F.broadcast(ranks)
    place = F.row_number().over(Window.partitionBy("__source", "__block").orderBy("__hash", "__tokens"))
    first = F.when(F.col("__copies") > F.col("__whole"), 0).otherwise(1)
    read = rows.withColumn("__place", place).filter("__copies > 0").withColumn("__epoch", F.explode(F.sequence(first, last)))
    same = F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__block") == F.col("__b")) & (F.col("__epoch") == F.col("__e"))
    return read.join(ranks, same).select(*docs.columns, "__copies", "__epoch", "__rank", "__place")


def mixed(docs: DataFrame, source: str = "source", doc_id: str = "doc_id", text: str = "text", **targets) -> DataFrame:
    """The rows of ``docs``, each as often as the mix reads it."""
    def work(d: DataFrame, **columns: str) -> DataFrame:
        rows = mix(d, **columns, **targets).filter("__copies > 0")
        return rows.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__copies").cast("int"))))

    return under_own_names(docs, work, source=source, doc_id=doc_id, text=text)


__all__ = ["estimated_tokens", "source_totals", "bisect_exponent", "weights", "dealt", "mix", "readings", "mixed"]
