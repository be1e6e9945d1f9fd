"""Which version of an order (or line) is kept.

All four are "rank = 1 per group, ties kept". They are written as a RANK
window filtered to 1, which Spark plans as a *partial* ``WindowGroupLimit``
before the shuffle and a final one after it: each map task forwards only its
local rank-1 rows of a group, so a hot order key does not ship all its
versions through one reducer -- only its ties. One scan of the input, one
shuffle on the group keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linefold.functions.columns import col

_RANK = "__lf_rank"


def top_rank(df: DataFrame, partition: Sequence[str | Column], order: Sequence[Column],
             distinct: bool = False) -> DataFrame:
    """Rows of rank 1 per ``partition`` under ``order`` (RANK: ties stay).

    ``order`` holds sort Columns (``F.col(c).desc()``...). Spark's and the
    original SQL's null order agree: nulls first ascending, last descending.
    """
    w = Window.partitionBy(*[col(p) for p in partition]).orderBy(*order)
    out = df.withColumn(_RANK, F.rank().over(w)).filter(F.col(_RANK) == 1).drop(_RANK)
    return out.distinct() if distinct else out


def first_version(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows that carry the smallest ``ts`` of their key; ties stay.

    Rows with a null key or a null ``ts`` never match (inner equi-join
    semantics of the original).
    """
    cond = F.col(ts).isNotNull()
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return top_rank(df.filter(cond), keys, [F.col(ts).asc()])


def latest_version(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows with the largest ``ts`` per key, then distinct."""
    cond = F.col(ts).isNotNull()
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return top_rank(df.filter(cond), keys, [F.col(ts).desc()], distinct=True)


def top_by_priority(df: DataFrame, partition: Sequence[str | Column],
                    order: Sequence[Column]) -> DataFrame:
    """Rank 1 by priority maps and amounts (ties stay), then distinct.

    Project ``df`` to the output columns first: DISTINCT removes exact copies
    only, the rest is summed later (trap 1: never ROW_NUMBER).
    """
    return top_rank(df, partition, order, distinct=True)


def lowest_revision(df: DataFrame, partition: Sequence[str], order: Sequence[Column],
                    match: Sequence[str], null_safe: Sequence[str] = (),
                    ranked: Column | None = None) -> DataFrame:
    """Rows matching a rank-1 row (lowest revision, then time).

    The original ranks the rows that satisfy ``ranked`` (default all) and joins
    the rank-1 rows back to all rows on ``match``, whose ``null_safe`` keys
    compare null as ''. Other null keys never match, and equal keys fan out.
    Here both sides are one: a window ranks, a second one counts the rank-1
    rows among the rows of equal ``match`` keys, and a row comes out that many
    times. The rows are dealt once, by the partition keys that must not be
    null, which serves both windows: one scan, one shuffle, no join.
    """
    must = [m for m in match if m not in null_safe]
    dealt = [p for p in partition if p in must]
    flag = F.lit(True) if ranked is None else F.coalesce(ranked, F.lit(False))
    rows = df.dropna(subset=dealt).withColumn("__lf_in", flag) if dealt else df.withColumn("__lf_in", flag)
    if dealt:
        rows = rows.repartition(*dealt)
    first = F.rank().over(Window.partitionBy(*partition).orderBy(F.col("__lf_in").desc(), *order)) == 1
    best = rows.withColumn("__lf_best", (first & F.col("__lf_in")).cast("int"))
    same = [F.coalesce(F.col(m), F.lit("")) if m in null_safe else F.col(m) for m in match]
    times = F.sum("__lf_best").over(Window.partitionBy(*same))
    out = best.dropna(subset=must).withColumn("__lf_times", times).filter(F.col("__lf_times") > 0)
    again = F.explode(F.sequence(F.lit(1), F.col("__lf_times").cast("int")))
    return out.select("*", again.alias("__lf_again")).drop("__lf_in", "__lf_best", "__lf_times", "__lf_again")
