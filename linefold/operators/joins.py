"""Left joins whose left key is often null or one known value.

A null key matches nothing, yet a shuffle sends all null keys to one task. Here
they are spread over tasks by a hash of other columns, as text that no key has.
A value known to be very common and able to match (the empty text) is dealt
over a number of salts, and the right rows that hold it are copied to each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefold.sources.tables import setting, written, written_bucketed

NO_KEY = "\u0000no key "
SALTS = 16


def spread(key: str, by: tuple[str, ...]) -> Column:
    """The text key, or for null a text that equals no key, spread by the hash
    of the columns ``by``. For the left side of a left join."""
    return F.coalesce(F.col(key), F.concat(F.lit(NO_KEY), F.xxhash64(*by).cast("string")))


def join_hot_value(left: DataFrame, right: DataFrame, key: str, right_key: str, hot: str,
                   by: tuple[str, ...], salts: int = SALTS) -> DataFrame:
    """``left`` left-joined to ``right`` on text keys, of which null and
    ``hot`` are common on the left."""
    dealt = left.withColumn("__salt", F.when(F.col(key) == hot, F.pmod(F.xxhash64(*by), F.lit(salts))).otherwise(F.lit(0)).cast("int"))
    copies = F.when(F.col(right_key) == hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copied = right.withColumn("__salt_of", F.explode(copies))
    on = (spread(key, by) == F.col(right_key)) & (F.col("__salt") == F.col("__salt_of"))
    return dealt.join(copied, on, "left").drop("__salt", "__salt_of")


#: distinct keys of the lines up to which a lookup is cut to them first (a broadcast of a few MB)
MOST_KEYS = 50_000


def few_keys(lines: DataFrame, key: str, most: int = MOST_KEYS) -> DataFrame | None:
    """The distinct keys of ``lines``, written and counted, or None if there
    are more than ``most``."""
    keys = written(lines.select(F.col(key).alias("__few")).dropna().distinct(), "keys")
    return keys if keys.limit(most + 1).count() <= most else None


def of_keys(lookup: DataFrame, key: str, keys: DataFrame | None) -> DataFrame:
    """The rows of ``lookup`` that a join on ``key`` to lines of these keys can
    match, written, so Spark plans with its size: what is left is often small
    enough to be broadcast, and then the lines, which are wide, are not
    shuffled for it."""
    if keys is None:
        return lookup
    return written(lookup.join(F.broadcast(keys), F.col(key) == F.col("__few"), "left_semi"), "lookup")


#: names a line's order; never null, and the same for lines of one order number
ORDER = "__order"


def dealt_by_order(lines: DataFrame, order: str = "ordernumber", by: tuple[str, ...] = ("articleid", "positionNumber")) -> DataFrame:
    """``lines`` dealt by their order, named in ``ORDER`` (for a null one a text
    that no order has). Joins on it and other columns leave such lines where
    they are if the result is written by ``written_dealt``. Lines that have
    ``ORDER`` are dealt by it already."""
    return lines if ORDER in lines.columns else lines.withColumn(ORDER, spread(order, by)).repartition(ORDER)


def written_dealt(df: DataFrame, name: str, materialize: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """``df`` written under the setting by which lines dealt by order stay so
    in joins on the order and other columns; the session's own is put back."""
    with setting(df.sparkSession, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        return (materialize or written)(df, name)


def written_by_order(df: DataFrame, name: str) -> DataFrame:
    """``written_dealt`` in buckets of ``ORDER``: read again, the lines are still dealt by it."""
    return written_dealt(df, name, lambda rows, name: written_bucketed(rows, name, ORDER))


def by_order(lines: DataFrame) -> list[str]:
    """``ORDER``, if the lines name their order by it, as a further key of what
    is grouped or joined per order: lines dealt by it then stay where they are."""
    return [ORDER] if ORDER in lines.columns else []


def join_narrow(dealt: DataFrame, lines: DataFrame, lookup: DataFrame, on: dict[str, str], order: str = "ordernumber",
                by: tuple[str, ...] = ("articleid", "positionNumber")) -> DataFrame:
    """``dealt`` (``lines``, or some of them, by ``dealt_by_order``) left-joined
    to ``lookup``; ``on``: column of the lines -> column of the lookup.

    Lines are wide and the lookup has a key of its own, so only the distinct
    (order, key) go to the lookup, and what they match comes back by order.
    ``lines`` that have ``ORDER`` themselves are asked for by that.
    """
    key = {c: f"__k_{c}" for c in on}
    # dealt by the key before the DISTINCT: one shuffle serves it and the join
    named = F.col(ORDER) if ORDER in lines.columns else spread(order, by)
    asked = (lines.select(named.alias("__k_order"), *[F.col(c).alias(k) for c, k in key.items()])
             .dropna().repartition(*key.values()).distinct())
    match = F.lit(True)
    back = F.col(ORDER) == F.col("__k_order")
    for c, k in key.items():
        match = match & (F.col(k) == F.col(on[c]))
        back = back & (F.col(c) == F.col(k))
    return dealt.join(asked.join(lookup, match), back, "left").drop("__k_order", *key.values())


__all__ = ["spread", "join_hot_value", "few_keys", "of_keys", "dealt_by_order", "written_dealt", "written_by_order", "by_order", "join_narrow", "ORDER", "MOST_KEYS"]
