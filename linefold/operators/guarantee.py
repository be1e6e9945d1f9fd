"""Guarantees sold with articles.

The guarantee catalogue is the article dimension filtered by a fixed list of
article numbers (a literal ``IN``, no join). Per-order totals are hash
aggregates (partial before the shuffle); the running allocation (D36) works
on rows already aggregated per (order, article), so its window sees one row
per distinct article of an order, not the raw lines.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linefold.functions import constants as K
from linefold.operators.joins import by_order
from linefold.operators.versions import top_rank
from linefold.sources.tables import written


#: combined ids of the catalogue up to which they are a literal set
MOST_IDS = 1_000
#: articles of an order up to which one task adds them up
MOST_ARTICLES = 100_000
#: ranges of articles that the others are dealt into
RANGES = 64


def guarantee_articles(art: DataFrame, numbers: Iterable[int] = K.GUARANTEE_ARTICLE_NUMBERS) -> DataFrame:
    """Articles whose number is in the guarantee list."""
    return art.filter(F.col("articleNumber").isin(list(numbers))).select(
        "articleId", "combinedarticleid", "articleNumber", "pk_article")


def guarantees_per_order(staged: DataFrame, cat: DataFrame, store: int = K.GUARANTEE_STORE) -> DataFrame:
    """Guarantee quantity per (date, combi, order) of the guarantee store,
    with ``joins.ORDER`` if the lines have it."""
    keys = ["order_date", "combiordernumber", "ordernumber", *by_order(staged)]
    s = staged.filter(F.col("fulfillingstoreid") == store).select(*keys, "articleid", "order_quantity")
    j = s.join(cat.select(F.col("articleId").alias("__g_art")), F.col("articleid") == F.col("__g_art"))
    return j.groupBy(*keys).agg(
        F.sum("order_quantity").alias("order_qty_guarantee"))


def articles_offered_guarantee(staged: DataFrame, cat: DataFrame, most: int = MOST_IDS) -> DataFrame:
    """Distinct lines having an option that is a guarantee's combined id.

    The output keeps line columns only (and ``joins.ORDER``, if the lines have it) and is distinct. The catalogue's
    combined ids are counted first: up to ``most`` of them are a literal set
    that a predicate looks for inside the array, row by row, with no explode
    and no join (the one exchange left is that of DISTINCT). Beyond that a
    semi-join gives the same rows as the inner join + DISTINCT without
    multiplying each option by every guarantee sharing its combined id.
    """
    cols = ["order_date", "combiordernumber", "ordernumber", "affected_employee", "articleid", "order_quantity", *by_order(staged)]
    ids = [r[0] for r in cat.select("combinedarticleid").dropna().distinct().limit(most + 1).collect()]
    if len(ids) <= most:
        has = F.exists("id_options", lambda op: op.try_cast("bigint").isin(ids))
        return staged.filter(F.coalesce(has, F.lit(False)) if ids else F.lit(False)).select(*cols).distinct()
    x = staged.select(*cols, F.explode("id_options").alias("__op"))
    j = x.join(cat.select(F.col("combinedarticleid").alias("__g_cid")),
               F.col("__g_cid") == F.col("__op").try_cast("bigint"), "left_semi")
    return j.select(*cols).distinct()


def guarantee_sales(offered: DataFrame, ordered: DataFrame) -> DataFrame:
    """Per offered line, guarantee total of the order and of the order
    and employee, and the number of such lines.

    Lines are counted per (order, employee), a partial aggregate, so a hot
    order does not pile into one task; the order's guarantee total and the
    order's number of lines come from that small table, which is joined back
    once (null-safe on the group keys). An order has one guarantee total, so a
    sum over lines is that total times their number. If both sides have
    ``joins.ORDER`` and are dealt by it, all of this leaves the lines where they
    are (written by ``joins.written_dealt``).
    """
    order = by_order(offered)
    keys = ["order_date", "combiordernumber", "ordernumber", *order]
    ekeys = keys + ["affected_employee"]
    per_emp = offered.groupBy(*ekeys).agg(F.count(F.lit(1)).alias("count_order_line"))
    lines = F.sum("count_order_line").over(Window.partitionBy(*keys))
    small = per_emp.withColumn("__lines", lines)
    g = ordered.select(*[F.col(k).alias("__s_" + k) for k in keys], "order_qty_guarantee")
    small = small.join(g, [F.col(k) == F.col("__s_" + k) for k in keys], "left")
    small = small.select(*[F.col(k).alias("__e_" + k) for k in ekeys], "order_qty_guarantee",
                         (F.col("order_qty_guarantee") * F.col("__lines")).alias("qty_order_tot"),
                         (F.col("order_qty_guarantee") * F.col("count_order_line")).alias("qty_order_emp_tot"), "count_order_line")
    same = [F.col(k) == F.col("__e_" + k) if k in order else F.col(k).eqNullSafe(F.col("__e_" + k)) for k in ekeys]
    out = offered.join(small, same, "left")
    return out.select(*keys, "affected_employee", "articleid", "order_quantity", "order_qty_guarantee",
                      "qty_order_tot", "qty_order_emp_tot", "count_order_line").distinct().drop(*order)


def offered_options(results: DataFrame) -> DataFrame:
    """One row per line of an order (kind 1) and option that is a number."""
    # what is no number goes before the explode
    numbers = F.filter(F.transform("id_options", lambda op: op.try_cast("bigint")), lambda n: n.isNotNull())
    return results.filter(F.col("type_cmd") == 1).select(
        "order_date", "ordernumber", F.explode(numbers).alias("id_option"), "combinedarticleid", "pk_article",
        "order_quantity", "order_qty_guarantee", "affected_employee", *by_order(results))


def ordered_guarantees(results: DataFrame, cat: DataFrame) -> DataFrame:
    """The guarantee lines of kind 1 orders."""
    r = results.filter(F.col("type_cmd") == 1)
    j = r.join(cat.select(F.col("pk_article").alias("__g_pk")), F.col("pk_article") == F.col("__g_pk"))
    return j.select("order_date", "ordernumber", "combinedarticleid", "pk_article", "order_quantity",
                    "affected_employee", *by_order(results))


def articles_under_guarantee(offered: DataFrame, cat: DataFrame) -> DataFrame:
    """D31 rows of orders with a guarantee, the guarantees themselves out."""
    o = offered.filter(F.coalesce(F.col("order_qty_guarantee"), F.lit(0)) != 0)
    return o.join(cat.select(F.col("pk_article").alias("__g_pk")), F.col("pk_article") == F.col("__g_pk"),
                  "left_anti")


def correct_guarantee_employee(ordered: DataFrame, under: DataFrame) -> DataFrame:
    """The employee of the covered article for a guarantee line.

    Rank by covered article ascending, employee descending; rank 1 and only
    where the employee differs (a null on either side: no correction).
    """
    order = by_order(ordered)
    u = under.select(F.col("ordernumber").alias("__u_order"), F.col("id_option").alias("__u_opt"),
                     F.col("combinedarticleid").alias("__u_cid"),
                     F.col("affected_employee").alias("affected_employee_corrected"), *[F.col(k).alias("__u_" + k) for k in order])
    j = ordered.join(u, [F.col("ordernumber") == F.col("__u_order"), F.col("combinedarticleid") == F.col("__u_opt"),
                         *[F.col(k) == F.col("__u_" + k) for k in order]], "left")
    ranked = top_rank(j, ["ordernumber", "pk_article", *order],
                      [F.col("__u_cid").asc(), F.col("affected_employee_corrected").desc()])
    return ranked.filter(F.col("affected_employee") != F.col("affected_employee_corrected")).select(
        "order_date", "ordernumber", "pk_article", "order_quantity", "affected_employee_corrected", *order)


def guarantee_qty_per_order(ordered: DataFrame) -> DataFrame:
    """Guarantee quantity per order."""
    return ordered.groupBy("ordernumber", *by_order(ordered)).agg(F.sum("order_quantity").alias("qty_guar_tot"))


def running_sum(rows: DataFrame, group: str, order: str, value: str, out: str, materialize=None,
                most: int = MOST_ARTICLES, ranges: int = RANGES) -> DataFrame:
    """``rows`` with ``out``: the exact sum of ``value`` over the group's rows up
    to the row's ``order`` (N6: RANGE, rows of equal order count together,
    nulls first).

    Groups of up to ``most`` rows are one window. The others are dealt into
    ``ranges`` ranges of ``order`` (quantiles over all their rows; equal values
    are in one range), each summed by a window of its own, and the totals of
    the ranges before are added: a group of any size is many tasks and a
    window over at most ``ranges`` rows.
    """
    exact = rows.withColumn("__v", F.col(value).cast("decimal(28,9)"))
    frame = Window.orderBy(F.col(order).asc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def added(df: DataFrame, *keys: str) -> DataFrame:
        return df.withColumn("__sum", F.sum("__v").over(frame.partitionBy(*keys)))

    exact = (materialize or written)(exact, "running")
    large = exact.groupBy(F.col(group).alias("__g")).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > most).select("__g")
    large = (materialize or written)(large, "large_groups")
    if large.isEmpty():
        return added(exact, group).withColumn(out, F.col("__sum")).drop("__v", "__sum")
    same = F.col(group).eqNullSafe(F.col("__g"))
    usual, hot = exact.join(large, same, "left_anti"), exact.join(large, same, "left_semi")
    cuts = hot.agg(F.percentile_approx(order, [k / ranges for k in range(1, ranges)] or [1.0], 4 * ranges)).first()[0] or []
    place = F.size(F.filter(F.array(*[F.lit(c) for c in sorted(set(cuts))]), lambda c: c < F.col(order)))
    hot = hot.withColumn("__range", F.when(F.col(order).isNull(), F.lit(-1)).otherwise(place) if cuts else F.lit(0))
    totals = hot.groupBy(F.col(group).alias("__g"), F.col("__range").alias("__r")).agg(F.sum("__v").alias("__t"))
    before = F.sum("__t").over(Window.partitionBy("__g").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.withColumn("__before", before)
    hot = added(hot, group, "__range").join(totals, same & (F.col("__range") == F.col("__r")))
    # a sum of nulls only is null, as in the window
    hot = hot.withColumn("__sum", F.coalesce(F.col("__before") + F.col("__sum"), F.col("__before"), F.col("__sum")))
    return (added(usual, group).select(*rows.columns, F.col("__sum").alias(out))
            .unionByName(hot.select(*rows.columns, F.col("__sum").alias(out))))


def allocate_running(under: DataFrame, ordered: DataFrame, totals: DataFrame, materialize=None) -> DataFrame:
    """Running allocation of guarantees over the covered articles.

    Per (date, order, article): the largest quantity a guarantee can cover.
    Then per order, by article (RANGE frame: equal articles are peers), a line
    gets it while the running sum fits the order's guarantee total, else 0.
    The running sum counts refused lines too (no give-back, trap 18).
    """
    order = by_order(ordered)
    g = ordered.select(F.col("ordernumber").alias("__g_order"), F.col("combinedarticleid").alias("__g_cid"),
                       F.col("order_quantity").alias("__g_qty"), *[F.col(k).alias("__g_" + k) for k in order])
    j = under.join(g, [F.col("ordernumber") == F.col("__g_order"), F.col("id_option") == F.col("__g_cid"),
                       *[F.col(k) == F.col("__g_" + k) for k in order]])
    o = j.groupBy("order_date", "ordernumber", "pk_article", *order).agg(
        F.max(F.when(F.col("__g_qty") - F.col("order_quantity") >= 0, F.col("order_quantity"))
              .otherwise(F.lit(0.0))).alias("max_gar_possible"))
    o = running_sum(o.join(totals, ["ordernumber", *order]), "ordernumber", "pk_article", "max_gar_possible", "__upto", materialize)
    fits = F.coalesce(F.col("qty_guar_tot"), F.lit(0.0)).cast("decimal(28,9)") - F.col("__upto") >= 0
    return o.select("order_date", "ordernumber", "pk_article", *order,
                    F.when(fits, F.col("max_gar_possible")).otherwise(F.lit(0.0)).cast("double")
                    .alias("qty_guarantee_adjusted_sold"))


__all__ = ["guarantee_articles", "guarantees_per_order", "articles_offered_guarantee", "guarantee_sales",
           "offered_options", "ordered_guarantees", "articles_under_guarantee",
           "correct_guarantee_employee", "guarantee_qty_per_order", "running_sum", "allocate_running"]
