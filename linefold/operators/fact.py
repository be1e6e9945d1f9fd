"""Staged lines -> rows of the order-line fact.

The fact is read once, as a snapshot, before the new rows are appended
(self-join J18): the duplicate test (D22) and the originals of backorders
(D37, D38) read that snapshot. Filters on ``order_date`` are written as plain
comparisons so they prune the fact's date partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.functions import constants as K
from linefold.functions.columns import (attribute_store, classify_backorder, dash_parts, final_employee,
                                        lit_date, order_kind, original_key, rekey_backorder,
                                        service_of, split_backorder_measure)
from linefold.functions.timewin import local_now
from linefold.sources.tables import written
from linefold.operators.guarantee import (allocate_running, articles_under_guarantee,
                                          correct_guarantee_employee, guarantee_articles,
                                          guarantee_qty_per_order, guarantees_per_order, offered_options,
                                          ordered_guarantees)
from linefold.operators.joins import ORDER, by_order, dealt_by_order, few_keys, join_narrow, of_keys, written_by_order, written_dealt
from linefold.operators.rejects import accept_lines

# The fact's columns, in order, and their types (fixed schema).
FACT_COLUMNS = (
    "order_date", "order_day", "order_month", "order_time", "origin_id", "combiordernumber",
    "ordernumber", "fulfillmenttype", "fulfillingstoreid", "order_date_orig", "ordernumber_orig",
    "deliverydate_orig", "customerhomestorenumber", "customernumber", "cardholderid", "store_emp",
    "store_pref", "store_cdg", "service", "deliverydate", "deliverytype", "pickupStoreid",
    "validated_order_employee", "added_to_basket_employee", "affected_employee", "articleId",
    "combinedarticleid", "pk_article", "positionNumber", "shopid", "merchantName", "paymentType_OM",
    "orderComments", "replaceditemnumber", "id_options", "order_quantity", "order_article_net_price",
    "order_quantity_reliquat", "order_article_net_price_reliquat", "type_reliquat", "prom_id",
    "type_cmd", "qty_potential_guarantee_sold", "qty_guarantee_adjusted_sold", "gcp_insert",
)
FACT_TYPES = {
    "order_date": "date", "order_day": "bigint", "order_month": "bigint", "fulfillingstoreid": "bigint",
    "order_date_orig": "date", "customerhomestorenumber": "bigint", "customernumber": "bigint",
    "cardholderid": "bigint", "store_emp": "bigint", "store_pref": "bigint", "store_cdg": "bigint",
    "pickupStoreid": "bigint", "combinedarticleid": "bigint", "pk_article": "bigint",
    "positionNumber": "bigint", "shopid": "bigint", "id_options": "array<string>",
    "order_quantity": "double", "order_article_net_price": "double", "order_quantity_reliquat": "double",
    "order_article_net_price_reliquat": "double", "prom_id": "bigint", "type_cmd": "bigint",
    "qty_potential_guarantee_sold": "double", "qty_guarantee_adjusted_sold": "double",
}


def fact_schema(run_col: str | None = "load_run") -> str:
    """DDL of the fact table, the column of the pass (if it has one) included."""
    columns = [f"`{c}` {FACT_TYPES.get(c, 'string')}" for c in FACT_COLUMNS]
    return ", ".join(columns + ([f"`{run_col}` string"] if run_col else []))


def fact_select(df: DataFrame, columns=FACT_COLUMNS) -> DataFrame:
    return df.select(*[F.col(c).cast(FACT_TYPES.get(c, "string")).alias(c) for c in columns])


def recent_fact(fact: DataFrame, since: dt.date | None,
                lookback_days: int = K.FACT_LOOKBACK_DAYS, kinds=K.FACT_ORDER_KINDS) -> DataFrame:
    """Fact rows the duplicate test looks at: ``order_date + 2 >= since``."""
    f = fact.filter(F.col("type_cmd").isin(list(kinds)))
    if since is not None:
        f = f.filter(F.col("order_date") >= lit_date(since - dt.timedelta(days=lookback_days)))
    return f


def append_new_only(new: DataFrame, fact: DataFrame, since: dt.date | None,
                    keys=("ordernumber", "articleid"), lookback_days: int = K.FACT_LOOKBACK_DAYS) -> DataFrame:
    """Lines whose (order, article) is not in the recent fact.

    ``since=None`` checks the whole fact. Anti-join (the original wrote a
    left join + IS NULL, which Catalyst keeps as an outer join).
    """
    old = recent_fact(fact, since, lookback_days).select(*[F.col(k).alias("__f_" + k) for k in keys])
    cond = None
    for k in keys:
        c = F.col(k) == F.col("__f_" + k)
        cond = c if cond is None else cond & c
    return new.join(old, cond, "left_anti")


def promo_lookup(promo: DataFrame, since: dt.date | None) -> DataFrame:
    """Largest promo id per (day, article, store)."""
    p = promo.filter(F.col("articleId").isNotNull())
    if since is not None:
        p = p.filter(F.col("date_of_day") >= lit_date(since))
    return p.groupBy("date_of_day", "articleId", "store_id").agg(F.max("prom_id").alias("prom_id"))


def build_results(staged: DataFrame, guarantees: DataFrame, art: DataFrame, pref: DataFrame,
                  emp: DataFrame, promo: DataFrame | None, shop: DataFrame, fact: DataFrame,
                  since: dt.date | None, marketplace_type: str = K.MARKETPLACE_TYPE,
                  lookback_days: int = K.FACT_LOOKBACK_DAYS, accepted: DataFrame | None = None) -> DataFrame:
    """D30 (with D21, D22, D28, D29): accepted new lines with all lookups.

    ``accepted`` are the accepted lines of ``staged`` if they have been worked
    out already (``rejects.accepted_lines``); the lookups are not joined then.
    ``promo`` None: for readers without use for ``prom_id``, which is null (the
    promotions of ``promo_lookup`` have a key once, so no line comes or goes).
    Lines, guarantees and fact may all have ``joins.ORDER``, one name for an
    order in all of them, and be dealt by it. The last column is ``joins.ORDER``.
    """
    lines = staged if accepted is None else accepted
    # an order's few guarantee rows as one, so the first join too is by order alone
    g = guarantees.groupBy(F.col((by_order(lines) or ["ordernumber"])[0]).alias("__g_o")).agg(
        F.collect_list(F.struct(F.col("order_date").alias("d"), F.col("combiordernumber").alias("c"), F.col("ordernumber").alias("o"),
                                F.col("order_qty_guarantee").alias("q"))).alias("__g"))
    articles = few_keys(lines, "articleid")
    # the lines, which are wide, are dealt once; the lookups come to them
    acc = dealt_by_order(lines).join(g, F.col(ORDER) == F.col("__g_o"), "left")
    own = F.filter("__g", lambda x: (x["d"] == F.col("order_date")) & (x["c"] == F.col("combiordernumber")) & (x["o"] == F.col("ordernumber")))
    acc = acc.withColumn("__g", F.explode_outer(own)).withColumn("order_qty_guarantee", F.col("__g.q"))
    # as in append_new_only, but an anti-join would be pushed below the dealing
    old = recent_fact(fact, since, lookback_days).select(F.col("ordernumber").alias("__f_o"), F.col("articleid").alias("__f_a"),
                                                         F.col((by_order(lines) or ["ordernumber"])[0]).alias("__f_order"))
    acc = acc.join(old, (F.col(ORDER) == F.col("__f_order")) & (F.col("ordernumber") == F.col("__f_o")) & (F.col("articleid") == F.col("__f_a")),
                   "left").filter(F.col("__f_o").isNull())
    if accepted is None:
        acc = accept_lines(acc, art, emp, shop, marketplace_type, articles, lines)
    pr = pref.select(F.col("home_store_id").alias("__p_h"), F.col("cust_no").alias("__p_c"),
                     F.col("month_id").alias("__p_m"), F.col("store_id").alias("store_pref")).distinct()
    acc = join_narrow(acc, lines, pr, {"customerHomeStoreNumber": "__p_h", "customernumber": "__p_c", "order_month": "__p_m"})
    if promo is None:
        acc = acc.withColumn("prom_id", F.lit(None).cast("bigint"))
    else:
        pm = of_keys(promo, "articleId", articles).select(F.col("date_of_day").alias("__pm_d"), F.col("articleId").alias("__pm_a"),
                          F.col("store_id").alias("__pm_s"), "prom_id")
        acc = join_narrow(acc, lines, pm, {"articleid": "__pm_a", "order_date": "__pm_d", "fulfillingstoreid": "__pm_s"})
    return acc.select(
        "order_date", "order_day", "order_month", "order_time", "origin_id", "combiordernumber",
        "ordernumber", "fulfillmenttype", "fulfillingstoreid",
        F.col("customerHomeStoreNumber").alias("customerhomestorenumber"), "customernumber", "cardholderid",
        "store_emp", "store_pref",
        attribute_store("__service", "store_emp", "store_pref", "customerHomeStoreNumber").alias("store_cdg"),
        service_of("__service").alias("service"),
        F.col("deliveryDate").alias("deliverydate"), F.col("deliveryType").alias("deliverytype"),
        F.col("pickupstoreid").alias("pickupStoreid"), "validated_order_employee",
        "added_to_basket_employee", "affected_employee", F.col("articleid").alias("articleId"),
        "combinedarticleid", "pk_article", "positionNumber",
        F.coalesce(F.col("shopid"), F.col("__shop")).alias("shopid"),
        F.col("merchantname").alias("merchantName"), "paymentType_OM", "orderComments",
        F.col("replacedItemNumber").alias("replaceditemnumber"), "id_options", "order_quantity",
        "order_article_net_price", "prom_id", order_kind("ordernumber").alias("type_cmd"),
        "order_qty_guarantee", ORDER)


#: bytes of order numbers up to which the keys of one pass are broadcast
KEY_BYTES = 16 << 20


def keyed_originals(fact: DataFrame, results: DataFrame, materialize=None) -> DataFrame:
    """The fact rows whose order a line of ``results`` is a backorder of; no
    others can be an original (D37-D39).

    The keys of a pass are written and measured: their range is a plain filter
    that prunes files and row groups of a fact kept in order of order number,
    and the rest is a semi-join, broadcast if the keys take at most
    ``KEY_BYTES``, so the fact itself is neither aggregated nor shuffled whole.
    """
    keys = (materialize or written)(results.select(original_key("ordernumber").alias("__key")).dropna().distinct(), "original_keys")
    size = keys.agg(F.count(F.lit(1)).alias("n"), F.min("__key").alias("lo"), F.max("__key").alias("hi"),
                    F.sum(F.octet_length("__key") + 64).alias("bytes")).first()
    if not size["n"]:
        return fact.filter(F.lit(False))
    few = F.broadcast(keys) if size["bytes"] <= KEY_BYTES else keys
    rows = fact.filter(F.col("ordernumber").between(size["lo"], size["hi"]))
    return rows.join(few, F.col("ordernumber") == F.col("__key"), "left_semi")


#: days of a stage up to which they are broadcast (a century)
MOST_DAYS = 36_525


def stage_days(staged: DataFrame, materialize=None) -> DataFrame:
    """The order dates of the staged lines, retried rejects included."""
    return (materialize or written)(staged.select(F.col("order_date").alias("__day")).dropna().distinct(), "days")


def for_days(dated: DataFrame, days: DataFrame, date_col: str = "date_of_day") -> DataFrame:
    """The rows of a dated lookup whose day is among ``days``.

    On a table partitioned by day only those days are read: first and last day
    are literals, the days between are a dynamic partition filter from the
    broadcast of ``days``, whose number is checked.
    """
    size = days.agg(F.count(F.lit(1)).alias("n"), F.min("__day").alias("lo"), F.max("__day").alias("hi")).first()
    if not size["n"]:
        return dated.filter(F.lit(False))
    lo, hi = lit_date(size["lo"]), lit_date(size["hi"])
    some = days.filter(F.col("__day").between(lo, hi))
    some = F.broadcast(some) if size["n"] <= MOST_DAYS else some
    return dated.filter(F.col(date_col).between(lo, hi)).join(some, F.col(date_col) == F.col("__day"), "left_semi")


def _originals(fact: DataFrame, since_long: dt.date | None,
               types=K.ORIGINAL_FULFILMENT_TYPES) -> DataFrame:
    f = fact.filter((dash_parts("ordernumber") == 2) & F.col("fulfillmenttype").isin(list(types))
                    & (F.col("type_cmd") == 1))
    if since_long is not None:
        f = f.filter(F.col("order_date") >= lit_date(since_long))
    return f


def original_orders(fact: DataFrame, since_long: dt.date | None) -> DataFrame:
    """Earlier kind-1 orders: earliest delivery date per (order, date)."""
    return _originals(fact, since_long).groupBy("ordernumber", "order_date").agg(
        F.min("deliverydate").alias("deliveryDate"))


def original_lines(fact: DataFrame, since_long: dt.date | None) -> DataFrame:
    """Their lines (article, employee, quantity), not grouped."""
    return _originals(fact, since_long).select("ordernumber", "pk_article", "affected_employee",
                                               "order_quantity")


def load_fact(staged: DataFrame, fact: DataFrame, art: DataFrame, pref: DataFrame, emp: DataFrame,
              promo: DataFrame, shop: DataFrame, as_of: dt.datetime, since: dt.date | None,
              since_long: dt.date | None, promo_since: dt.date | None = None,
              marketplace_type: str = K.MARKETPLACE_TYPE,
              correction_start: dt.date = K.EMPLOYEE_CORRECTION_START, tz: str = K.PARIS,
              materialize=None, accepted: DataFrame | None = None) -> DataFrame:
    """The rows to append to the fact (45 columns).

    ``results`` feeds four branches (guarantee block, corrections, final
    select), so it is computed once: ``materialize(df, name)`` writes it and
    reads it back, by default under the session's checkpoint folder, in buckets
    of the order: lines are not shuffled after that (written by ``joins.written_dealt``).
    ``accepted`` and ``joins.ORDER``: as in ``build_results``.
    """
    cat = guarantee_articles(art)
    guarantees = guarantees_per_order(staged, cat)
    promos = promo_lookup(promo, since if promo_since is None else promo_since)
    results = build_results(staged, guarantees, art, pref, emp, promos, shop, fact, since, marketplace_type, accepted=accepted)
    if materialize is None:
        results = written_by_order(results, "results")
        dealt = results
    else:
        results = written_dealt(results, "results", materialize)
        dealt = results.repartition(ORDER)
    materialize = materialize or written_dealt
    offered = offered_options(results)
    ordered = ordered_guarantees(results, cat)
    under = articles_under_guarantee(offered, cat)
    corr = correct_guarantee_employee(ordered, under).select(
        F.col("order_date").alias("__c_d"), F.col("ordernumber").alias("__c_o"),
        F.col("pk_article").alias("__c_p"), F.col(ORDER).alias("__c_order"), "affected_employee_corrected")
    alloc = allocate_running(under, ordered, guarantee_qty_per_order(ordered), materialize).select(
        F.col("order_date").alias("__a_d"), F.col("ordernumber").alias("__a_o"),
        F.col("pk_article").alias("__a_p"), F.col(ORDER).alias("__a_order"), "qty_guarantee_adjusted_sold")
    originals = keyed_originals(fact, results, materialize)
    ol = original_lines(originals, since_long).select(
        F.col("ordernumber").alias("__ol_o"), F.col("pk_article").alias("__ol_p"),
        F.col("affected_employee").alias("__ol_emp"), F.col("order_quantity").alias("__ol_qty"))
    oo = original_orders(originals, since_long).select(
        F.col("ordernumber").alias("__oo_o"), F.col("order_date").alias("__oo_d"),
        F.col("deliveryDate").alias("__oo_dd"))
    keyed = results.withColumn("__key", original_key("ordernumber"))
    r = dealt.withColumn("__key", original_key("ordernumber"))
    r = r.join(corr, (F.col(ORDER) == F.col("__c_order")) & (F.col("order_date") == F.col("__c_d")) & (F.col("ordernumber") == F.col("__c_o"))
               & (F.col("pk_article") == F.col("__c_p")), "left")
    r = r.join(alloc, (F.col(ORDER) == F.col("__a_order")) & (F.col("order_date") == F.col("__a_d")) & (F.col("ordernumber") == F.col("__a_o"))
               & (F.col("pk_article") == F.col("__a_p")), "left")
    # a line's original is another order: narrow rows go to it and come back
    r = join_narrow(r, keyed, ol, {"__key": "__ol_o", "pk_article": "__ol_p"})
    r = join_narrow(r, keyed, oo, {"__key": "__oo_o"})
    on = "ordernumber"
    out = r.select(
        *[c for c in FACT_COLUMNS[:9]],
        rekey_backorder(on, "order_date", "__oo_d").alias("order_date_orig"),
        rekey_backorder(on, "ordernumber", "__oo_o").alias("ordernumber_orig"),
        rekey_backorder(on, "deliverydate", "__oo_dd").alias("deliverydate_orig"),
        *FACT_COLUMNS[12:24],
        final_employee(on, "__ol_p", "__ol_emp", "order_date", "affected_employee",
                       "affected_employee_corrected", correction_start).alias("affected_employee"),
        *FACT_COLUMNS[25:35],
        split_backorder_measure(on, "order_quantity", False).alias("order_quantity"),
        split_backorder_measure(on, "order_article_net_price", False).alias("order_article_net_price"),
        split_backorder_measure(on, "order_quantity", True).alias("order_quantity_reliquat"),
        split_backorder_measure(on, "order_article_net_price", True).alias("order_article_net_price_reliquat"),
        classify_backorder(on, "__ol_p", "__ol_qty", "order_quantity").alias("type_reliquat"),
        "prom_id", "type_cmd",
        F.col("order_qty_guarantee").alias("qty_potential_guarantee_sold"),
        F.coalesce(F.col("qty_guarantee_adjusted_sold"), F.lit(0.0)).alias("qty_guarantee_adjusted_sold"),
        F.lit(local_now(as_of, tz).strftime("%Y-%m-%d %H:%M:%S")).alias("gcp_insert"),
    )
    return fact_select(out)


__all__ = ["FACT_COLUMNS", "fact_schema", "fact_select", "recent_fact", "append_new_only", "promo_lookup",
           "build_results", "keyed_originals", "stage_days", "for_days", "original_orders", "original_lines", "load_fact"]
