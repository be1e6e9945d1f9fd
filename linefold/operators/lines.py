"""From nested order feeds to one line schema.

Plan shape per feed: one pruned, filtered scan -> first version (rank window,
partial limit before the shuffle) -> explode of the items (narrow) -> status
rank per (order, article) (second rank window) -> roll-up (hash aggregate,
partial before the shuffle). Four feeds are stacked with ``unionByName``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefold.functions import constants as K
from linefold.functions.columns import (col, empty_to_null, lit_ts, null_of, parse_iso_millis, priority,
                                        round_sum, safe_bigint, safe_double, wall_clock)
from linefold.functions.timewin import from_day, ingest_since
from linefold.operators.versions import first_version, lowest_revision, top_rank

# Conformed line schema (23 columns) every feed is brought to.
LINE_COLUMNS = (
    "combiorderid", "origin_id", "combiordernumber", "ordernumber", "fulfillmenttype",
    "fulfillingstoreid", "customerhomestorenumber", "customernumber", "cardholderid",
    "deliveryDate", "deliveryType", "pickupStoreid", "validated_order_employee",
    "creationtime", "articleId", "positionNumber", "merchantname", "orderlineid",
    "replaceditemnumber", "paymentType_OM", "orderComments", "order_quantity", "sumNet",
)
# Roll-up keys: all but position and the two measures.
LINE_KEYS = tuple(c for c in LINE_COLUMNS if c not in ("positionNumber", "order_quantity", "sumNet"))

LINE_TYPES = {
    "pickupStoreid": "bigint", "positionNumber": "bigint", "creationtime": "timestamp_ntz",
    "order_quantity": "double", "sumNet": "double",
}

TS = "dana_ingestion_timestamp"
INGEST_DATE = "ingest_date"


def conform(df: DataFrame) -> DataFrame:
    """Project to the 23 line columns with their types (union by name after)."""
    return df.select(*[F.col(c).cast(LINE_TYPES.get(c, "string")).alias(c) for c in LINE_COLUMNS])


# --------------------------------------------------------------------------
# Windows of time on a feed
# --------------------------------------------------------------------------

def feed_window(creation_text: Column, ingest_ts: str, since: dt.date | None,
                min_date: dt.date | None, ingest_date: str = INGEST_DATE,
                fallback_since: bool = True, fallback_min: bool = True) -> Column:
    """Paris day of the order at or after ``min_date`` and ``since``; load day
    (a partition column) at or after ``since`` - 1.

    ``fallback_*``: the day falls back to the Paris day of the ingestion time
    when the creation text does not parse.
    """
    raw = parse_iso_millis(creation_text)
    # the cheap test first; the text is parsed once if both days are compared with the same instant
    cond = F.lit(True) if since is None else ingest_since(ingest_date, since)
    days: dict[bool, dt.date] = {}
    for day, fallback in ((min_date, fallback_min), (since, fallback_since)):
        if day is not None:
            days[fallback] = max(day, days.get(fallback, day))
    for fallback, day in days.items():
        cond = cond & from_day(F.coalesce(raw, F.col(ingest_ts).cast("timestamp_ntz")) if fallback else raw, day)
    return cond


# --------------------------------------------------------------------------
# D05, D06, D07
# --------------------------------------------------------------------------

def explode_lines(df: DataFrame, items: str = "items", alias: str = "item",
                  pos: str | None = None) -> DataFrame:
    """One row per element of ``items``; parents without elements stay
    with a null element. With ``pos``, also the 0-based offset (null then)."""
    keep = [F.col(c) for c in df.columns if c != items]
    if pos is None:
        return df.select(*keep, F.explode_outer(items).alias(alias))
    return df.select(*keep, F.posexplode_outer(items).alias(pos, alias))


def line_position(position: str | Column, pos: str | Column) -> Column:
    """COALESCE(positionNumber, offset + 1)."""
    return F.coalesce(col(position).cast("bigint"), (col(pos) + 1).cast("bigint"))


def rollup_lines(df: DataFrame, keys: Sequence[str] = LINE_KEYS, position: str = "positionNumber",
                 quantity: str = "order_quantity", net: str = "sumNet") -> DataFrame:
    """Per key, largest position and rounded sums of quantity and net."""
    return df.groupBy(*keys).agg(
        F.max(position).alias(position),
        round_sum(quantity).alias(quantity),
        round_sum(net).alias(net),
    )


def spread_total(lines: DataFrame, totals: DataFrame, key: str = "ordernumber",
                 net: str = "sumNet", total: str = "sumNetInclTaxesAndFees",
                 lines_sum: str = "sum_order_article_net_price",
                 stamp: str = "dana_ingestion_timestamp_min", article: str = "articleId",
                 cutoff: dt.datetime | None = K.NET_PRICE_CUTOFF,
                 fee_article: str = K.FEE_ARTICLE) -> DataFrame:
    """Spread the gap between the order total and the sum of its lines
    over the lines, in proportion: ``net + (total - s) * (net / s)``, rounded.

    Not from ``cutoff`` on (by ``stamp``), not when ``s`` is 0 or null, not for
    the fee article. ``totals`` holds (``key``, ``lines_sum``).
    """
    t = totals.select(F.col(key).alias("__sp_key"), F.col(lines_sum).alias("__sp_sum"))
    j = lines.join(t, F.col(key) == F.col("__sp_key"), "left")
    s = F.col("__sp_sum")
    spread = F.round(col(net) + (col(total) - s) * F.try_divide(col(net), s), 2)
    rule = F.when((F.coalesce(s, F.lit(0.0)) == 0) | (col(article) == fee_article), col(net)).otherwise(spread)
    if cutoff is not None:
        rule = F.when(col(stamp) >= lit_ts(cutoff), col(net)).otherwise(rule)
    return j.withColumn(net, rule.cast("double")).drop("__sp_key", "__sp_sum")


# --------------------------------------------------------------------------
# Per-feed lines
# --------------------------------------------------------------------------

def _ranked_lines(first: DataFrame, cols: list[Column], order: list[Column],
                  helpers: list[Column]) -> DataFrame:
    """Explode, project, keep status rank 1 per (combi, order, article), distinct."""
    x = explode_lines(first)
    proj = x.select(*cols, *helpers)
    kept = top_rank(proj, ["combiordernumber", "ordernumber", "articleId"], order)
    return kept.drop(*[h for h in proj.columns if h.startswith("__p")]).distinct()


def _head_cols(origin: Column, delivery_date: Column, delivery_type: Column,
               pickup: Column) -> list[Column]:
    return [
        F.col("combiorderid"), origin.alias("origin_id"), F.col("combiordernumber"),
        F.col("ordernumber"), F.col("fulfillmenttype"), F.col("fulfillingstoreid"),
        F.col("customerhomestorenumber"), F.col("customernumber"),
        F.col("cardholdernumber").alias("cardholderid"),
        delivery_date.alias("deliveryDate"), delivery_type.alias("deliveryType"),
        safe_bigint(pickup).alias("pickupStoreid"),
        F.col("orderContext.employeeId").alias("validated_order_employee"),
    ]


def webshop_lines(web: DataFrame, price_view: DataFrame, since: dt.date | None = None,
                  min_date: dt.date | None = K.MIN_ORDER_DATE,
                  net_cutoff: dt.datetime | None = K.NET_PRICE_CUTOFF) -> DataFrame:
    """Webshop feed: first version, status rank, price spread (D07), roll-up."""
    w = web.filter(feed_window(F.coalesce(F.col("orderContext.creationTime"), F.col("creationtime")),
                               TS, since, min_date))
    first = first_version(w, ["combiordernumber", "ordernumber"], TS)
    net = F.col("item.priceData.sumNet")
    if net_cutoff is not None:
        net = F.when(F.col(TS) >= lit_ts(net_cutoff), F.col("item.priceData.sumnetdouble")).otherwise(net)
    cols = _head_cols(F.col("orderContext.origin.id"), F.col("deliveryinformation.deliveryDate"),
                      F.col("deliveryinformation.deliveryType"), F.col("deliveryinformation.pickupStoreid")) + [
        F.col("pricesummary.sumNetInclTaxesAndFees").alias("sumNetInclTaxesAndFees"),
        wall_clock(TS).alias("dana_ingestion_timestamp_min"),
        F.col("item.articleId").alias("articleId"),
        F.col("item.quantity").alias("order_quantity"),
        net.alias("sumNet"),
        safe_bigint("item.positionNumber").alias("positionNumber"),
        null_of("string").alias("replaceditemnumber"),
        F.lit("").alias("merchantname"),
        wall_clock(parse_iso_millis("orderContext.creationTime")).alias("creationtime"),
        F.col("paymentData.paymentType").alias("paymentType_OM"),
        F.col("orderComments"),
    ]
    helpers = [priority("orderstatus", K.ORDER_STATUS_PRIORITY).alias("__p1"),
               priority("invoicestatus", K.INVOICE_STATUS_PRIORITY).alias("__p2")]
    order = [F.col("__p1").desc(), F.col("__p2").desc(), F.col("sumNetInclTaxesAndFees").desc()]
    q = _ranked_lines(first, cols, order, helpers)
    q = spread_total(q, price_view, cutoff=net_cutoff)
    q = q.withColumn("creationtime", F.coalesce("creationtime", "dana_ingestion_timestamp_min"))
    q = q.withColumn("orderlineid", null_of("string"))
    return conform(rollup_lines(q))


def dropship_lines(drop: DataFrame, since: dt.date | None = None,
                   min_date: dt.date | None = K.MIN_ORDER_DATE) -> DataFrame:
    """Dropship feed: as webshop without the spread and without the amount rank."""
    d = drop.filter(feed_window(F.coalesce(F.col("orderContext.creationTime"), F.col("creationtime")),
                                TS, since, min_date))
    first = first_version(d, ["combiordernumber", "ordernumber"], TS)
    cols = _head_cols(F.col("orderContext.origin.id"), F.col("deliveryinformation.deliveryDate"),
                      F.col("deliveryinformation.deliveryType"), F.col("deliveryinformation.pickupStoreid")) + [
        wall_clock(TS).alias("dana_ingestion_timestamp_min"),
        F.col("item.articleId").alias("articleId"),
        F.col("item.quantity").alias("order_quantity"),
        F.col("item.priceData.sumNet").alias("sumNet"),
        safe_bigint("item.positionNumber").alias("positionNumber"),
        null_of("string").alias("replaceditemnumber"),
        F.lit("").alias("merchantname"),
        wall_clock(parse_iso_millis("orderContext.creationTime")).alias("creationtime"),
        F.col("paymentData.paymentType").alias("paymentType_OM"),
        F.col("orderComments"),
    ]
    helpers = [priority("orderstatus", K.ORDER_STATUS_PRIORITY).alias("__p1"),
               priority("invoicestatus", K.INVOICE_STATUS_PRIORITY).alias("__p2")]
    order = [F.col("__p1").desc(), F.col("__p2").desc()]
    q = _ranked_lines(first, cols, order, helpers)
    q = q.withColumn("creationtime", F.coalesce("creationtime", "dana_ingestion_timestamp_min"))
    q = q.withColumn("orderlineid", null_of("string"))
    return conform(rollup_lines(q))


def marketplace_lines(mkt: DataFrame, since: dt.date | None = None,
                      min_date: dt.date | None = K.MIN_ORDER_DATE) -> DataFrame:
    """Marketplace feed: own field paths, line status and pickup store rank."""
    creation = F.coalesce(F.col("orderContext.creationTime"), F.col("creationtime"))
    m = mkt.filter(feed_window(creation, TS, since, min_date))
    first = first_version(m, ["combiordernumber", "ordernumber"], TS)
    cols = _head_cols(F.col("orderContext.id"), F.col("delivery.Date"), F.col("delivery.Type"),
                      F.col("pickup.storeid")) + [
        wall_clock(TS).alias("dana_ingestion_timestamp_min"),
        F.col("item.articleId").alias("articleId"),
        F.col("item.quantity").alias("order_quantity"),
        F.col("item.sumNet").alias("sumNet"),
        F.col("item.orderlineid").alias("orderlineid"),
        safe_bigint("item.positionNumber").alias("positionNumber"),
        null_of("string").alias("replaceditemnumber"),
        F.col("merchantname"),
        wall_clock(parse_iso_millis(creation)).alias("creationtime"),
        F.col("payment.Type").alias("paymentType_OM"),
        F.col("orderComments"),
    ]
    helpers = [priority("orderstatus", K.ORDER_STATUS_PRIORITY).alias("__p1"),
               priority("item.miraklOrderLineStatus", K.INVOICE_STATUS_PRIORITY).alias("__p2"),
               F.col("pickup.StoreName").alias("__p3")]
    order = [F.col("__p1").desc(), F.col("__p2").desc(), F.col("__p3").desc()]
    q = _ranked_lines(first, cols, order, helpers)
    q = q.withColumn("creationtime", F.coalesce("creationtime", "dana_ingestion_timestamp_min"))
    return conform(rollup_lines(q))


def fsd_lines(fsd: DataFrame, since: dt.date | None = None,
              min_date: dt.date | None = K.MIN_ORDER_DATE) -> DataFrame:
    """FSD feed.

    Lowest revision (then time) per order, joined back on six keys (D04);
    items with their offset; ``combiordernumber`` falls back to ``ordernumber``;
    HAK orders get type 'HAK'; '' employee is null; MIN of payment, origin,
    order id and creation time per line; replaced lines dropped.
    """
    creation = F.col("creationTime")
    o = fsd.filter(feed_window(creation, TS, since, min_date))
    # Rows whose day is only known from their load time are kept but not ranked.
    best = lowest_revision(o, ["combiordernumber", "ordernumber"],
                           [F.col("revision").asc(), F.col(TS).asc()],
                           match=["ordernumber", "combiordernumber", "status",
                                  "fulfillingStoreNumber", "revision", TS],
                           null_safe=["combiordernumber"],
                           ranked=feed_window(creation, TS, since, min_date, fallback_since=False))
    x = explode_lines(best, pos="__pos")
    g = x.groupBy(
        F.coalesce(F.col("combiordernumber"), F.col("ordernumber")).alias("combiordernumber"),
        F.col("ordernumber"),
        F.when(F.col("hakOrder"), F.lit(K.HAK_TYPE)).otherwise(F.col("fulfillmenttype")).alias("fulfillmenttype"),
        F.col("fulfillingstoreid"),
        F.col("customerHomeStoreNumber").alias("customerhomestorenumber"),
        F.col("customerNumber").alias("customernumber"),
        F.col("cardholderid"),
        F.col("deliverydate").alias("deliveryDate"),
        F.lit(K.FSD_DELIVERY_TYPE).alias("deliveryType"),
        empty_to_null("employeeId").alias("validated_order_employee"),
        F.col("item.articleId").alias("articleId"),
        line_position("item.positionNumber", "__pos").alias("positionNumber"),
        F.lit("").alias("merchantname"),
        F.lit("").alias("orderlineid"),
        F.col("item.replacedItemNumber").alias("replaceditemnumber"),
        F.col("item.quantity").alias("order_quantity"),
        safe_double("item.priceData.netPrice.sumPrice.amount").alias("sumNet"),
    ).agg(
        F.min("payment.paymentType").alias("paymentType_OM"),
        F.min("origin.id").alias("origin_id"),
        F.min("combiOrderId").alias("combiorderid"),
        F.min(wall_clock(parse_iso_millis("creationTime"))).alias("creationtime"),
    )
    g = g.filter(F.col("replaceditemnumber").isNull())
    g = g.withColumn("pickupStoreid", null_of("bigint")).withColumn("orderComments", null_of("string"))
    return conform(g).distinct()


def conform_feeds(web: DataFrame, drop: DataFrame, mkt: DataFrame, fsd: DataFrame,
                  price_view: DataFrame, since: dt.date | None = None,
                  min_date: dt.date | None = K.MIN_ORDER_DATE,
                  net_cutoff: dt.datetime | None = K.NET_PRICE_CUTOFF) -> DataFrame:
    """The four feeds in the 23-column line schema, stacked (UNION ALL)."""
    return (webshop_lines(web, price_view, since, min_date, net_cutoff)
            .unionByName(dropship_lines(drop, since, min_date))
            .unionByName(marketplace_lines(mkt, since, min_date))
            .unionByName(fsd_lines(fsd, since, min_date)))


# --------------------------------------------------------------------------
# Delivery-fee lines
# --------------------------------------------------------------------------

def _fee_branch(df: DataFrame, origin: Column, ddate: Column, dtype: Column, pickup: Column,
                creation: Column, article: str, merchant: Column, net: Column, payment: Column,
                cond: Column, feed: int) -> DataFrame:
    return df.filter(cond).select(
        *_head_cols(origin, ddate, dtype, pickup),
        creation.alias("__creation"),
        F.lit(article).alias("articleId"),
        null_of("bigint").alias("positionNumber"),
        merchant.alias("merchantname"),
        F.lit("").alias("orderlineid"),
        null_of("string").alias("replaceditemnumber"),
        F.lit(1.0).alias("order_quantity"),
        net.cast("double").alias("sumNet"),
        payment.alias("paymentType_OM"),
        null_of("string").alias("orderComments"),
        F.col(TS).alias("__ts"),
        F.lit(feed).alias("__feed"),
    )


def delivery_fee_lines(web: DataFrame, drop: DataFrame, mkt: DataFrame,
                       since: dt.date | None = None,
                       fee_cutoff: dt.datetime | None = K.FEE_RULE_CUTOFF) -> DataFrame:
    """One extra line per order with a delivery fee.

    Webshop and dropship: fee = empties gap before ``fee_cutoff``, delivery
    fees after; marketplace: its delivery fees. Fixed article id, quantity 1,
    first row per order by load time, then payment type descending; the three
    are stacked without duplicates.
    """
    def classic(df: DataFrame, feed: int) -> DataFrame:
        ps = "pricesummary."
        gap = F.col(ps + "sumNetInclTaxesFeesEmpties") - F.col(ps + "sumNetInclTaxesAndFees")
        fee = F.col(ps + "sumDeliveryFees")
        net = F.round(F.when(F.col(TS) < lit_ts(fee_cutoff), gap).otherwise(fee) if fee_cutoff else fee, 2)
        creation = F.col("orderContext.creationTime")
        cond = (F.col(ps + "sumNetInclTaxesFeesEmpties") != F.col(ps + "sumNetInclTaxesAndFees")) | (fee != 0)
        if since is not None:
            cond = cond & ingest_since(INGEST_DATE, since) & from_day(parse_iso_millis(creation), since)
        return _fee_branch(df, F.col("orderContext.origin.id"), F.col("deliveryinformation.deliveryDate"),
                           F.col("deliveryinformation.deliveryType"), F.col("deliveryinformation.pickupStoreid"),
                           creation, K.FEE_ARTICLE, F.lit(""), net, F.col("paymentData.paymentType"), cond, feed)

    creation = F.coalesce(F.col("orderContext.creationTime"), F.col("creationtime"))
    cond = F.col("priceSummary.sumDeliveryFees") != 0
    if since is not None:
        cond = cond & feed_window(creation, TS, since, None)
    m = _fee_branch(mkt, F.col("orderContext.id"), F.col("delivery.Date"), F.col("delivery.Type"),
                    F.col("pickup.storeid"), creation, K.FEE_ARTICLE_MKP, F.col("merchantname"),
                    F.col("priceSummary.sumDeliveryFees"), F.col("payment.Type"), cond, 2)
    # RANK per feed and order number by load time, then payment type
    # descending: one window over the three stacked feeds.
    stacked = classic(web, 0).unionByName(classic(drop, 1)).unionByName(m)
    kept = top_rank(stacked, ["__feed", "ordernumber"], [F.col("__ts").asc(), F.col("paymentType_OM").desc()])
    # times of the rows that are kept only
    kept = kept.withColumns({"creationtime": wall_clock(parse_iso_millis("__creation")), "dana_ingestion_timestamp_min": wall_clock("__ts")})
    stacked = kept.drop("__ts", "__feed", "__creation").distinct()
    stacked = stacked.withColumn("creationtime", F.coalesce("creationtime", "dana_ingestion_timestamp_min"))
    return conform(stacked)


# --------------------------------------------------------------------------
# Service options per article
# --------------------------------------------------------------------------

def options_per_article(web: DataFrame, drop: DataFrame, since: dt.date | None = None) -> DataFrame:
    """Sorted array of service option ids per (combi, order, article).

    Two-level unnest, distinct per feed, stacked, null option as ''. The
    array holds the distinct options of one article line (bounded by the
    option catalogue), not a group of rows.
    """
    def one(df: DataFrame, feed: int) -> DataFrame:
        if since is not None:
            df = df.filter(F.col(TS) >= lit_ts(dt.datetime.combine(since, dt.time())))  # pushed to the scan
        x = df.select("combiordernumber", "ordernumber", F.explode_outer("items").alias("item"))
        x = x.select("combiordernumber", "ordernumber", F.col("item.articleId").alias("articleId"),
                     F.explode_outer("item.articledata.serviceoptions").alias("opt"))
        return x.select("combiordernumber", "ordernumber", "articleId",
                        F.col("opt.id").alias("id_option"), F.lit(feed).alias("__feed"))

    # DISTINCT per feed, then UNION ALL: a set of feed and option, one shuffle for both.
    both = one(web, 0).unionByName(one(drop, 1))
    sets = both.groupBy("combiordernumber", "ordernumber", "articleId").agg(F.collect_set(F.struct("__feed", "id_option")).alias("__set"))
    options = F.sort_array(F.transform("__set", lambda x: F.coalesce(x["id_option"], F.lit(""))))
    return sets.select("combiordernumber", "ordernumber", "articleId", options.alias("id_options"))


__all__ = [
    "LINE_COLUMNS", "LINE_KEYS", "conform", "feed_window", "explode_lines", "line_position",
    "rollup_lines", "spread_total", "webshop_lines", "dropship_lines", "marketplace_lines",
    "fsd_lines", "conform_feeds", "delivery_fee_lines", "options_per_article",
]
