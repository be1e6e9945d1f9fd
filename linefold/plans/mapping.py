"""Mapping M: the driver's TPC-H-like tables as the order feeds and dimensions

The flat part of M is written once as SQL both Spark and DuckDB run (the same
text feeds ``spark.sql`` here and the oracle's CTEs), so both sides see the
same inputs. The nested feeds (``items`` arrays of structs) are then built in
Spark from the flat views; the oracle stays flat.

Every view is derived from the given tables, so its size grows with them.
A "version" of an order is the set of its lines shipped on one day; orders
without lines get one empty version stamped with the order date.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import uuid
from string import Template

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linefold.operators.joins import ORDER as BY_KEY
from linefold.operators.joins import written_by_order
from linefold.session import checkpoint_root

TABLES = ("orders", "lineitem", "events", "part", "supplier", "customer")

# Parameters of the proofs (both sides use the same values).
SINCE = dt.date(1997, 1, 1)              # start of the load window
MIN_DATE = dt.date(1995, 6, 20)          # oldest order day considered
NET_CUTOFF = dt.datetime(1999, 5, 14, 9, 0, 0)
FEE_CUTOFF = dt.datetime(1999, 10, 1)
TAG_ORDER_CUTOFF = dt.datetime(2024, 1, 10)
TAG_BUNDLE_CUTOFF = dt.datetime(2024, 1, 20)
EVENTS_SINCE = dt.date(2024, 1, 5)
CORRECTION_START = dt.date(1999, 9, 28)
FACT_SPLIT = dt.date(2000, 1, 1)         # old fact = staged lines before this day
LOOKBACK_SINCE = dt.date(1999, 6, 1)     # duplicate test window of the fact
LONG_SINCE = dt.date(1998, 3, 1)         # originals of backorders
AS_OF = dt.datetime(2001, 9, 1, 12, 0, 0)
GCP_INSERT = "2001-09-01 14:00:00"       # Paris text of AS_OF
REJECT_TIME = "2001-08-31 10:00:00"      # first reject time of the earlier rejects
EXTERNAL_DOMAINS = ("@EXTERNAL.EXAMPLE", "@PARTNER.EXAMPLE")
PROMO_SINCE = dt.date(1996, 1, 1)
EMP_SINCE = dt.date(2000, 6, 1)

_EMP = ("CASE WHEN {s} IS NULL THEN NULL WHEN {s} % 5 = 0 THEN NULL "
        "WHEN {s} % 13 = 0 THEN 'emp' || CAST({s} AS STRING) || '@EXTERNAL.EXAMPLE' "
        "ELSE 'emp' || CAST({s} AS STRING) || '@x' END")
_ON = ("CASE WHEN {k} % 10 = 0 THEN '9-' || CAST({k} + 1 AS STRING) || '-1' "
       "ELSE '9-' || CAST({k} AS STRING) END")

VIEWS: dict[str, str] = {}

VIEWS["m_heads"] = f"""
SELECT o_orderkey AS k,
  {_ON.format(k='o_orderkey')} AS ordernumber,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE {_ON.format(k='o_orderkey')} END AS combiordernumber,
  CAST(o_orderkey AS STRING) AS combiorderid,
  CAST(o_orderkey % 4 AS INT) AS feed,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN 'WEBSHOP'
       WHEN o_orderkey % 4 = 1 THEN 'DROPSHIPMENT' WHEN o_orderkey % 4 = 2 THEN 'MARKETPLACE'
       ELSE 'FSD' END AS fulfillmenttype,
  CASE WHEN o_orderkey % 2 = 0 THEN '113' ELSE CAST(o_orderkey % 7 + 110 AS STRING) END AS fulfillingstoreid,
  CAST(o_custkey % 150 AS STRING) AS customerhomestorenumber,
  CAST(o_custkey AS STRING) AS customernumber,
  CAST(o_custkey * 10 + 1 AS STRING) AS cardholdernumber,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL
       WHEN o_orderkey % 29 = 0 THEN 'not-a-time'
       ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T'
            || lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':30:00.000Z' END AS ctx_creation,
  CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T12:00:00.000Z' AS top_creation,
  CAST(CAST(o_orderdate AS DATE) + 5 AS STRING) AS deliverydate,
  CASE WHEN o_orderkey % 2 = 0 THEN 'HOME' ELSE 'PICKUP' END AS deliverytype,
  CASE WHEN o_orderkey % 2 = 1 THEN CAST(o_orderkey % 50 AS STRING) ELSE 'none' END AS pickupstore,
  'store' || CAST(o_orderkey % 3 AS STRING) AS pickupstorename,
  CASE WHEN o_orderkey % 3 = 0 THEN 'app' ELSE 'site' END AS origin,
  CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'PENDING' ELSE 'PICKING' END AS orderstatus,
  o_totalprice AS total,
  o_totalprice + CASE WHEN o_orderkey % 3 = 0 THEN 4.9 ELSE 0.0 END AS total_empties,
  CASE WHEN o_orderkey % 5 = 0 THEN 5.9 ELSE 0.0 END AS delivery_fees,
  o_orderpriority AS ordercomments,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 7 = 3 END AS hak,
  o_orderdate AS orderdate
FROM $orders
"""

VIEWS["m_lines"] = f"""
SELECT l_orderkey AS k, l_shipdate AS ts, l_partkey, l_suppkey, l_linenumber, l_quantity,
  l_extendedprice, l_discount, l_returnflag, l_linestatus,
  CAST(l_partkey AS STRING) AS articleid,
  CASE WHEN l_linenumber = 5 THEN 'x5' ELSE CAST(l_linenumber AS STRING) END AS position_text,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS position_num,
  CASE WHEN l_linenumber = 7 THEN 'r' || CAST(l_partkey AS STRING) ELSE NULL END AS replaced,
  l_extendedprice * (1 - l_discount) AS net_double,
  CASE WHEN l_linenumber = 6 THEN 'n/a' ELSE CAST(l_extendedprice AS STRING) END AS amount_text,
  CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS orderlineid,
  CASE l_returnflag WHEN 'R' THEN 'VOIDED' WHEN 'A' THEN 'CREATED' ELSE 'SENT' END AS line_status,
  {_EMP.format(s='l_suppkey')} AS employee,
  'shop' || CAST(l_suppkey % 12 AS STRING) AS merchantname,
  CASE WHEN l_linenumber = 4 THEN 0 WHEN l_linenumber = 3 THEN 1 ELSE 2 END AS n_opts,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_linenumber AS STRING) END AS opt1,
  CAST(l_suppkey AS STRING) AS opt2
FROM $lineitem
"""

# One row per version (order, ship day); empty orders: one version at the order date.
_VER_COLUMNS = f"""
SELECT v.*,
  {_EMP.format(s='v.vs')} AS employee,
  CASE WHEN v.vs IS NULL THEN NULL WHEN v.vs % 5 = 0 THEN ''
       ELSE 'emp' || CAST(v.vs AS STRING) || '@x' END AS employee_raw,
  CASE v.vl % 3 WHEN 0 THEN 'CARD' WHEN 1 THEN 'CASH' ELSE 'VOUCHER' END AS payment,
  CASE v.vst WHEN 'F' THEN 'SENT' WHEN 'O' THEN 'PENDING' ELSE 'EMPTY' END AS invoicestatus,
  CAST(v.ts AS DATE) AS ingest_date,
  'shop' || CAST(v.vs % 12 AS STRING) AS merchantname
"""
VIEWS["m_ver"] = f"""{_VER_COLUMNS}FROM (
  SELECT h.k AS k, COALESCE(l.ts, h.orderdate) AS ts, MIN(l.l_suppkey) AS vs,
         MIN(l.l_linenumber) AS vl, MIN(l.l_linestatus) AS vst, COUNT(l.k) AS nlines
  FROM $m_heads h LEFT JOIN $m_lines l ON h.k = l.k
  GROUP BY h.k, COALESCE(l.ts, h.orderdate)
) v
"""

VIEWS["m_events"] = """
SELECT e.*,
  CASE WHEN e.event_id % 13 = 0
       THEN '{"bundleId": ' || e.tag_bundle || ', "userId": "' || e.tag_user || '"}'
       ELSE '{"orderId": "' || e.tag_order || '", "bundleId": ' || e.tag_bundle
            || ', "userId": "' || e.tag_user || '"}' END AS tags
FROM (
  SELECT event_id, ts, user_id, event_type,
    CASE event_type WHEN 'purchase' THEN 'order-submit-employee-commissions.quantity'
                    WHEN 'click' THEN 'order-submit-employee-commissions.price'
                    WHEN 'view' THEN 'order.submit.employeeCommissions.price'
                    ELSE event_type END AS eventtype,
    CAST(CAST(FLOOR(event_id / 2) AS BIGINT) AS STRING) AS tag_order,
    COALESCE(CASE WHEN event_id % 4 <> 3 THEN CAST(l.art AS STRING) END, $json_k) AS tag_bundle,
    CASE WHEN user_id % 7 = 0 THEN 'u' || CAST(user_id AS STRING)
         ELSE 'u' || CAST(user_id AS STRING) || '@x' END AS tag_user,
    CAST(CAST(FLOOR(event_id / 2) AS BIGINT) AS STRING) AS parsed_order,
    COALESCE(CASE WHEN event_id % 4 <> 3 THEN CAST(l.art AS STRING) END, 'b' || $json_k) AS parsed_bundle,
    CAST(ts AS DATE) AS ingest_date,
    CAST(event_id % 3 = 0 AS BOOLEAN) AS is_commission
  FROM $events
  -- three of four events are about an article of an order, two events an order
  LEFT JOIN (SELECT l_orderkey, MIN(l_partkey) AS art FROM $lineitem GROUP BY l_orderkey) l
    ON l.l_orderkey = CAST(FLOOR(event_id / 2) AS BIGINT)
) e
"""

VIEWS["m_art"] = """
SELECT CAST(p_partkey AS STRING) AS articleId,
  CAST(p_partkey % 7 + 1 AS BIGINT) AS combinedarticleid,
  CAST(CASE p_size % 9 WHEN 1 THEN 156701 WHEN 3 THEN 163323 WHEN 5 THEN 827176
       WHEN 7 THEN 681270 WHEN 8 THEN 624097 ELSE 1000000 + p_partkey END AS BIGINT) AS articleNumber,
  p_partkey AS pk_article
FROM $part WHERE p_size <= 45
"""

# Employee-day history: the (supplier, day) pairs that occur in the line items
# (order day and the day after, as Paris days can fall on either), so its
# size is linear in the data; every seventh supplier has no history.
_EMP_COLUMNS = """CAST(s.s_suppkey AS STRING) AS id,
  CASE WHEN s.s_suppkey % 13 = 0 THEN 'emp' || CAST(s.s_suppkey AS STRING) || '@EXTERNAL.EXAMPLE'
       ELSE 'emp' || CAST(s.s_suppkey AS STRING) || '@x' END AS userprincipalname,
  d.d AS date_of_day,
  CASE s.s_suppkey % 3 WHEN 0 THEN 'STORE' WHEN 1 THEN 'CUSTOMER' ELSE NULL END AS service,
  CAST(s.s_nationkey * 10 AS BIGINT) AS id_store"""
VIEWS["m_emp"] = f"""
SELECT DISTINCT {_EMP_COLUMNS}
FROM (
  SELECT l.l_suppkey AS sk, CAST(o.o_orderdate AS DATE) AS d
  FROM $lineitem l JOIN $orders o ON l.l_orderkey = o.o_orderkey
  UNION ALL
  SELECT l.l_suppkey AS sk, CAST(o.o_orderdate AS DATE) + 1 AS d
  FROM $lineitem l JOIN $orders o ON l.l_orderkey = o.o_orderkey
) d JOIN $supplier s ON s.s_suppkey = d.sk
WHERE s.s_suppkey % 7 <> 0
"""

VIEWS["m_promo"] = """
SELECT CAST(l_shipdate AS DATE) AS date_of_day,
  CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_partkey AS STRING) END AS articleId,
  CAST(l_suppkey % 7 + 110 AS BIGINT) AS store_id,
  l_orderkey AS prom_id
FROM $lineitem
"""

VIEWS["m_bridge"] = """
SELECT DISTINCT CAST(s_suppkey % 12 AS BIGINT) AS shopid,
  'shop' || CAST(s_suppkey % 12 AS STRING) AS merchantname
FROM $supplier WHERE s_suppkey % 12 < 10
"""

VIEWS["m_pref"] = """
SELECT CAST(o.o_custkey % 150 AS BIGINT) AS home_store_id, o.o_custkey AS cust_no,
  CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS BIGINT) AS month_id,
  CAST(c.c_nationkey + 100 AS BIGINT) AS store_id
FROM $orders o JOIN $customer c ON o.o_custkey = c.c_custkey
WHERE c.c_custkey % 4 = 0
"""

VIEWS["m_price"] = """
SELECT h.ordernumber AS ordernumber,
  CAST(ROUND(SUM(CAST(l.l_extendedprice AS DECIMAL(28,9))), 2) AS DOUBLE) AS sum_order_article_net_price
FROM $m_lines l JOIN $m_heads h ON l.k = h.k
GROUP BY h.ordernumber
"""

VIEWS["m_mkp"] = f"""
SELECT {_ON.format(k='l_orderkey')} AS OrderId,
  CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS OrderLineId,
  l_discount AS CommissionFee,
  CAST(l_suppkey % 12 AS BIGINT) AS Shopid,
  l_shipdate AS dana_ingestion_timestamp
FROM $lineitem
"""

# Staged lines (the stage table's schema) for the fact-side proofs: one row per
# line item; articles recur across orders (part key mod 50). Backorders and
# the orders they belong to (keys 0 and 1 mod 10) share articles by line
# number, and every fourth such pair has equal quantities.
VIEWS["m_staged"] = f"""
SELECT CAST(h.orderdate AS DATE) AS order_date,
  CAST(year(h.orderdate) * 10000 + month(h.orderdate) * 100 + dayofmonth(h.orderdate) AS BIGINT) AS order_day,
  CAST(year(h.orderdate) * 100 + month(h.orderdate) AS BIGINT) AS order_month,
  lpad(CAST(h.k % 24 AS STRING), 2, '0') || ':30' AS order_time,
  h.origin AS origin_id, h.combiordernumber, h.ordernumber, h.fulfillmenttype,
  CAST(h.fulfillingstoreid AS BIGINT) AS fulfillingstoreid,
  CAST(h.customerhomestorenumber AS BIGINT) AS customerhomestorenumber,
  CAST(h.customernumber AS BIGINT) AS customernumber,
  CAST(h.cardholdernumber AS BIGINT) AS cardholderid,
  h.deliverydate AS deliveryDate, h.deliverytype AS deliveryType,
  CAST(NULL AS BIGINT) AS pickupStoreid,
  l.employee AS validated_order_employee,
  CAST(NULL AS STRING) AS added_to_basket_employee,
  l.employee AS affected_employee,
  CASE WHEN h.k % 10 IN (0, 1) THEN CAST(l.l_linenumber * 7 AS STRING) ELSE CAST(l.l_partkey % 50 + 1 AS STRING) END AS articleId,
  CAST(l.l_linenumber AS BIGINT) AS positionNumber,
  CAST(NULL AS BIGINT) AS shopid,
  CASE WHEN h.feed = 2 THEN l.merchantname ELSE NULL END AS merchantname,
  'CARD' AS paymentType_OM, h.ordercomments AS orderComments,
  l.replaced AS replacedItemNumber,
  l.n_opts, l.opt1, l.opt2,
  CASE WHEN h.k % 40 IN (0, 1) THEN CAST(10 + l.l_linenumber AS DOUBLE) ELSE l.l_quantity END AS order_quantity,
  l.l_extendedprice AS order_article_net_price,
  CAST(NULL AS STRING) AS reject_insert,
  '{GCP_INSERT}' AS gcp_insert,
  h.k AS k
FROM $m_lines l JOIN $m_heads h ON l.k = h.k
"""

# The fact before the run: staged lines of orders before FACT_SPLIT.
VIEWS["m_fact_old"] = f"""
SELECT s.order_date, s.ordernumber, s.articleId AS articleid, s.positionNumber AS positionnumber,
  s.fulfillmenttype, s.deliveryDate AS deliverydate, s.affected_employee,
  s.order_quantity, CAST(s.articleId AS BIGINT) AS pk_article,
  CAST(CASE WHEN s.k % 10 = 0 THEN 2 ELSE 1 END AS BIGINT) AS type_cmd
FROM $m_staged s WHERE s.order_date < DATE '{FACT_SPLIT}'
"""

ORDER = ("m_heads", "m_lines", "m_ver", "m_events", "m_art", "m_emp", "m_promo",
         "m_bridge", "m_pref", "m_price", "m_mkp", "m_staged", "m_fact_old")

# Spark side: the tables dealt by order key, and the views that join them by it.
DEALT = {"m_heads": ("orders", "o_orderkey"), "m_lines": ("lineitem", "l_orderkey")}
BY_ORDER = ("m_price", "m_staged")
SUMMED = ("m_price",)  # written once per session: one narrow row per order

ENGINE_TOKENS = {
    "spark": {"json_k": "get_json_object(props, '$.k')"},
    "duckdb": {"json_k": "json_extract_string(props, '$.k')"},
}


def _deps(name: str) -> list[str]:
    text = VIEWS[name]
    return [v for v in ORDER if "$" + v + " " in text or "$" + v + "\n" in text]


def oracle_ctes(names: list[str] | tuple[str, ...]) -> str:
    """``WITH`` clause defining ``names`` (and what they need) for DuckDB."""
    need: list[str] = []

    def add(n: str) -> None:
        for d in _deps(n):
            add(d)
        if n not in need:
            need.append(n)

    for n in names:
        add(n)
    need.sort(key=ORDER.index)
    subs = {t: t for t in TABLES}
    subs.update({v: v for v in ORDER})
    subs.update(ENGINE_TOKENS["duckdb"])
    parts = [f"{n} AS ({Template(VIEWS[n]).substitute(subs).strip()})" for n in need]
    return "WITH " + ",\n".join(parts) + "\n"


def _line_item(k: Column, x: Column) -> dict[str, Column]:
    """The columns of ``m_lines`` that the items of the feeds hold, from an
    element of ``Mapping._versions`` of the order ``k``."""
    n, part, supp = x["s1"], x["s2"], x["s3"]
    number = n.cast("string")
    o1 = F.struct(F.when(n == 3, F.lit(None)).otherwise(number).alias("id"))
    o2 = F.struct(supp.cast("string").alias("id"))
    return {
        "articleid": part.cast("string"), "l_quantity": x["s4"],
        "position_text": F.when(n == 5, F.lit("x5")).otherwise(number),
        "position_num": F.when(n % 3 == 0, F.lit(None)).otherwise(n.cast("bigint")),
        "replaced": F.when(n == 7, F.concat(F.lit("r"), part.cast("string"))),
        "l_extendedprice": x["s5"], "net_double": x["s6"],
        "amount_text": F.when(n == 6, F.lit("n/a")).otherwise(x["s5"].cast("string")),
        "orderlineid": F.concat(k.cast("string"), F.lit("-"), number), "line_status": x["s7"],
        "options": (F.when(n == 4, F.array().cast("array<struct<id:string>>"))
                    .when(n == 3, F.array(o1))
                    .otherwise(F.array(o1, o2)))}


class Mapping:
    """Spark side of M for one data folder. Views and feeds are queries over
    the given tables, so an operator reads (and shuffles) only the columns that
    it uses. Orders and line items meet by order key: they are dealt by it as
    raw columns, and what M derives from them is worked out after that."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.prefix = "lf_" + hashlib.sha1(self.sf_dir.encode()).hexdigest()[:8] + "_"
        self._views: dict[str, DataFrame] = {}
        self._feeds: dict[str, DataFrame] = {}

    def feed(self, name: str) -> DataFrame:
        """A feed as a query over the given tables, for queries that read it once."""
        return getattr(self, f"_build_{name}")()

    def kept(self, name: str) -> DataFrame:
        """A feed written once per session as Parquet and read back, for
        queries that read it several times."""
        if name not in self._feeds:
            self._feeds[name] = self._written(name, self.feed(name))
        return self._feeds[name]

    def _written(self, name: str, df: DataFrame) -> DataFrame:
        app = self.spark.sparkContext.applicationId
        path = f"{checkpoint_root(self.spark).rstrip('/')}/linefold-m/{app}/{self.prefix}{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        full = self.prefix + name
        if name in TABLES:
            if not self.spark.catalog.tableExists(full):
                self.table(name).createOrReplaceTempView(full)
            return self.spark.table(full)
        if name not in self._views:
            names = {}
            for n in (*TABLES, *ORDER):
                if name in BY_ORDER and n in DEALT:
                    names[n] = f"{self.prefix}dealt_{n}"
                    self._dealt(n).createOrReplaceTempView(names[n])
                elif re.search(rf"\${n}\b", VIEWS[name]):
                    self.view(n)
                    names[n] = self.prefix + n
            text = Template(VIEWS[name]).substitute({**ENGINE_TOKENS["spark"], **names})
            df = self._emp() if name == "m_emp" else self.spark.sql(text)
            df = self._written(name, df) if name in SUMMED else df
            df.createOrReplaceTempView(full)
            self._views[name] = self.spark.table(full)
        return self._views[name]

    def _dealt(self, name: str, feed: int | None = None) -> DataFrame:
        """``m_heads`` or ``m_lines`` over its table (rows of one feed, or all)
        dealt by order key before anything is derived."""
        source, key = DEALT[name]
        rows = self.table(source)
        if feed is not None:
            rows = rows.filter(F.col(key) % 4 == feed)
        return self.spark.sql(Template(VIEWS[name]).substitute({source: "{rows}"}), rows=rows.repartition(key))

    def _emp(self) -> DataFrame:
        """The rows of ``m_emp``: the pairs of supplier and day are made distinct
        as numbers, and dealt once, by supplier, for both of their days."""
        orders = self.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
        sold = self.table("lineitem").select("l_orderkey", F.col("l_suppkey").alias("sk")).filter(F.col("sk") % 7 != 0)
        # as many tasks as the session's shuffles have: such pairs are small on disk, and fewer tasks keep too many in memory
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        days = sold.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("sk", "d").repartition(n, "sk").distinct()
        days = days.select("sk", F.explode(F.array("d", F.date_add("d", 1))).alias("d")).distinct()
        suppliers = self.table("supplier").select("s_suppkey", "s_nationkey").distinct()
        return self.spark.sql(f"SELECT {_EMP_COLUMNS} FROM {{days}} d JOIN {{suppliers}} s ON s.s_suppkey = d.sk",
                              days=days, suppliers=suppliers)

    # ------------------------------------------------------------------
    # Nested feeds
    # ------------------------------------------------------------------
    def _versions(self, feed: int, item) -> DataFrame:
        """Version rows of one feed with their ``items`` array (``item`` maps
        the columns of a line, by ``_line_item``, to the feed's own struct).

        The rows of ``m_ver`` with the lines of the order and day, from one
        dealing of the line items by order key: every line of a version in one
        array, sorted by a stable key.
        """
        heads, lines = self._dealt("m_heads", feed), self._dealt("m_lines", feed)
        # an element is narrow and what tells lines apart: a task groups, joins and sorts these
        # arrays, and the other texts of a line are worked out of them at the end (_line_item)
        e = F.struct(
            F.col("l_linenumber").alias("s1"), F.col("l_partkey").alias("s2"),
            F.col("l_suppkey").alias("s3"), F.col("l_quantity").alias("s4"),
            F.col("l_extendedprice").alias("s5"), F.col("net_double").alias("s6"),
            F.col("line_status").alias("s7"))
        # the join of m_ver; of heads with one key, the first brings the items of the others too
        first = F.row_number().over(Window.partitionBy("k").orderBy("orderdate")) == 1
        dated = heads.select("k", "orderdate", first.alias("once")).join(
            lines.withColumnRenamed("k", "lk"), F.col("k") == F.col("lk"), "left")
        # lines without a day make the version of the order date, as in m_ver, but are among no items
        ver = dated.groupBy("k", F.coalesce("ts", "orderdate").alias("ts")).agg(
            F.min("l_suppkey").alias("vs"), F.min("l_linenumber").alias("vl"), F.min("l_linestatus").alias("vst"),
            F.count("lk").alias("nlines"), F.collect_list(F.when(F.col("once") & F.col("ts").isNotNull(), e)).alias("es"))
        v = self.spark.sql(_VER_COLUMNS + "FROM {rows} v", rows=ver).join(heads, "k")
        items = F.transform(F.array_sort("es"), lambda x: item(_line_item(F.col("k"), x)))
        return v.withColumn("items", items).drop("es")

    def _classic(self, feed: int) -> DataFrame:
        def item(x):
            return F.struct(
                x["articleid"].alias("articleId"), x["l_quantity"].alias("quantity"),
                x["position_text"].alias("positionNumber"),
                F.struct(x["l_extendedprice"].alias("sumNet"), x["net_double"].alias("sumnetdouble")).alias("priceData"),
                F.struct(x["options"].alias("serviceoptions")).alias("articledata"))
        v = self._versions(feed, item)
        return v.select(
            "combiorderid", "combiordernumber", "ordernumber", "fulfillmenttype",
            "fulfillingstoreid", "customerhomestorenumber", "customernumber", "cardholdernumber",
            F.struct(F.struct(F.col("origin").alias("id")).alias("origin"),
                     F.col("employee").alias("employeeId"),
                     F.col("ctx_creation").alias("creationTime")).alias("orderContext"),
            F.col("top_creation").alias("creationtime"),
            F.struct(F.col("deliverydate").alias("deliveryDate"), F.col("deliverytype").alias("deliveryType"),
                     F.col("pickupstore").alias("pickupStoreid")).alias("deliveryinformation"),
            F.struct(F.col("total").alias("sumNetInclTaxesAndFees"),
                     F.col("total_empties").alias("sumNetInclTaxesFeesEmpties"),
                     F.col("delivery_fees").cast("double").alias("sumDeliveryFees")).alias("pricesummary"),
            F.struct(F.col("payment").alias("paymentType")).alias("paymentData"),
            F.col("ordercomments").alias("orderComments"),
            "orderstatus", "invoicestatus",
            F.col("ts").alias("dana_ingestion_timestamp"), "ingest_date", "items")

    def webshop(self) -> DataFrame:
        return self.kept("webshop")

    def _build_webshop(self) -> DataFrame:
        return self._classic(0)

    def dropship(self) -> DataFrame:
        return self.kept("dropship")

    def _build_dropship(self) -> DataFrame:
        return self._classic(1)

    def marketplace(self) -> DataFrame:
        return self.kept("marketplace")

    def _build_marketplace(self) -> DataFrame:
        def item(x):
            return F.struct(
                x["articleid"].alias("articleId"), x["l_quantity"].alias("quantity"),
                x["l_extendedprice"].alias("sumNet"), x["orderlineid"].alias("orderlineid"),
                x["position_text"].alias("positionNumber"), x["line_status"].alias("miraklOrderLineStatus"))
        v = self._versions(2, item)
        return v.select(
            "combiorderid", "combiordernumber", "ordernumber", "fulfillmenttype",
            "fulfillingstoreid", "customerhomestorenumber", "customernumber", "cardholdernumber",
            F.struct(F.col("origin").alias("id"), F.col("employee").alias("employeeId"),
                     F.col("ctx_creation").alias("creationTime")).alias("orderContext"),
            F.col("top_creation").alias("creationtime"),
            F.col("employee_raw").alias("employeeId"),
            F.struct(F.col("deliverydate").alias("Date"), F.col("deliverytype").alias("Type")).alias("delivery"),
            F.struct(F.col("pickupstore").alias("storeid"), F.col("pickupstorename").alias("StoreName")).alias("pickup"),
            F.struct(F.col("payment").alias("Type")).alias("payment"),
            F.struct(F.col("delivery_fees").cast("double").alias("sumDeliveryFees")).alias("priceSummary"),
            F.col("merchantname"),
            F.col("ordercomments").alias("orderComments"),
            "orderstatus",
            F.col("ts").alias("dana_ingestion_timestamp"), "ingest_date", "items")

    def fsd(self) -> DataFrame:
        return self.kept("fsd")

    def _build_fsd(self) -> DataFrame:
        def item(x):
            return F.struct(
                x["articleid"].alias("articleId"), x["position_num"].alias("positionNumber"),
                x["replaced"].alias("replacedItemNumber"), x["l_quantity"].alias("quantity"),
                F.struct(F.struct(F.struct(x["amount_text"].alias("amount")).alias("sumPrice"))
                         .alias("netPrice")).alias("priceData"))
        v = self._versions(3, item)
        return v.select(
            "ordernumber", "combiordernumber", F.col("combiorderid").alias("combiOrderId"),
            F.col("hak").alias("hakOrder"), "fulfillmenttype", "fulfillingstoreid",
            F.col("customerhomestorenumber").alias("customerHomeStoreNumber"),
            F.col("customernumber").alias("customerNumber"),
            F.col("cardholdernumber").alias("cardholderid"), "deliverydate",
            F.col("employee_raw").alias("employeeId"),
            F.col("orderstatus").alias("status"),
            F.col("fulfillingstoreid").alias("fulfillingStoreNumber"),
            F.col("nlines").alias("revision"),
            F.col("ctx_creation").alias("creationTime"),
            F.struct(F.col("origin").alias("id")).alias("origin"),
            F.struct(F.col("payment").alias("paymentType")).alias("payment"),
            F.col("ts").alias("dana_ingestion_timestamp"), "ingest_date", "items")

    # ------------------------------------------------------------------
    # Events, dimensions
    # ------------------------------------------------------------------
    def structured(self) -> DataFrame:
        return self.feed("structured")

    def _build_structured(self) -> DataFrame:
        e = self.view("m_events").filter(~F.col("is_commission"))
        return e.select("tags",
                        F.struct(F.col("parsed_order").alias("orderId"),
                                 F.col("parsed_bundle").alias("bundleid")).alias("parsedtags"),
                        "eventtype", F.col("ts").alias("dana_ingestion_timestamp"), "ingest_date")

    def commissions(self) -> DataFrame:
        return self.feed("commissions")

    def _build_commissions(self) -> DataFrame:
        e = self.view("m_events").filter(F.col("is_commission"))
        return e.select("tags", "eventtype", F.col("ts").alias("dana_ingestion_timestamp"), "ingest_date")

    def _stage_shape(self, s: DataFrame, *more: Column) -> DataFrame:
        opts = (F.when(F.col("n_opts") == 0, F.array().cast("array<string>"))
                .when(F.col("n_opts") == 1, F.array(F.lit("")))
                .otherwise(F.array(F.col("opt1"), F.col("opt2"))))
        cols = [c for c in s.columns if c not in ("n_opts", "opt1", "opt2", "k", "reject_insert", "gcp_insert",
                                                   "order_quantity", "order_article_net_price")]
        return s.select(*cols, opts.alias("id_options"), "order_quantity", "order_article_net_price",
                        "reject_insert", "gcp_insert", *more)

    def staged(self) -> DataFrame:
        return self.kept("staged")

    def _build_staged(self) -> DataFrame:
        """The stage table's 30 columns, with ``id_options`` as an array."""
        return self._stage_shape(self.view("m_staged"))

    def dealt_staged(self) -> DataFrame:
        """The stage table with ``joins.ORDER``: the order key, by which M deals
        lines and orders to join them, so what follows per order needs no shuffle."""
        s = self.view("m_staged")
        return self._stage_shape(s, F.col("k").alias(BY_KEY))

    def kept_staged(self) -> DataFrame:
        """``dealt_staged`` written once per session in buckets of the order, for
        queries that read it several times: none of the reads shuffles it again."""
        if "kept_staged" not in self._feeds:
            self._feeds["kept_staged"] = written_by_order(self.dealt_staged(), "staged")
        return self._feeds["kept_staged"]

    def rejects_prev(self) -> DataFrame:
        """Rejects of the pass before: staged lines of even orders whose
        article is unknown, first rejected at a fixed time."""
        s = self.view("m_staged").filter(F.col("k") % 2 == 0)
        s = s.join(self.view("m_art").select("articleId"), "articleId", "left_anti")
        return self._stage_shape(s).withColumn("reject_insert", F.lit(REJECT_TIME))

    def fact_old(self) -> DataFrame:
        return self.view("m_fact_old")

    def kept_fact_old(self) -> DataFrame:
        """The fact before the run, from ``kept_staged`` and with its ``joins.ORDER``."""
        text = Template(VIEWS["m_fact_old"]).substitute(m_staged="{staged}").replace("SELECT ", f"SELECT s.k AS {BY_KEY}, ", 1)
        return self.spark.sql(text, staged=self.kept_staged().withColumn("k", F.col(BY_KEY)))


__all__ = ["Mapping", "VIEWS", "ORDER", "oracle_ctes"]
