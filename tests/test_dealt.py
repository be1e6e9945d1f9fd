"""Lines dealt by order once, lookups that come to them (joins.dealt_by_order, join_narrow)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from linefold.operators import fact, stage
from linefold.operators.joins import ORDER, dealt_by_order, join_narrow, written_by_order
from linefold.operators.lines import LINE_COLUMNS, LINE_TYPES

DAY = dt.date(2000, 1, 1)


def rows(df):
    return sorted(map(str, df.collect()))


def test_join_narrow_is_the_plain_left_join(spark):
    some = [("9-1", "a1", 1, "e1", 1), ("9-1", "a1", 1, "e1", 1), ("9-1", "a2", 2, None, 1), (None, "a3", 3, "e1", 1), (None, "a3", 4, "e2", 2),
            ("9-2", None, None, "e2", 2), ("9-3", "a1", 1, "none", 1), ("9-3", "a1", 1, "e1", None)]
    lines = spark.createDataFrame(some, "ordernumber string, articleid string, positionNumber long, employee string, day int")
    known = spark.createDataFrame([("e1", 1, 10), ("e1", 1, 11), ("e2", 2, 20), (None, 1, 30), ("e1", None, 40)], "upn string, at int, store int")
    got = join_narrow(dealt_by_order(lines), lines, known, {"employee": "upn", "day": "at"})
    want = lines.join(known, (F.col("employee") == F.col("upn")) & (F.col("day") == F.col("at")), "left")
    assert rows(got.select(want.columns)) == rows(want)


def staged(spark, lines):
    """Staged lines of (combi, order, article, employee)."""
    fixed = {"order_date": DAY, "order_month": 200001, "fulfillmenttype": "WEBSHOP", "fulfillingstoreid": 113,
             "customerHomeStoreNumber": 5, "customernumber": 7, "positionNumber": 1, "order_quantity": 1.0}
    names = dict(zip(("combiordernumber", "ordernumber", "articleid", "affected_employee"), range(4)))
    return spark.createDataFrame([tuple(x[names[c]] if c in names else fixed.get(c) for c in stage.STAGE_COLUMNS) for x in lines], stage.stage_schema())


def results(spark, lines, promo=True):
    guarantees = spark.createDataFrame([(DAY, "c1", "9-1", 3.0), (DAY, "c1", "9-1", 4.0), (DAY, None, "9-2", 5.0), (dt.date(1999, 1, 1), "c1", "9-1", 9.0)],
                                       "order_date date, combiordernumber string, ordernumber string, order_qty_guarantee double")
    art = spark.createDataFrame([("a1", 1, 101), ("a2", 2, 102)], "articleId string, combinedarticleid long, pk_article long")
    pref = spark.createDataFrame([(5, 7, 200001, 50), (5, 7, 200001, 50), (5, 7, 200001, 51)], "home_store_id long, cust_no long, month_id long, store_id long")
    emp = spark.createDataFrame([("e1", DAY, "STORE", 60)], "userprincipalname string, date_of_day date, service string, id_store long")
    shop = spark.createDataFrame([("s", 1)], "merchantname string, shopid long")
    promos = spark.createDataFrame([(DAY, "a1", 113, 77)], "date_of_day date, articleId string, store_id long, prom_id long")
    old = spark.createDataFrame([(DAY, "9-4", "a1", 1), (DAY, "9-4", "a1", 1), (DAY, None, "a1", 1)],
                                "order_date date, ordernumber string, articleid string, type_cmd long")
    return fact.build_results(staged(spark, lines), guarantees, art, pref, emp, promos if promo else None, F.broadcast(shop), old, None)


LINES = [("c1", "9-1", "a1", "e1"), ("c1", "9-1", "a1", "e1"), ("c1", "9-1", "a2", None), (None, "9-2", "a1", None), ("c1", None, "a1", "e1"),
         ("c4", "9-4", "a1", None), ("c5", "9-5", "a9", None), ("c6", "9-6", "a1", "e9")]


def test_results_multiply_as_the_lookups_do(spark):
    got = results(spark, LINES).groupBy("ordernumber", "articleId", "store_emp", "prom_id", "order_qty_guarantee", "store_pref").count()
    # 9-1: two guarantee rows of its day and two preferred stores; 9-4 is old, 9-5 has no article, 9-6 no employee
    want = ([("9-1", "a1", 60, 77, q, s, 2) for q in (3.0, 4.0) for s in (50, 51)] + [("9-1", "a2", None, None, q, s, 1) for q in (3.0, 4.0) for s in (50, 51)]
            + [("9-2", "a1", None, 77, None, s, 1) for s in (50, 51)] + [(None, "a1", 60, 77, None, s, 1) for s in (50, 51)])
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
    without = results(spark, LINES, promo=False)
    assert without.count() == results(spark, LINES).count() and without.filter("prom_id is not null").count() == 0


def test_wide_lines_are_dealt_once(spark):
    """One exchange of lines with their comments, whatever the lookups."""
    conf = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "15000", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = results(spark, LINES)._jdf.queryExecution().executedPlan()
        wide, joins, todo = 0, 0, [plan]
        while todo:
            node = todo.pop()
            wide += node.nodeName() == "Exchange" and "orderComments" in node.output().mkString(",")
            joins += node.nodeName() == "SortMergeJoin" and "orderComments" in node.output().mkString(",")
            todo += [node.children().apply(k) for k in range(node.children().size())]
        assert joins >= 3 and wide == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_enriched_lines_are_regrouped_where_the_order_join_leaves_them(spark):
    some = [("k1", "9-1", "a1", ""), ("k1", "9-1", "a1", ""), ("k2", "9-1", "a1", "m1"), ("k1", None, "a1", None), ("k2", None, "a1", None),
            (None, None, "a1", None), (None, "9-2", None, "m1")]
    at = dt.datetime(2000, 1, 1, 10, 0)
    fixed = {"combiordernumber": "c1", "orderComments": "x", "creationtime": at, "positionNumber": 1, "order_quantity": 1.0, "sumNet": 2.0}
    names = dict(zip(("combiorderid", "ordernumber", "articleId", "orderlineid"), range(4)))
    types = ", ".join(f"{c} {LINE_TYPES.get(c, 'string')}" for c in LINE_COLUMNS)
    lines = spark.createDataFrame([tuple(x[names[c]] if c in names else fixed.get(c) for c in LINE_COLUMNS) for x in some], types)
    per_combi = spark.createDataFrame([("k1", 1, "e1"), (None, 9, "e9")], "combiorderid string, count_emp long, employee_id string")
    per_order = spark.createDataFrame([("9-1", 1, "e1"), (None, 1, "e9")], "ordernumber string, count_emp long, employee_id string")
    basket = spark.createDataFrame([("k2", "a1", "u@x")], "combiorderid string, bundleId string, userid string")
    mkp = spark.createDataFrame([("m1", 5), ("m1", 6)], "OrderLineId string, Shopid long")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = stage.enrich_lines(lines, lines.filter("1 = 0"), per_combi, per_order, basket, mkp)
        wide, todo = 0, [df._jdf.queryExecution().executedPlan()]
        while todo:
            node = todo.pop()
            wide += node.nodeName() == "Exchange" and "orderComments" in node.output().mkString(",")
            todo += [node.children().apply(k) for k in range(node.children().size())]
        got = sorted(map(str, (tuple(r) for r in df.select("ordernumber", "articleid", "added_to_basket_employee", "affected_employee", "shopid", "order_quantity").collect())))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert wide == 4  # for the four lookups, none to regroup
    want = [("9-1", "a1", None, "e1", None, 2.0), ("9-1", "a1", "u@x", "u@x", 5, 1.0), ("9-1", "a1", "u@x", "u@x", 6, 1.0),
            (None, "a1", None, None, None, 2.0), (None, "a1", "u@x", "u@x", None, 1.0), ("9-2", None, None, None, 5, 1.0), ("9-2", None, None, None, 6, 1.0)]
    assert got == sorted(map(str, want))


def test_enriched_lines_are_dealt_once_for_all_lookups(spark):
    """Written in buckets of the order, the lines go to no lookup; by the plain way two lookups of one key share a shuffle."""
    some = [("k1", "9-1", "a1", "", "c1"), ("k1", "9-1", "a1", "", "c1"), ("k2", "9-1", "a1", "m1", "c1"), ("k1", None, "a1", None, "c1"), ("k2", None, "a1", None, "c2"),
            (None, None, "a1", None, None), (None, None, "a1", "", None), (None, "9-2", None, "m1", "c1")]
    fixed = {"orderComments": "x", "creationtime": dt.datetime(2000, 1, 1, 10, 0), "order_quantity": 1.0, "sumNet": 2.0}
    names = dict(zip(("combiorderid", "ordernumber", "articleId", "orderlineid", "combiordernumber"), range(5)))
    types = ", ".join(f"{c} {LINE_TYPES.get(c, 'string')}" for c in LINE_COLUMNS)
    lines = spark.createDataFrame([tuple(x[names[c]] if c in names else n if c == "positionNumber" else fixed.get(c) for c in LINE_COLUMNS)
                                   for n, x in enumerate(some)], types)
    lookups = (spark.createDataFrame([("k1", 1, "e1"), (None, 9, "e9")], "combiorderid string, count_emp long, employee_id string"),
               spark.createDataFrame([("9-1", 1, "e1"), (None, 1, "e9")], "ordernumber string, count_emp long, employee_id string"),
               spark.createDataFrame([("k2", "a1", "u@x"), (None, "a1", "v@x")], "combiorderid string, bundleId string, userid string"),
               spark.createDataFrame([("m1", 5), ("m1", 6), ("", 7)], "OrderLineId string, Shopid long"))
    conf = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        none = lines.filter("1 = 0")
        plain, dealt = stage.enrich_lines(lines, none, *lookups), stage.enrich_lines(stage._dealt_lines(lines, none), None, *lookups)
        wide = []
        for df in (plain, dealt):
            wide.append(0)
            todo = [df._jdf.queryExecution().executedPlan()]
            while todo:
                node = todo.pop()
                wide[-1] += node.nodeName() == "Exchange" and "orderComments" in node.output().mkString(",")
                todo += [node.children().apply(k) for k in range(node.children().size())]
        assert wide == [3, 0]
        assert rows(dealt) == rows(plain) and dealt.count() == 9
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def loaded(spark, lines, named=False):
    """``fact.load_fact`` of ``lines``, whose orders are named by ``joins.ORDER`` or not."""
    def known(df, order="ordernumber"):
        return df.withColumn(ORDER, F.xxhash64(order)) if named else df

    art = spark.createDataFrame([("a1", 1, 101, 7), ("a2", 2, 102, 156701)], "articleId string, combinedarticleid long, pk_article long, articleNumber long")
    pref = spark.createDataFrame([(5, 7, 200001, 50)], "home_store_id long, cust_no long, month_id long, store_id long")
    emp = spark.createDataFrame([("e1", DAY, "STORE", 60)], "userprincipalname string, date_of_day date, service string, id_store long")
    shop = spark.createDataFrame([("s", 1)], "merchantname string, shopid long")
    promos = spark.createDataFrame([(DAY, "a1", 113, 77)], "date_of_day date, articleId string, store_id long, prom_id long")
    old = spark.createDataFrame([(DAY, "9-4", "a1", "WEBSHOP", "2000-01-02", "e4", 1.0, 101, 1), (DAY, "9-7", "a1", "WEBSHOP", "2000-01-05", "e7", 1.0, 101, 1),
                                 (DAY, "9-7", "a3", "WEBSHOP", "2000-01-03", "e7", 2.0, 101, 1), (DAY, None, "a1", "WEBSHOP", "2000-01-02", "e7", 2.0, 101, 1)],
                                "order_date date, ordernumber string, articleid string, fulfillmenttype string, deliverydate string, affected_employee string, "
                                "order_quantity double, pk_article long, type_cmd long")
    return fact.load_fact(known(staged(spark, lines)), known(old), art, pref, emp, promos, F.broadcast(shop), dt.datetime(2000, 1, 3), None, None)


BACK = LINES + [("c7", "9-7-1", "a1", "e1"), ("c7", "9-7-1", "a2", None)]


def test_fact_rows_are_the_same_however_orders_are_named(spark):
    got = loaded(spark, BACK, named=True)
    assert rows(got) == rows(loaded(spark, BACK)) and "9-4" not in [r["ordernumber"] for r in got.select("ordernumber").collect()]
    # two originals with the article of the first line, none with that of the second
    back = got.filter("ordernumber = '9-7-1'").select("articleId", "ordernumber_orig", "deliverydate_orig", "affected_employee", "type_reliquat")
    assert back.count() == 3
    assert [tuple(r) for r in back.filter("articleId = 'a2'").collect()] == [("a2", "9-7", "2000-01-03", None, "Ajout")]


def test_results_are_shuffled_no_more(spark):
    """The results stay dealt by order when they are read again: D43 joins to them where they are."""
    conf = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        wide, joins, todo = 0, 0, [loaded(spark, BACK)._jdf.queryExecution().executedPlan()]
        while todo:
            node = todo.pop()
            wide += node.nodeName() == "Exchange" and "orderComments" in node.output().mkString(",")
            joins += node.nodeName() == "SortMergeJoin" and "orderComments" in node.output().mkString(",")
            todo += [node.children().apply(k) for k in range(node.children().size())]
        assert joins == 4 and wide == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_table_in_buckets_leaves_nothing_in_the_catalog(spark):
    lines = dealt_by_order(staged(spark, LINES))
    got = written_by_order(lines, "lines")
    assert rows(got) == rows(lines) and not [t for t in spark.catalog.listTables() if t.name.startswith("linefold_lines")]
