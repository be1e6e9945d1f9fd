
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from linefold.operators import fact, guarantee, lines, people, rejects, stage, versions

T0 = dt.datetime(2021, 6, 1, 8, 0)
T1 = dt.datetime(2021, 6, 1, 9, 0)


def test_first_version_keeps_ties_and_drops_null_keys(spark):
    # D01, traps 1-3
    df = spark.createDataFrame([
        ("c1", "o1", T0, 1), ("c1", "o1", T0, 2), ("c1", "o1", T1, 3),
        (None, "o2", T0, 4), ("c3", None, T0, 5), ("c4", "o4", None, 6), ("c4", "o4", T1, 7),
    ], "c string, o string, ts timestamp_ntz, id int")
    got = rows(versions.first_version(df, ["c", "o"], "ts"), "id")
    assert got == [(1,), (2,), (7,)]


def test_latest_version_distinct(spark):
    # D02
    df = spark.createDataFrame([("o", "l", T0, 1.0), ("o", "l", T1, 2.0), ("o", "l", T1, 2.0), ("o", "l", T1, 3.0)],
                               "o string, l string, ts timestamp_ntz, fee double")
    assert rows(versions.latest_version(df, ["o", "l"], "ts"), "fee") == [(2.0,), (3.0,)]


def test_top_by_priority_ties_copies(spark):
    # D03, trap 1: exact copy goes, the other tie stays (summed later)
    df = spark.createDataFrame([("o", "a", 7, 1.0), ("o", "a", 7, 1.0), ("o", "a", 7, 2.0), ("o", "a", 2, 9.0)],
                               "o string, a string, p int, q double")
    got = versions.top_by_priority(df, ["o", "a"], [F.col("p").desc()])
    assert rows(got, "q") == [(1.0,), (2.0,)]


def test_lowest_revision_null_safe_key(spark):
    # D04, trap 3: null combi equals '' in the join back
    df = spark.createDataFrame([
        ("o", None, "S", 1, 1, T0, "a"), ("o", "", "S", 1, 1, T0, "b"), ("o", None, "S", 1, 2, T0, "c"),
    ], "o string, c string, st string, store int, rev int, ts timestamp_ntz, id string")
    got = versions.lowest_revision(df, ["c", "o"], [F.col("rev").asc(), F.col("ts").asc()],
                                   match=["o", "c", "st", "store", "rev", "ts"], null_safe=["c"])
    # rank-1 rows: a (partition null) and b (partition ''): each matches both a and b
    assert rows(got, "id") == [("a",), ("a",), ("b",), ("b",)]


ITEM = "struct<articleId:string,quantity:double,positionNumber:string>"


def test_explode_lines_keeps_empty_parents(spark):
    # Items null, [], one, three
    df = spark.createDataFrame([
        ("n", None), ("e", []), ("1", [("a", 1.0, None)]),
        ("3", [("a", 1.0, "7"), ("b", 2.0, None), ("c", 3.0, "9")]),
    ], f"o string, items array<{ITEM}>")
    x = lines.explode_lines(df, pos="pos")
    got = rows(x.select("o", F.col("item.articleId").alias("a"),
                        lines.line_position("item.positionNumber", "pos").alias("p")), "o", "a", "p")
    assert got == [("1", "a", 1), ("3", "a", 7), ("3", "b", 2), ("3", "c", 9), ("e", None, None), ("n", None, None)]


def test_spread_total_guards(spark):
    # D07, trap 14: s = 0, s null, fee article, after cutoff, normal
    schema = "ordernumber string, articleId string, sumNet double, sumNetInclTaxesAndFees double, " \
             "dana_ingestion_timestamp_min timestamp_ntz"
    e = dt.datetime(2018, 1, 1)
    ls = spark.createDataFrame([
        ("z", "a", 10.0, 30.0, e), ("n", "a", 10.0, 30.0, e), ("o", "DUMMY-FRAIS_LIV", 10.0, 30.0, e),
        ("o", "a", 10.0, 30.0, dt.datetime(2020, 1, 1)), ("o", "b", 10.0, 30.0, e), ("o", "c", 15.0, 30.0, e),
    ], schema)
    tot = spark.createDataFrame([("z", 0.0), ("o", 25.0)], "ordernumber string, sum_order_article_net_price double")
    got = rows(lines.spread_total(ls, tot, cutoff=dt.datetime(2019, 5, 14, 9)), "ordernumber", "articleId", "sumNet")
    assert got == [("n", "a", 10.0), ("o", "DUMMY-FRAIS_LIV", 10.0), ("o", "a", 10.0), ("o", "b", 12.0),
                   ("o", "c", 18.0), ("z", "a", 10.0)]


def test_rollup_lines(spark):
    # D06
    df = spark.createDataFrame([("o", "a", 1, 1.005, 0.1), ("o", "a", 3, 1.0, 0.2)],
                               "o string, a string, p int, q double, n double")
    got = lines.rollup_lines(df, ["o", "a"], "p", "q", "n").first()
    assert (got["p"], got["q"], got["n"]) == (3, 2.01, 0.3)


def _classic_feed(spark, rows_):
    schema = """combiorderid string, combiordernumber string, ordernumber string, fulfillmenttype string,
      fulfillingstoreid string, customerhomestorenumber string, customernumber string, cardholdernumber string,
      orderContext struct<origin:struct<id:string>, employeeId:string, creationTime:string>,
      creationtime string,
      deliveryinformation struct<deliveryDate:string, deliveryType:string, pickupStoreid:string>,
      pricesummary struct<sumNetInclTaxesAndFees:double, sumNetInclTaxesFeesEmpties:double, sumDeliveryFees:double>,
      paymentData struct<paymentType:string>, orderComments string, orderstatus string, invoicestatus string,
      dana_ingestion_timestamp timestamp_ntz, ingest_date date,
      items array<struct<articleId:string, quantity:double, positionNumber:string,
                         priceData:struct<sumNet:double, sumnetdouble:double>,
                         articledata:struct<serviceoptions:array<struct<id:string>>>>>"""
    return spark.createDataFrame(rows_, schema)


def _web_row(on, ts, fees, items, status="DELIVERED", pay="CARD", empties=None, total=100.0):
    return ("1", on, on, "WEBSHOP", "113", "7", "42", "420", (("app",), "e@x", "2021-06-01T08:00:00.000Z"),
            None, ("2021-06-03", "HOME", "5"), (total, empties if empties is not None else total, fees),
            (pay,), None, status, "SENT", ts, ts.date(), items)


def test_delivery_fee_lines(spark):
    # Fee 0 and no empties gap -> no line; 4.90 -> one line, first version, payment desc on ties
    web = _classic_feed(spark, [
        _web_row("9-1", T0, 0.0, []),
        _web_row("9-2", T0, 4.9, [], pay="CARD"), _web_row("9-2", T0, 4.9, [], pay="VISA"),
        _web_row("9-2", T1, 5.9, []),
        _web_row("9-3", T0, 0.0, [], empties=103.0),
    ])
    drop = web.limit(0)
    mkt_schema = """combiorderid string, combiordernumber string, ordernumber string, fulfillmenttype string,
      fulfillingstoreid string, customerhomestorenumber string, customernumber string, cardholdernumber string,
      orderContext struct<id:string, employeeId:string, creationTime:string>, creationtime string,
      delivery struct<Date:string, Type:string>, pickup struct<storeid:string, StoreName:string>,
      payment struct<Type:string>, priceSummary struct<sumDeliveryFees:double>, merchantname string,
      dana_ingestion_timestamp timestamp_ntz, ingest_date date"""
    mkt = spark.createDataFrame([], mkt_schema)
    got = lines.delivery_fee_lines(web, drop, mkt, since=None, fee_cutoff=dt.datetime(2019, 10, 1))
    assert rows(got, "ordernumber", "paymentType_OM", "sumNet", "order_quantity") == [
        ("9-2", "VISA", 4.9, 1.0), ("9-3", "CARD", 0.0, 1.0)]


def test_options_per_article(spark):
    # Null option id becomes '', sorted array; order without items has one [''] entry
    web = _classic_feed(spark, [
        _web_row("9-1", T0, 0.0, [("a", 1.0, "1", (1.0, 1.0), ([("x",), (None,), ("b",)],)),
                                  ("c", 1.0, "2", (1.0, 1.0), ([],))]),
        _web_row("9-2", T0, 0.0, []),
    ])
    got = lines.options_per_article(web, web.limit(0))
    assert rows(got, "ordernumber", "articleId", "id_options") == [
        ("9-1", "a", ["", "b", "x"]), ("9-1", "c", [""]), ("9-2", None, [""])]


def test_webshop_lines_first_version_rank_and_sum(spark):
    # D08 webshop path: first version only; rank-1 ties summed; spread applied
    items_v1 = [("a", 1.0, "1", (10.0, 10.0), ([],)), ("a", 2.0, "2", (10.0, 10.0), ([],))]
    items_v2 = [("a", 9.0, "1", (99.0, 99.0), ([],))]
    web = _classic_feed(spark, [_web_row("9-1", T0, 0.0, items_v1, total=30.0),
                                _web_row("9-1", T1, 0.0, items_v2, total=30.0)])
    price = spark.createDataFrame([("9-1", 20.0)], "ordernumber string, sum_order_article_net_price double")
    got = lines.webshop_lines(web, price, since=None, min_date=None, net_cutoff=None).first()
    # 10 + (30 - 20) * 0.5 = 15 per line, two tied lines summed
    assert (got["articleId"], got["order_quantity"], got["sumNet"], got["positionNumber"]) == ("a", 3.0, 30.0, 2)
    assert got["creationtime"] == dt.datetime(2021, 6, 1, 10, 0)


def _events(spark, data, commission):
    if commission:
        return spark.createDataFrame(data, "tags string, eventtype string, dana_ingestion_timestamp timestamp_ntz, "
                                           "ingest_date date")
    return spark.createDataFrame(data, "tags string, parsedtags struct<orderId:string,bundleid:string>, "
                                       "eventtype string, dana_ingestion_timestamp timestamp_ntz, ingest_date date")


def test_basket_employee_json_cases(spark):
    # D11, trap 7: text id, number id, missing key, not JSON; smallest user wins
    ev = "order-submit-employee-commissions.quantity"
    s = _events(spark, [
        ('{"orderId": "o1", "bundleId": 5, "userId": "b@x"}', None, ev, T0, T0.date()),
        ('{"orderId": "o1", "bundleId": 5, "userId": "a@x"}', None, ev, T0, T0.date()),
        ('{"bundleId": 5, "userId": "c@x"}', None, ev, T0, T0.date()),
        ("not json", None, ev, T0, T0.date()),
        ('{"orderId": "o2", "bundleId": "7", "userId": "no-at"}', None, ev, T0, T0.date()),
    ], False)
    c = _events(spark, [('{"orderId": 12, "bundleId": "9", "userId": "d@x"}', ev, T0, T0.date())], True)
    got = people.basket_employee(s, c, since=None, order_cutoff=dt.datetime(2022, 1, 1),
                                 bundle_cutoff=dt.datetime(2022, 1, 1))
    assert rows(got) == [("12", "9", "d@x"), ("o1", "5", "a@x")]


def test_reject_reasons_and_neither(spark):
    # D20, D21, trap 4: first reason wins; null type without shop is in neither
    staged = spark.createDataFrame([
        ("A1", dt.date(2021, 1, 1), "e@x", "WEBSHOP", None, None, "g"),      # accepted
        ("ZZ", dt.date(2021, 1, 1), "nobody@x", "MKT", None, None, "g"),    # article first
        ("A1", dt.date(2021, 1, 1), "nobody@x", "MKT", None, None, "g"),    # employee
        ("A1", dt.date(2021, 1, 1), None, "MKT", "shopX", None, "g"),       # shop
        ("A1", dt.date(2021, 1, 1), None, None, "shopX", None, "g"),        # neither
    ], "articleid string, order_date date, affected_employee string, fulfillmenttype string, "
       "merchantname string, reject_insert string, gcp_insert string")
    for c in stage.STAGE_COLUMNS:
        if c not in staged.columns:
            staged = staged.withColumn(c, F.lit(None).cast(stage.STAGE_TYPES.get(c, "string")))
    art = spark.createDataFrame([("A1", 1, 2, 3)], "articleId string, combinedarticleid long, articleNumber long, "
                                                   "pk_article long")
    emp = spark.createDataFrame([("e@x", dt.date(2021, 1, 1), "STORE", 5)],
                                "userprincipalname string, date_of_day date, service string, id_store long")
    shop = spark.createDataFrame([(1, "shopY")], "shopid long, merchantname string")
    rej = rejects.reject_lines(staged, art, emp, shop, marketplace_type="MKT")
    assert sorted(r["comments"] for r in rej.collect()) == ["Missing article", "Missing employee", "Missing shopid"]
    assert all(r["reject_insert"] == "g" for r in rej.collect())
    acc = rejects.accept_lines(staged, art, emp, shop, marketplace_type="MKT")
    assert acc.count() == 1
    assert rejects.reject_lines(staged, art, emp, shop, "MKT", null_as_reject=True).count() == 4


def test_append_new_only_lookback(spark):
    # D22, trap 20: inside the look-back the line is a duplicate, outside it is appended again
    new = spark.createDataFrame([("9-1", "a"), ("9-2", "a"), ("9-3", "a")], "ordernumber string, articleid string")
    f = spark.createDataFrame([("9-1", "a", dt.date(2021, 6, 10), 1), ("9-2", "a", dt.date(2021, 1, 1), 1),
                               ("9-3", "a", dt.date(2021, 6, 10), 3)],
                              "ordernumber string, articleid string, order_date date, type_cmd long")
    got = fact.append_new_only(new, f, since=dt.date(2021, 6, 11))
    assert rows(got, "ordernumber") == [("9-2",), ("9-3",)]
    assert rows(fact.append_new_only(new, f, since=None), "ordernumber") == [("9-3",)]


def test_allocation_no_give_back(spark):
    # D36, trap 18: two articles, a refusal in the middle keeps later lines refused
    under = spark.createDataFrame([
        (dt.date(2021, 1, 1), "o", 10, 1, 3.0), (dt.date(2021, 1, 1), "o", 20, 1, 5.0),
        (dt.date(2021, 1, 1), "o", 30, 1, 1.0)],
        "order_date date, ordernumber string, pk_article long, id_option long, order_quantity double")
    ordered = spark.createDataFrame([("o", 1, 10.0)], "ordernumber string, combinedarticleid long, order_quantity double")
    tot = spark.createDataFrame([("o", 6.0)], "ordernumber string, qty_guar_tot double")
    got = guarantee.allocate_running(under, ordered, tot)
    assert rows(got, "pk_article", "qty_guarantee_adjusted_sold") == [(10, 3.0), (20, 0.0), (30, 0.0)]


def test_correction_skips_null_employee(spark):
    # D34, trap 23
    ordered = spark.createDataFrame([(dt.date(2021, 1, 1), "o", 1, 100, 1.0, None),
                                     (dt.date(2021, 1, 1), "p", 1, 100, 1.0, "g@x")],
                                    "order_date date, ordernumber string, combinedarticleid long, pk_article long, "
                                    "order_quantity double, affected_employee string")
    under = spark.createDataFrame([("o", 1, 5, "a@x"), ("p", 1, 5, "b@x"), ("p", 1, 5, "c@x"), ("p", 1, 6, "z@x")],
                                  "ordernumber string, id_option long, combinedarticleid long, affected_employee string")
    got = guarantee.correct_guarantee_employee(ordered, under)
    assert rows(got, "ordernumber", "affected_employee_corrected") == [("p", "c@x")]


def test_guarantee_sales_matches_window_definition(spark):
    # Null combi keys group together (null-safe join back)
    offered = spark.createDataFrame([
        (dt.date(2021, 1, 1), None, "o", "e1", "a", 1.0), (dt.date(2021, 1, 1), None, "o", "e1", "b", 2.0),
        (dt.date(2021, 1, 1), None, "o", "e2", "c", 1.0)],
        "order_date date, combiordernumber string, ordernumber string, affected_employee string, articleid string, "
        "order_quantity double")
    ordered = spark.createDataFrame([(dt.date(2021, 1, 1), None, "o", 4.0)],
                                    "order_date date, combiordernumber string, ordernumber string, "
                                    "order_qty_guarantee double")
    got = guarantee.guarantee_sales(offered, ordered)
    # the left join on a null combi finds nothing, as in the original
    assert rows(got, "articleid", "qty_order_tot", "count_order_line") == [("a", None, 2), ("b", None, 2),
                                                                           ("c", None, 1)]


def test_employee_history_by_name(spark):
    # D44, trap 19: rows of the window, written with the history's columns by name
    import uuid

    from linefold.operators import employees
    from linefold.session import checkpoint_root
    src = spark.createDataFrame([
        ("7", "e@x", dt.date(2021, 6, 1), "STORE", 12), ("8", "f@x", dt.date(2021, 5, 31), None, None)],
        "id string, userprincipalname string, date_of_day date, service string, id_store long")
    rows_ = employees.employee_history_rows(src.select("userprincipalname", "id_store", "id", "date_of_day",
                                                       "service"), dt.date(2021, 6, 1))
    assert rows_.columns == list(employees.HISTORY_COLUMNS)
    path = f"{checkpoint_root(spark)}/emp-{uuid.uuid4().hex}"
    employees.append_employee_history(src, path, dt.date(2021, 6, 1))
    employees.append_employee_history(src, path, dt.date(2021, 5, 1))
    back = spark.read.parquet(path)
    assert rows(back, "id", "date_of_day") == [("7", dt.date(2021, 6, 1)), ("8", dt.date(2021, 5, 31))]
    # the job: since midnight in Paris; a second run changes nothing
    as_of = dt.datetime(2021, 5, 31, 22, 30)
    for _ in range(2):
        assert employees.run_employees(src, path, as_of) == dt.date(2021, 6, 1)
    assert spark.read.parquet(path).count() == 2


def test_employee_counts_empty_rules_per_feed(spark):
    # D12, D13, trap 6: '' is "no employee" for FSD in the per-order count and for
    # marketplace in the per-combi count only; marketplace counts use its top-level field
    from linefold.operators import people
    web = _classic_feed(spark, [_web_row("9-1", T0, 0.0, [])]).limit(0)
    fsd = spark.createDataFrame([("9-1", "9-1", "c1", "", T0.date(), "2021-06-01T08:00:00.000Z")],
                                "ordernumber string, combiordernumber string, combiOrderId string, "
                                "employeeId string, ingest_date date, creationTime string")
    mkt = spark.createDataFrame([("c1", "9-1", (None, "ctx@x", "2021-06-01T08:00:00.000Z"), None, "", T0.date())],
                                "combiorderid string, ordernumber string, "
                                "orderContext struct<id:string, employeeId:string, creationTime:string>, "
                                "creationtime string, employeeId string, ingest_date date")
    per_order = people.employees_per_order(web, web, fsd, mkt, since=None, min_date=None)
    # FSD '' dropped, marketplace '' counted as a value
    assert rows(per_order) == [("9-1", 1, "")]
    basket = spark.createDataFrame([("c1", "5", "b@x")], "combiorderid string, bundleId string, userid string")
    per_combi = people.employees_per_combi(web, web, fsd, mkt, basket, since=None, min_date=None)
    # FSD '' counted, marketplace '' dropped, basket user added
    assert rows(per_combi) == [("c1", 2, "b@x")]


def test_joins_spread_null_and_hot_keys(spark):
    from linefold.operators.joins import join_hot_value, spread
    left = spark.createDataFrame([(i, k) for i, k in enumerate([None] * 40 + [""] * 40 + ["a", "b"])], "i long, k string")
    right = spark.createDataFrame([("", 1), ("a", 2), (None, 3)], "rk string, v int")
    got = join_hot_value(left, right, "k", "rk", "", ("i",))
    assert sorted((r["i"], r["v"]) for r in got.collect()) == [(i, None) for i in range(40)] + [(i, 1) for i in range(40, 80)] + [(80, 2), (81, None)]
    got = left.join(right, spread("k", ("i",)) == F.col("rk"), "left")
    assert got.filter("k is null and rk is null").count() == 40 and got.filter("k = 'a' and v = 2").count() == 1
    # null keys go to many partitions
    parts = left.filter("k is null").repartition(8, spread("k", ("i",))).select(F.spark_partition_id().alias("p")).distinct()
    assert parts.count() > 4


def test_retry_keeps_one_of_equal_null_key_rejects(spark):
    from linefold.operators import stage
    enriched = stage.empty_rejects(spark.range(1)).drop("id_options", "reject_insert")
    cols = [c for c in stage.STAGE_COLUMNS if c != "gcp_insert"]
    old = stage.stage_select(spark.createDataFrame([("9-1", None, "t2"), ("9-1", None, "t1"), ("9-2", "5", "t1")],
                                                   "ordernumber string, articleid string, reject_insert string")
                             .select("*", *[F.lit(None).cast(stage.STAGE_TYPES.get(c, "string")).alias(c) for c in cols
                                            if c not in ("ordernumber", "articleid", "reject_insert")]), cols)
    assert stage.retry_rejects(old, enriched, ()).count() == 3
    once = stage.retry_rejects(old, enriched, (), distinct_null_keys=True)
    assert rows(once, "ordernumber", "reject_insert") == [("9-1", "t1"), ("9-2", "t1")]


def test_lookups_must_be_unique_if_asked(spark):
    from linefold.sources.tables import assert_unique
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, v int")
    assert assert_unique(df, ("k",), "art") is df
    with pytest.raises(ValueError):
        assert_unique(df.union(df), ("k",), "art")


def test_compaction_of_closed_days(spark):
    import uuid

    from linefold.session import checkpoint_root
    from linefold.sources import tables
    path = f"{checkpoint_root(spark)}/compact-{uuid.uuid4().hex}"
    day = [dt.date(2021, 6, d) for d in (1, 2)]
    for run in ("r1", "12", "13"):
        df = spark.createDataFrame([(day[0], run), (day[1], run)], "order_date date, x string")
        tables.append_run(df, path, ("order_date", "x"), run)
    schema = "order_date date, x string, load_run string"
    before = rows(spark.read.schema(schema).parquet(path), "order_date", "x")
    assert tables.compact(spark, path, schema, ("order_date", "x"), day[1]) == 3
    back = spark.read.schema(schema).parquet(path)
    assert rows(back, "order_date", "x") == before
    assert rows(back.select("order_date", "load_run").distinct()) == [
        (day[0], "compacted"), (day[1], "12"), (day[1], "13"), (day[1], "r1")]
    assert tables.compact(spark, path, schema, ("order_date", "x"), day[1]) == 0
