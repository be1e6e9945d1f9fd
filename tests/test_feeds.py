"""Feeds built by one grouping, days compared as instants, employees counted after a DISTINCT by hash."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from conftest import rows
from linefold.functions.timewin import day_start, from_day
from linefold.operators import lines, people
from linefold.plans import mapping as M
from linefold.session import checkpoint_root


def nodes(df):
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        yield node
        todo += [node.children().apply(k) for k in range(node.children().size())]


def test_from_day_is_the_local_date_compared(spark):
    at = spark.range(0, 400_000).select(F.timestamp_seconds(F.lit(820_000_000) + F.col("id") * 600).cast("timestamp_ntz").alias("t"))
    local = F.to_date(F.convert_timezone(F.lit("UTC"), F.lit("Europe/Paris"), "t"))
    for day in (dt.date(1997, 1, 1), dt.date(1997, 3, 30), dt.date(1998, 10, 25)):
        assert at.filter(from_day("t", day) != (local >= F.lit(day))).count() == 0
    assert day_start(dt.date(1997, 7, 1)) == dt.datetime(1997, 6, 30, 22)
    assert spark.range(1).select(from_day(F.lit(None).cast("timestamp_ntz"), dt.date(1997, 1, 1))).first()[0] is None


def test_a_window_parses_the_creation_text_once(spark):
    df = spark.createDataFrame([], "text string, dana_ingestion_timestamp timestamp_ntz, ingest_date date")
    kept = df.filter(lines.feed_window(F.col("text"), lines.TS, dt.date(1997, 1, 1), dt.date(1995, 6, 20)))
    raw = df.filter(people._window_raw(F.col("text"), dt.date(1997, 1, 1), dt.date(1995, 6, 20)))
    for x in (kept, raw):
        plan = x._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lower().count("gettimestamp(") == 1, plan


def test_versions_of_orders_that_come_twice_and_lines_without_a_day(spark):
    d1, d2 = dt.datetime(2000, 1, 1), dt.datetime(2000, 1, 5)
    orders = [(4, 1, "O", 10.0, d1, "p"), (4, 2, "O", 11.0, d2, "p"), (8, 1, "F", 12.0, d1, "p"), (8, 1, "F", 12.0, d1, "p"), (12, 1, "O", 1.0, d1, "p"), (16, 1, "O", 1.0, None, "p")]
    item = [(4, 7, 3, 1, d2), (4, 7, 2, 2, d2), (4, 8, 1, 3, None), (8, 9, 5, 1, None), (8, 9, 6, 2, d1), (16, 5, 5, 1, None), (16, 5, 4, 2, d1)]
    path = f"{checkpoint_root(spark).rstrip('/')}/twice-{uuid.uuid4().hex}"
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(k, p, s, n, 1.0, 2.0, 0.0, 0.0, "N", "O", t) for k, p, s, n, t in item],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                          "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{path}/lineitem.parquet")
    m = M.Mapping(spark, path)
    v = m._versions(0, lambda x: F.struct(x["orderlineid"].alias("id")))
    want = m.view("m_ver").join(m.view("m_heads").select(F.col("k")), "k")
    cols = ["k", "ts", "vs", "vl", "vst", "nlines", "employee_raw"]
    assert rows(v, *cols) == rows(want, *cols) and v.count() == 9
    got = {(r["k"], r["ts"]): [x["id"] for x in r["items"]] for r in v.collect()}
    assert got == {(4, d1): [], (4, d2): ["4-1", "4-2"], (8, d1): ["8-2"], (12, d1): [], (16, None): [], (16, d1): ["16-2"]}
    # one grouping of the lines, partial and final
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, x in conf.items():
            spark.conf.set(k, x)
        names = [n.nodeName() for n in nodes(m._versions(0, lambda x: F.struct(x["orderlineid"].alias("id"))))]
    finally:
        for k, x in before.items():
            spark.conf.set(k, x)
    assert sum("Aggregate" in n for n in names) == 2, names


def test_employees_are_told_apart_without_a_sort(spark):
    feed = "struct<employeeId:string,creationTime:string>"
    some = [("9-1", "1", ("e1", "2000-01-01T10:00:00.000Z"), "e2", "2000-01-01T10:00:00.000Z"), ("9-1", "1", ("e1", "2000-01-01T10:00:00.000Z"), "", "2000-01-01T10:00:00.000Z"),
            (None, "2", (None, "2000-01-01T10:00:00.000Z"), "e3", "2000-01-01T10:00:00.000Z")]
    df = spark.createDataFrame(some, f"ordernumber string, combiOrderId string, orderContext {feed}, employeeId string, creationTime string")
    counts = people.employee_counts(df, df, df, df, None, None, None)
    got = sorted(map(str, (tuple(r) for r in counts.select("kind", "key", "count_emp", "employee_id").collect())))
    assert got == sorted(map(str, [("order", "9-1", 3, "e2"), ("order", None, 1, "e3"), ("combi", "1", 3, "e2"), ("combi", "2", 1, "e3")]))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        names = [n.nodeName() for n in nodes(people.employee_counts(df, df, df, df, None, None, None))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert names.count("HashAggregate") == 2 and names.count("SortAggregate") == 2, names
