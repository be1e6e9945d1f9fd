"""Mapping M on the Spark side: columns and shuffles only as far as they are used."""

import datetime as dt
import os

from pyspark.sql import functions as F

from linefold.operators import guarantee, rejects
from linefold.operators.joins import few_keys, of_keys
from linefold.plans import mapping as M
from linefold.plans import proofs as P
from linefold.session import bound_tasks, size_shuffles

DAY = [dt.datetime(1998, 5, d, 0, 0) for d in range(1, 6)]


def _tables(spark, root, orders, lines):
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{root}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                          "l_shipdate timestamp_ntz").write.parquet(f"{root}/lineitem.parquet")
    return M.Mapping(spark, str(root))


def _order(k, day=0):
    return (k, 7, "F", 10.0, DAY[day], "1-URGENT")


def _line(k, n, day, part=5, supp=3):
    return (k, part, supp, n, 1.0, 2.0, 0.0, 0.0, "N", "F", None if day is None else DAY[day])


def _odd(spark, tmp_path):
    """Orders twice, without key, without lines; lines without a day and without an order."""
    orders = [_order(4), _order(4), _order(8), _order(12, 1), _order(12, 2), _order(16), _order(None)]
    lines = [_line(4, 2, 1), _line(4, 1, 1), _line(4, 3, 2), _line(12, 1, None), _line(12, 2, 1), _line(16, 1, None),
             _line(None, 1, 1), _line(20, 1, 1)]
    return _tables(spark, tmp_path / "odd", orders, lines)


def test_feed_has_the_versions_of_the_view(spark, tmp_path):
    m = _odd(spark, tmp_path)
    # the rows of m_ver with the lines of their day, joined plainly
    ver = m.view("m_ver").join(m.view("m_heads"), "k").filter("feed = 0")
    want = sorted((r.ordernumber, str(r.ts), r.employee, r.payment, r.invoicestatus) for r in ver.collect())
    feed = m.feed("webshop")
    got = feed.select("ordernumber", F.col("dana_ingestion_timestamp").alias("ts"), F.col("orderContext.employeeId").alias("employee"),
                      F.col("paymentData.paymentType").alias("payment"), "invoicestatus").collect()
    assert sorted((r.ordernumber, str(r.ts), r.employee, r.payment, r.invoicestatus) for r in got) == want
    items = {(r.ordernumber, str(r.ts)[:10]): [x.positionNumber for x in r["items"]]
             for r in feed.select("ordernumber", F.col("dana_ingestion_timestamp").alias("ts"), "items").collect()}
    assert items[("9-4", "1998-05-02")] == ["1", "2"] and items[("9-4", "1998-05-03")] == ["3"]
    assert items[("9-8", "1998-05-01")] == []
    assert items[("9-12", "1998-05-02")] == ["2"] and items[("9-16", "1998-05-01")] == []
    m2 = _tables(spark, tmp_path / "fsd", [_order(3), _order(3)], [_line(3, 1, 1), _line(3, 2, 1)])
    assert {r.revision for r in m2.feed("fsd").collect()} == {r.nlines for r in m2.view("m_ver").collect()} == {4}


def test_feed_deals_the_lines_once_and_reads_the_given_tables(spark, tmp_path):
    m = _odd(spark, tmp_path)
    assert all("/odd/" in f for f in m.feed("webshop").inputFiles())
    plan = m.feed("webshop")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
    assert plan.count("Exchange hashpartitioning") <= 3  # lines, orders, and the orders' keys


def test_views_shuffle_only_the_columns_used(spark):
    df = P.mapping(spark, "/root/testdata/sf0.001").feed("staged").select("ordernumber", "order_quantity")
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan" in x]
    assert len(scans) == 2 and not any("l_suppkey" in x or "o_custkey" in x for x in scans)


def test_shuffles_grow_with_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        path = "/root/testdata/sf0.001/lineitem.parquet"
        size = os.path.getsize(path)
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        assert size_shuffles(spark, [path], bytes_each=-(-size // 9)) == 9
        assert size_shuffles(spark, [path, "/nowhere/x.parquet"]) == 9  # a larger setting stays
        assert spark.conf.get("spark.sql.shuffle.partitions") == "9"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_lookup_is_cut_to_the_keys_of_the_lines(spark):
    lines = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "articleid string")
    lookup = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "articleId string, v int")
    keys = few_keys(lines, "articleid")
    assert sorted(r[0] for r in keys.collect()) == ["a", "c"]
    assert sorted(r.v for r in of_keys(lookup, "articleId", keys).collect()) == [1, 2]
    assert few_keys(lines, "articleid", most=1) is None
    assert of_keys(lookup, "articleId", None).count() == 4


def test_article_lookups_do_not_shuffle_the_lines(spark):
    m = P.mapping(spark, "/root/testdata/sf0.001")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # a dimension too large to be broadcast whole
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")
    try:
        art, emp, shop = P._dims(m)
        j = rejects.lookup_joins(m.staged(), art, emp, shop)
        plan = j._jdf.queryExecution().executedPlan().toString()
        join = [x for x in plan.splitlines() if "Join" in x and "__art" in x]
        assert join and all("BroadcastHashJoin" in x for x in join)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_guarantee_block_reads_only_its_columns(spark):
    r = P._gblock(P.mapping(spark, "/root/testdata/sf0.001"))[0]
    assert set(r.columns) == set(P._G_READS)
    plan = r._jdf.queryExecution().optimizedPlan().toString()
    assert "ordercomments" not in plan.lower() and "paymentType" not in plan


def test_lines_are_collected_without_their_texts(spark, tmp_path):
    orders = [_order(k) for k in (4, 5, 6, 7)]
    lines = [_line(k, n, 1, part=10 + n, supp=n) for k in (4, 5, 6, 7) for n in range(1, 8)]
    lines += [(7, None, None, None, None, None, None, None, None, None, DAY[1])]
    m = _tables(spark, tmp_path / "narrow", orders, lines)
    view = {(r.k, r.l_linenumber): r for r in m.view("m_lines").collect()}
    for name, k in (("webshop", 4), ("dropship", 5), ("marketplace", 6), ("fsd", 7)):
        feed = m.feed(name)
        plan = feed._jdf.queryExecution().optimizedPlan().toString()
        collected = [x for x in plan.splitlines() if "collect_list" in x]
        assert collected and not any(c in x.split("collect_list")[1] for x in collected for c in ("orderlineid", "position_text", "opt1"))
        numbers = sorted((n for o, n in view if o == k), key=lambda n: (n is not None, n))
        for n, x in zip(numbers, feed.select("items").first()[0], strict=True):
            r = view[(k, n)]
            assert (x.articleId, x.quantity) == (r.articleid, r.l_quantity)
            assert x.positionNumber == (r.position_num if name == "fsd" else r.position_text)
            if name == "fsd":
                assert (x.replacedItemNumber, x.priceData.netPrice.sumPrice.amount) == (r.replaced, r.amount_text)
            elif name == "marketplace":
                assert (x.sumNet, x.orderlineid, x.miraklOrderLineStatus) == (r.l_extendedprice, r.orderlineid, r.line_status)
            else:
                assert tuple(x.priceData) == (r.l_extendedprice, r.net_double)
                assert [o.id for o in x.articledata.serviceoptions] == [r.opt1, r.opt2][:r.n_opts]


def test_tasks_are_bounded_by_bytes(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "64MB")
        assert bound_tasks(spark) == 16 << 20
        assert bound_tasks(spark, 1 << 20) == bound_tasks(spark) == 1 << 20  # a smaller setting stays
        spark.conf.set(key, "64MB")
        P._MAPS.pop((spark.sparkContext.applicationId, "/root/testdata/sf0.001"), None)
        P.mapping(spark, "/root/testdata/sf0.001")
        assert int(spark.conf.get(key)) == 16 << 20
    finally:
        spark.conf.set(key, before)


def _staged_tables(spark, root):
    """Orders of every kind, some twice, and lines; articles, suppliers and parts missing or twice."""
    orders = [_order(k, k % 5) for k in range(1, 121)] + [_order(2), _order(30, 1), _order(None)]
    orders = [(*o[:4], None if o[0] in (6, 7) else o[4], o[5]) for o in orders]
    lines = [_line(k, n, 1, part=k * 5 + n, supp=None if k % 31 == 0 else k * 3 + n // 2) for k in range(1, 125) for n in range(1, 6)]
    lines += [_line(k, 1, 1, part=k * 5 + 1, supp=k * 3) for k in (2, 4, 30)] + [_line(None, 1, 1)]
    _tables(spark, root, orders, lines)
    parts = [(p, p % 47 + 1) for p in range(1, 46) if p % 8] + [(7, 8), (15, 5), (None, 1)]
    spark.createDataFrame(parts, "p_partkey long, p_size int").write.parquet(f"{root}/part.parquet")
    suppliers = [(s, s % 25) for s in range(0, 300) if s % 11] + [(30, 5), (31, 7), (31, None), (None, 3)]
    spark.createDataFrame(suppliers, "s_suppkey long, s_nationkey int").write.parquet(f"{root}/supplier.parquet")
    return P.mapping(spark, str(root))


def _all(df):
    return sorted(str(tuple(r)) for r in df.collect())


def _exchanged(df, column):
    """Exchanges of rows with this column, and joins of sorted ones."""
    wide, joins, todo = 0, 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        has = column in node.output().mkString(",")
        wide += node.nodeName() == "Exchange" and has
        joins += node.nodeName() == "SortMergeJoin" and has
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return wide, joins


def test_employee_history_is_that_of_the_view_and_shuffles_numbers(spark, tmp_path):
    m = _staged_tables(spark, tmp_path / "emp")
    names = {t: m.view(t) and m.prefix + t for t in ("orders", "lineitem", "supplier")}
    want = spark.sql(M.Template(M.VIEWS["m_emp"]).substitute(names))
    got = m.view("m_emp")
    assert got.schema.simpleString() == want.schema.simpleString()
    assert _all(got) == _all(want) and len(_all(want)) > 100
    assert _exchanged(got, "userprincipalname")[0] == 0


def test_staged_lines_stay_where_their_order_is(spark, tmp_path):
    m = _staged_tables(spark, tmp_path / "dealt")
    plain, s, cat, dims = m.feed("staged"), m.dealt_staged(), P._cat(m), P._dims(m)

    def sales(x):
        return guarantee.guarantee_sales(guarantee.articles_offered_guarantee(x, cat), guarantee.guarantees_per_order(x, cat))
    conf = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "15000", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for df in (rejects.accept_lines(s, *dims, P.MKT, source=s), rejects.reject_lines(s, *dims, P.MKT, source=s)):
            assert _exchanged(df, "orderComments") == (0, 1)
        wide, joins = _exchanged(sales(s), "ordernumber")
        assert wide == 0 and joins >= 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    dir_ = str(tmp_path / "dealt")
    cols = (*P._STAGE_OUT, "combinedarticleid", "pk_article")
    for got, want in ((P.q_d21(spark, dir_), P._stage_out(rejects.accept_lines(plain, *dims, P.MKT), cols)),
                      (P.q_d20(spark, dir_), P._stage_out(rejects.reject_lines(plain, *dims, P.MKT), P._REJ_OUT)),
                      (P.q_d26(spark, dir_), sales(plain).withColumn("order_date", P.dtxt("order_date")))):
        assert got.columns == want.columns
        assert _all(got) == _all(want) and len(_all(want)) > 50


def test_split_counts_join_the_lookups_once(spark, tmp_path):
    m = _staged_tables(spark, tmp_path / "split")
    s, dims = m.feed("staged"), P._dims(m)
    got = P.q_d20_21(spark, str(tmp_path / "split"))
    want = {"all": s.count(), "accepted": rejects.accept_lines(s, *dims, P.MKT).count(), "rejected": rejects.reject_lines(s, *dims, P.MKT).count()}
    assert {r.part: r.n for r in got.collect()} == want and want["accepted"] and want["rejected"]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert len([x for x in plan.splitlines() if "Join" in x and "__emp_upn" in x]) == 1
