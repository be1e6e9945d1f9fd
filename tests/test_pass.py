"""The resumable pass (D46): ledger, one table of verdicts, dated lookups,
clustered fact, on sf0.001 and on small made-up rows."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from linefold.operators import fact, guarantee, people, rejects, versions
from linefold.plans import mapping as M
from linefold.plans import proofs as P
from linefold.plans import run as R
from linefold.session import checkpoint_root
from linefold.sources import tables as S
from linefold.sources.ledger import Ledger, key_of, state_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data missing")


class Stop(Exception):
    pass


def fresh(spark, name):
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def m(spark):
    return P.mapping(spark, SF)


@pytest.fixture(scope="module")
def inputs(m):
    web, drop, mkt, fsd = P._feeds(m)
    return R.OrderTables(webshop=web, dropship=drop, marketplace=mkt, fsd=fsd, structured=m.structured(),
                         commissions=m.commissions(), mkp_orderline=m.view("m_mkp"), price_view=m.view("m_price"),
                         art=m.view("m_art"), emp=m.view("m_emp"), promo=m.view("m_promo"),
                         shop=m.view("m_bridge"), pref=m.view("m_pref"))


def windows(**more):
    return R.Windows(since=M.SINCE, since_long=M.LONG_SINCE, external_domains=M.EXTERNAL_DOMAINS, min_date=M.MIN_DATE,
                     promo_since=M.PROMO_SINCE, net_cutoff=M.NET_CUTOFF, fee_cutoff=M.FEE_CUTOFF, marketplace_type=P.MKT,
                     fact_partition_by=("order_month",), **more)  # by month: few folders


def tables_of(spark, out):
    return (rows(spark.read.schema(fact.fact_schema()).parquet(out["fact"]), *fact.FACT_COLUMNS, "load_run"),
            rows(spark.read.schema(rejects.reject_schema()).parquet(out["rejects"])))


def test_pass_goes_on_after_any_step(spark, m, inputs, monkeypatch):
    args = ("1", M.AS_OF, windows(), None)
    plain = R.run_orders(spark, inputs, fresh(spark, "plain"), *args, fact_seed=P._seed(m))
    root, real, done, lost = fresh(spark, "broken"), Ledger.finish, [], ["judged", "fact", "rejects"]

    def breaks(self, step, key, facts=None):
        if step in lost:  # written, but not recorded
            lost.remove(step)
            raise Stop
        real(self, step, key, facts)
        if step not in ("started", "seed"):
            done.append(step)
            raise Stop

    monkeypatch.setattr(Ledger, "finish", breaks)
    for _ in range(len(lost) + 15 + 1):
        try:
            out = R.run_orders(spark, inputs, root, *args, fact_seed=P._seed(m), resume=True)
            break
        except Stop:
            pass
    monkeypatch.setattr(Ledger, "finish", real)
    assert done == ["basket", "employee_counts", "enriched", "stage", "art", "days", "judged", "results", "running", "large_groups",
                    "original_keys", "fact_new", "fact", "rejects", "pass"]  # each step once
    assert tables_of(spark, out) == tables_of(spark, plain) and out["counts"] == plain["counts"]
    n = out["counts"]
    assert n["accepted"] + n["rejected"] + n["neither"] == n["lines"] == n["staged"] == spark.read.parquet(out["stage"]).count()
    assert n["rejected"] == spark.read.parquet(out["rejects"]).count() > 0

    # a whole pass is not run again, one with other parameters is
    monkeypatch.setattr(R, "build_stage", lambda *a, **k: (_ for _ in ()).throw(Stop()))
    assert R.run_orders(spark, inputs, root, *args, resume=True) == out
    for other in (("1", M.AS_OF + dt.timedelta(minutes=1), windows(), None), ("1", M.AS_OF, windows(null_as_reject=True), None)):
        with pytest.raises(Stop):
            R.run_orders(spark, inputs, root, *other, resume=True)
    with pytest.raises(Stop):
        R.run_orders(spark, inputs, root, *args, resume=True, version="2")
    with pytest.raises(Stop):
        R.run_orders(spark, inputs, root, *args)


def test_bucketed_fact_is_the_same_and_is_not_shuffled(spark, m, inputs):
    args = ("1", M.AS_OF, windows(), None)
    plain = R.run_orders(spark, inputs, fresh(spark, "files"), *args, fact_seed=P._seed(m))
    win, root = windows(fact_buckets=4), fresh(spark, "buckets")
    out = R.run_orders(spark, inputs, root, "1", M.AS_OF, win, None, fact_seed=P._seed(m))
    for a, b in zip(tables_of(spark, out), tables_of(spark, plain)):
        assert len(a) == len(b) and next(((x, y) for x, y in zip(a, b) if x != y), None) is None
    again = R.run_orders(spark, inputs, root, "1", M.AS_OF, win, None)  # replaces its own rows
    assert tables_of(spark, again) == tables_of(spark, plain)
    name = S.bucketed_table(spark, root + "/fact", fact.fact_schema(), ("order_month", "load_run"), "ordernumber", 4)
    old, new = spark.table(name), spark.read.parquet(out["stage"])
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.requireAllClusterKeysForCoPartition")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in zip(keys, ("-1", "-1", "false")):
        spark.conf.set(k, v)
    try:
        duplicates = plan(fact.append_new_only(new, old, None))
        originals = plan(fact.keyed_originals(old, new).join(new.select("ordernumber"), "ordernumber"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert before["spark.sql.requireAllClusterKeysForCoPartition"] in (None, "true")
    assert "Bucketed: true" in duplicates and duplicates.count("Exchange hashpartitioning") == 1  # that of the stage
    assert "Bucketed: true" in originals and originals.count("Exchange hashpartitioning") == 1


def test_options_are_looked_for_in_the_array(spark, m):
    cat = P._cat(m)
    small, joined = guarantee.articles_offered_guarantee(m.staged(), cat), guarantee.articles_offered_guarantee(m.staged(), cat, most=0)
    assert rows(small) == rows(joined) and small.count() > 0
    p = plan(small)
    assert "Join" not in p and "Generate" not in p and p.count("Exchange hashpartitioning") == 1
    assert guarantee.articles_offered_guarantee(m.staged(), cat.filter("pk_article < -1")).count() == 0


def test_running_sum_in_two_levels_equals_the_window(spark):
    import random
    from pyspark.sql import Window
    r = random.Random(8)
    data = [(r.choice(["hot"] * 6 + ["a", "b", None]), r.choice([None, *range(40)]), r.choice([None, 1.0, 2.5, 0.1])) for _ in range(900)]
    df = spark.createDataFrame(data, "o string, k bigint, v double")
    w = Window.partitionBy("o").orderBy("k").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    want = rows(df.withColumn("s", F.sum(F.col("v").cast("decimal(28,9)")).over(w)))
    for most, ranges in ((10_000, 64), (50, 7), (0, 64), (0, 1)):
        got = guarantee.running_sum(df, "o", "k", "v", "s", most=most, ranges=ranges)
        assert rows(got) == want, (most, ranges)
    # a hot group is several tasks: its window is over ranges of the order, too
    p = plan(guarantee.running_sum(df, "o", "k", "v", "s", most=50, ranges=7))
    assert "hashpartitioning(o" in p and "__range" in p
    assert guarantee.running_sum(df.filter("k IS NULL"), "o", "k", "v", "s", most=0).count() == df.filter("k IS NULL").count()
    assert guarantee.running_sum(df.limit(0), "o", "k", "v", "s", most=0).count() == 0


def test_ledger(spark):
    path = fresh(spark, "ledger")
    made = []
    for key, resume, runs in (("a", True, 1), ("a", True, 1), ("b", True, 2), ("b", False, 3)):
        log = Ledger(spark, path, resume)
        assert log.run("step", key, lambda: made.append(1) or {"n": len(made)}) == {"n": runs}
        assert len(made) == runs and len(log.done) + len(log.skipped) == 1
    log = Ledger(spark, path, True)
    assert not log.finished("step", "b", table=path + "/gone") and log.finished("step", "b", table=path)

    def fails():
        raise Stop

    with pytest.raises(Stop):
        log.run("step", "c", fails)
    assert log.record("step") is None  # a step that failed is not finished under its old key either
    assert key_of(1, dt.date(2021, 1, 1)) != key_of(1, dt.date(2021, 1, 2))


def test_state_of_inputs_changes_with_their_files(spark):
    path = fresh(spark, "state")
    one = spark.range(10).withColumn("d", F.col("id") % 2)
    one.write.partitionBy("d").parquet(path)
    before = state_of(spark.read.parquet(path))
    assert before == state_of(spark.read.parquet(path)) != state_of(spark.read.parquet(path).select("id"))
    one.write.mode("append").partitionBy("d").parquet(path)
    after = state_of(spark.read.parquet(path))
    assert after != before
    one.withColumn("d", F.lit("a b/c%")).write.partitionBy("d").mode("append").parquet(path)
    assert state_of(spark.read.parquet(path)) != after
    back = spark.read.schema("id bigint, d string").parquet(path)
    assert state_of(back, without="d=a b/c%") == state_of(back.filter("d <> 'a b/c%'"), without="d=a b/c%") != state_of(back)


def test_employee_counts_scan_each_feed_once(m):
    web, drop, mkt, fsd = P._feeds(m)
    counts = people.employee_counts(web, drop, fsd, mkt, P._basket(m), M.SINCE, M.MIN_DATE)
    p = plan(counts)
    feeds_and_events = 4 + plan(P._basket(m)).count("FileScan")
    assert p.count("FileScan") == feeds_and_events and p.count("Generate inline") == 4
    for kind, one, key in ((people.ORDER, people.employees_per_order(web, drop, fsd, mkt, M.SINCE, M.MIN_DATE), "ordernumber"),
                           (people.COMBI, people.employees_per_combi(web, drop, fsd, mkt, P._basket(m), M.SINCE, M.MIN_DATE), "combiorderid")):
        assert rows(people.counts_of(counts, kind)) == rows(one) and one.columns[0] == key


def test_verdicts_are_the_two_outputs(spark, m):
    s, dims = m.staged(), P._dims(m)
    for null_as_reject in (False, True):
        judged, watch = rejects.counted(rejects.judge_lines(s, *dims, P.MKT, null_as_reject), f"w{null_as_reject}")
        judged.write.parquet(path := fresh(spark, "judged"))
        back = spark.read.parquet(path)
        assert rows(rejects.rejected_lines(back)) == rows(rejects.reject_lines(s, *dims, P.MKT, null_as_reject))
        accepted = rejects.accept_lines(s, *dims, P.MKT)
        assert rows(rejects.accepted_lines(back), *accepted.columns) == rows(accepted)
        assert watch.get["lines"] == back.count() == sum(watch.get[v] for v in (rejects.ACCEPTED, rejects.REJECTED, rejects.NEITHER))
        assert (watch.get[rejects.NEITHER] == 0) or not null_as_reject


def test_dated_lookup_reads_the_days_of_the_stage(spark, m):
    emp = spark.sql("SELECT explode(sequence(DATE'2021-01-01', DATE'2021-12-31')) AS date_of_day, 'e@x' AS userprincipalname, 'S' AS service, 1L AS id_store")
    path = fresh(spark, "emp")
    S.replace_partitions(emp, path, tuple(emp.columns), ("date_of_day",))
    staged = spark.createDataFrame([(dt.date(2021, 3, 1),), (dt.date(2021, 3, 1),), (dt.date(2021, 5, 9),), (None,)], "order_date date")
    days = fact.stage_days(staged)
    got = fact.for_days(spark.read.parquet(path), days)
    p = plan(got)
    assert "dynamicpruning" in p and "BroadcastHashJoin" in p and "LeftSemi" in p
    assert sorted(r["date_of_day"] for r in got.collect()) == [dt.date(2021, 3, 1), dt.date(2021, 5, 9)]
    scan = next(x for x in leaves(got._jdf.queryExecution().executedPlan()) if "numPartitions" in str(x.metrics().keys()) and x.metrics().apply("numPartitions").value())
    assert scan.metrics().apply("numPartitions").value() == 2
    assert fact.for_days(spark.read.parquet(path), fact.stage_days(staged.filter("order_date IS NULL"))).count() == 0


def leaves(node):
    """Leaf nodes of an executed plan, the final one of an adaptive plan."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return leaves(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return leaves(node.plan())
    children = node.children()
    found = [x for k in range(children.size()) for x in leaves(children.apply(k))]
    return found or [node]


def test_lowest_revision_needs_one_scan_one_shuffle_and_no_join(spark, m):
    x = spark.read.parquet(f"{SF}/lineitem.parquet").withColumn("l_comment", F.lit(None).cast("string"))
    df = versions.lowest_revision(x, ["l_comment", "l_orderkey"], [F.col("l_linenumber").asc()], match=["l_orderkey", "l_comment", "l_linenumber"],
                                  null_safe=["l_comment"], ranked=F.col("l_linenumber") > 1)
    p = plan(df)
    assert p.count("FileScan") == 1 and p.count("Exchange ") == 1 and "Join" not in p
    least = versions.top_rank(x.filter("l_linenumber > 1"), ["l_orderkey"], [F.col("l_linenumber").asc()]).select("l_orderkey", "l_linenumber")
    assert rows(df, "l_orderkey", "l_linenumber") == rows(x.join(least, ["l_orderkey", "l_linenumber"]), "l_orderkey", "l_linenumber")


def test_lowest_revision_equals_the_join(spark):
    # random rows with ties, nulls in every key and rows that are not ranked
    import random
    r = random.Random(4)
    data = [(k, r.choice(["o", "p", None]), r.choice(["", None, "c"]), r.choice(["S", "T", None]), r.choice([1, 2]) if k % 50 else None, r.random() < 0.7) for k in range(300)]
    df = spark.createDataFrame(data, "id int, o string, c string, st string, rev int, ok boolean")
    got = versions.lowest_revision(df, ["c", "o"], [F.col("rev").asc()], match=["o", "c", "st", "rev"], null_safe=["c"], ranked=F.col("ok"))
    best = versions.top_rank(df.filter("ok"), ["c", "o"], [F.col("rev").asc()]).selectExpr("o AS o2", "c AS c2", "st AS st2", "rev AS rev2")
    want = df.join(best, F.expr("o = o2 AND coalesce(c, '') = coalesce(c2, '') AND st = st2 AND rev = rev2")).select(df.columns)
    assert rows(got) == rows(want) and got.count() > 300 and rows(got, "id") != rows(got.distinct(), "id")


def test_only_keyed_orders_reach_the_originals(spark, m, monkeypatch):
    old, results = m.fact_old(), spark.createDataFrame([("9-5-1",), ("9-5-1",), ("9-7",), (None,), ("x",)], "ordernumber string")
    for size in (16 << 20, 0):
        monkeypatch.setattr(fact, "KEY_BYTES", size)
        some = fact.keyed_originals(old, results)
        wanted = {r["k"] for r in results.select(fact.original_key("ordernumber").alias("k")).dropna().distinct().collect()}
        assert {r["ordernumber"] for r in some.collect()} <= wanted
        assert rows(some) == rows(old.filter(F.col("ordernumber").isin(*wanted)))
        assert "LeftSemi" in plan(some)
        # the aggregate of D37 lies above the semi-join
        p = fact.original_orders(some, None)._jdf.queryExecution().optimizedPlan().toString()
        assert p.index("Aggregate") < p.index("LeftSemi")
    assert fact.keyed_originals(old, results.filter("ordernumber IS NULL")).count() == 0


def test_a_clustered_fact_reads_few_row_groups_for_an_order(spark):
    import glob

    import pyarrow.parquet as pq
    path = fresh(spark, "clustered")
    df = spark.range(200_000).select(F.date_add(F.lit("2021-01-01").cast("date"), (F.col("id") % 2).cast("int")).alias("order_date"),
                                     F.concat(F.lit("9-"), F.lpad(F.xxhash64("id").cast("string"), 22, "0")).alias("ordernumber"), F.col("id").alias("n"))
    # one order holds a third of the rows: the next columns split it
    df = df.withColumn("ordernumber", F.when(F.col("n") % 3 == 0, "9-hot").otherwise(F.col("ordernumber")))
    small = {"parquet.block.size": str(128 << 10), "parquet.page.size": str(16 << 10), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        S.append_run(df, path, ("order_date", "ordernumber", "n"), "r1", cluster_by=("ordernumber", "n"))
    finally:
        for k in small:
            spark.conf.unset(k)
    key = df.filter("n = 1").first()["ordernumber"]
    groups = hit = 0
    for f in glob.glob(path.removeprefix("file:") + "/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            st = meta.row_group(g).column(0).statistics
            groups, hit = groups + 1, hit + (st.min <= key <= st.max)
    assert groups >= 20 and hit <= 2
    back = spark.read.parquet(path)
    assert back.count() == 200_000 and back.filter(F.col("ordernumber") == key).count() == 1
    S.append_run(df, path, ("order_date", "ordernumber", "n"), "r1", cluster_by=("ordernumber", "n"))
    assert spark.read.parquet(path).count() == 200_000
