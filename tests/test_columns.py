import datetime as dt

import pytest
from pyspark.sql import functions as F

from linefold.functions import columns as C
from linefold.functions import timewin as TW


def one(spark, data, schema, expr):
    df = spark.createDataFrame(data, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_safe_bigint(spark):
    # SAFE_CAST to INT64
    assert one(spark, [("12",), (" 12 ",), ("12x",), ("1.5",), ("",), (None,)], "s string",
               C.safe_bigint("s")) == [12, 12, None, None, None, None]


def test_parse_iso_millis(spark):
    # needs milliseconds and 'Z'; else null (trap 9)
    got = one(spark, [("2021-06-14T22:30:00.123Z",), ("2021-06-14T22:30:00Z",), (None,)], "s string",
              C.parse_iso_millis("s"))
    assert got == [dt.datetime(2021, 6, 14, 22, 30, 0, 123000), None, None]


def test_paris_wall_clock_and_day_over_clock_changes(spark):
    # F15, F10, trap 8: Paris wall clock of UTC instants around both clock changes
    data = [(dt.datetime(2021, 3, 27, 23, 30),), (dt.datetime(2021, 3, 28, 1, 0),),
            (dt.datetime(2021, 10, 31, 0, 30),), (dt.datetime(2021, 10, 31, 1, 30, 0, 500000),)]
    df = spark.createDataFrame(data, "ts timestamp_ntz")
    got = [(r[0], r[1]) for r in df.select(C.wall_clock("ts"), C.local_date("ts")).collect()]
    assert got == [
        (dt.datetime(2021, 3, 28, 0, 30), dt.date(2021, 3, 28)),
        (dt.datetime(2021, 3, 28, 3, 0), dt.date(2021, 3, 28)),
        (dt.datetime(2021, 10, 31, 2, 30), dt.date(2021, 10, 31)),
        (dt.datetime(2021, 10, 31, 2, 30), dt.date(2021, 10, 31)),   # cut to seconds
    ]


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 6, 4, 7, 5, 9),)], "ts timestamp_ntz")
    r = df.select(C.day_number("ts"), C.month_number("ts"), C.hour_minute("ts"), C.ts_text("ts")).first()
    assert tuple(r) == (20210604, 202106, "07:05", "2021-06-04 07:05:09")


@pytest.mark.parametrize("number,kind,key", [
    ("9-12", 1, "9-12"), ("9-12-1", 2, "9-12"), ("8-12-1", 2, "9-12"), ("12", 1, None), (None, 1, None)])
def test_order_kind_and_original_key(spark, number, kind, key):
    # D29, D39, trap 16: no second part gives null, not an error
    df = spark.createDataFrame([(number,)], "o string")
    r = df.select(C.order_kind("o"), C.original_key("o"), C.is_rekeyed_backorder("o")).first()
    assert r[0] == kind and r[1] == key
    assert bool(r[2]) == (number == "9-12-1")


def test_classify_backorder(spark):
    # Ajout (no original line), Reliquat (same), Minoration (less than original), Autre
    data = [("9-1-1", None, None, 3.0), ("9-1-1", 5, 3.0, 3.0), ("9-1-1", 5, 4.0, 3.0),
            ("9-1-1", 5, 2.0, 3.0), ("9-1", 5, 2.0, 3.0)]
    got = one(spark, data, "o string, pk long, oq double, q double", C.classify_backorder("o", "pk", "oq", "q"))
    assert got == ["Ajout", "Reliquat", "Minoration", "Autre", None]


def test_split_measures(spark):
    # D40: '9-' backorders move the measure to the backorder column
    df = spark.createDataFrame([("9-1-1", 4.0), ("8-1-1", 4.0), ("9-1", 4.0)], "o string, q double")
    got = [tuple(r) for r in df.select(C.split_backorder_measure("o", "q", False),
                                       C.split_backorder_measure("o", "q", True)).collect()]
    assert got == [(0.0, 4.0), (4.0, 0.0), (4.0, 0.0)]


def test_affected_employee_cascade(spark):
    # D15
    schema = "a string, nc long, b string, v string, no long, e string"
    data = [("DUMMY-FRAIS_LIV", 2, "u@x", "v@x", 1, "e@x"),   # fee line, 2 employees -> null
            ("1", 2, "u@x", "v@x", 1, "e@x"),                 # basket user
            ("1", 1, None, "v@x", 1, "e@x"),                  # validating user
            ("1", 1, None, None, 1, "e@x"),                   # only employee of the order
            ("1", 1, None, None, 2, "e@x")]                   # none
    got = one(spark, data, schema, C.affected_employee("a", "nc", "b", "v", "no", "e"))
    assert got == [None, "u@x", "v@x", "e@x", None]


def test_mask_external(spark):
    # D16
    D = ("@EXTERNAL.EXAMPLE", "@PARTNER.EXAMPLE")
    got = one(spark, [("a" + D[0] + ".COM",), ("b" + D[1],), ("c@x",), (None,)], "e string",
              C.mask_external_employee("e", D))
    assert got == [None, None, "c@x", None]


def test_attribute_store(spark):
    # D28
    schema = "service string, emp long, pref long, home long"
    data = [("STORE", 12, 5, 7), ("STORE", 147, 5, 7), ("CUSTOMER", 12, 5, 7), (None, None, None, 147),
            (None, None, None, 9), ("STORE", None, None, 9)]
    got = one(spark, data, schema, C.attribute_store("service", "emp", "pref", "home"))
    assert got == [12, 5, 5, 32, 9, 9]


def test_final_employee(spark):
    # D42
    schema = "o string, pk long, oe string, d date, e string, c string"
    data = [("9-1-1", 5, "orig@x", dt.date(2021, 1, 1), "e@x", "c@x"),
            ("9-1", None, None, dt.date(2020, 1, 1), "e@x", "c@x"),
            ("9-1", None, None, dt.date(2021, 1, 1), "e@x", "c@x"),
            ("9-1", None, None, dt.date(2021, 1, 1), "e@x", None)]
    got = one(spark, data, schema, C.final_employee("o", "pk", "oe", "d", "e", "c"))
    assert got == ["orig@x", "e@x", "c@x", "e@x"]


def test_priority_maps(spark):
    got = one(spark, [("DELIVERED",), ("CANCELLED",), ("FOO",), (None,)], "s string",
              C.priority("s", {"DELIVERED": 7, "CANCELLED": 9}))
    assert got == [7, 9, 0, 0]


def test_round_sum_is_exact(spark):
    # trap 13: decimal sum then round, no float noise
    df = spark.createDataFrame([(0.1,), (0.2,), (1.005,)], "x double")
    assert df.agg(C.round_sum("x")).first()[0] == 1.31


def test_time_windows(spark):
    # D45, trap 10
    as_of = dt.datetime(2024, 1, 29, 23, 30)
    assert TW.local_today(as_of) == dt.date(2024, 1, 30)
    assert TW.timestamp_window_start("5min", as_of) == TW.local_now(as_of) - dt.timedelta(minutes=10)
    assert TW.window_start("5min", as_of) == TW.window_start("LAST_24H", as_of) == dt.date(2024, 1, 30)
    with pytest.raises(ValueError):
        TW.window_start("HOURLY", as_of)
    assert TW.months_back(dt.datetime(2021, 5, 31), 3) == dt.date(2021, 2, 28)
    df = spark.createDataFrame([(dt.date(2024, 1, 29),), (dt.date(2024, 1, 30),)], "d date")
    assert [r[0] for r in df.select(TW.since_today("d", as_of)).collect()] == [False, True]
    df = spark.createDataFrame([(dt.datetime(2024, 1, 30, 0, 25),), (dt.datetime(2024, 1, 30, 0, 15),)],
                               "t timestamp_ntz")
    assert [r[0] for r in df.select(TW.last_minutes("t", 10, as_of)).collect()] == [True, False]
    assert F is not None
