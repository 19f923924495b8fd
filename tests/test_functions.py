"""F1-F11 on literal rows with edge cases."""

import datetime as dt


from assetlens import functions as fn


def one(spark, expr, rows, schema="v string"):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("r")).collect()]


def test_is_blank(spark):
    vals = [None, "", " ", "\t", "null", " null ", "NULL", "x", "\x00 \x1f"]
    got = one(spark, fn.is_blank("v"), [(v,) for v in vals])
    assert got == [True, True, True, True, True, False, False, False, True]


def test_blank_equals(spark):
    rows = [(None, ""), ("a", "a"), ("a", "A"), ("a", None), (" ", "null")]
    df = spark.createDataFrame(rows, "a string, b string")
    cs = [r[0] for r in df.select(fn.blank_equals("a", "b")).collect()]
    ci = [r[0] for r in df.select(fn.blank_equals("a", "b", ignore_case=True)).collect()]
    assert cs == [True, True, False, False, True]
    assert ci == [True, True, True, False, True]


def test_to_int(spark):
    vals = [None, "", "12", " 12 ", "12.9", "x", "-3.7", "\t7\n"]
    assert one(spark, fn.to_int("v"), [(v,) for v in vals]) == [None, None, 12, 12, 12, None, -3, 7]


def test_to_bool_and_str(spark):
    vals = ["true", "YES", "1", "false", "no", "0", "x", None, " True "]
    assert one(spark, fn.to_bool("v"), [(v,) for v in vals]) == [True, True, True, False, False, False, False,
                                                                 False, True]
    assert one(spark, fn.to_bool("v", default=True), [("x",), (None,)]) == [True, True]
    assert one(spark, fn.to_str("v"), [(None,), ("a",)]) == ["", "a"]


def test_segment_keys(spark):
    rows = [(dt.datetime(2024, 1, 7, 0, 0),),    # Sunday, hour 0
            (dt.datetime(2024, 1, 8, 23, 59),),  # Monday, hour 23
            (dt.datetime(2024, 12, 31, 12, 0),)]  # December, Tuesday
    df = spark.createDataFrame(rows, "ts timestamp")
    got = df.select(*[fn.segment_key("ts", s).alias(f"s{s}") for s in (1, 2, 3, 4, 9)]).collect()
    assert [tuple(r) for r in got] == [(0, 7, 1, 1, None), (23, 1, 1, 1, None), (12, 2, 12, 12, None)]


def test_segment_key_zone_day_boundary(spark):
    # 2024-01-07 20:00 UTC is Monday 04:00 in Asia/Shanghai
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 20, 0),)], "ts timestamp")
    r = df.select(fn.segment_key("ts", 1).alias("h_utc"), fn.segment_key("ts", 1, "Asia/Shanghai").alias("h_loc"),
                  fn.segment_key("ts", 2).alias("d_utc"), fn.segment_key("ts", 2, "Asia/Shanghai").alias("d_loc")
                  ).first()
    assert (r.h_utc, r.h_loc, r.d_utc, r.d_loc) == (20, 4, 7, 1)


def test_asset_ips(spark):
    vals = ['{"00:00":["192.168.8.97"]}',
            '{"aa":["10.0.0.2","10.0.0.1"],"bb":["10.0.0.1","10.0.0.3"]}',
            '{"aa":[]}', None, "{bad", "[]"]
    got = one(spark, fn.asset_ips("v"), [(v,) for v in vals])
    assert got == [["192.168.8.97"], ["10.0.0.1", "10.0.0.2", "10.0.0.3"], [], [], [], []]


def test_display_ip(spark):
    vals = ['{"00:00:00:00:00:00":["192.168.8.97"]}', '{"a":["1","2"],"b":["3"]}']
    assert one(spark, fn.display_ip("v"), [(v,) for v in vals]) == ['"192.168.8.97"', '"1","2"']


def test_row_id_deterministic(spark):
    df = spark.createDataFrame([("m1", "c1"), ("m1", "c1"), ("m1", "c2")], "m string, e string")
    ids = [r[0] for r in df.select(fn.profile_row_id("m", "e")).collect()]
    assert ids[0] == ids[1] != ids[2] and ids[0].startswith("mdl_") and len(ids[0]) == 4 + 64


def test_rates(spark):
    rows = [(1, "hh", 1), (5, "mm", 1), (1, "dd", 2), (1, "MM", 3), (1, "MM", 4), (1, "hh", 2), (1, "dd", 9)]
    df = spark.createDataFrame(rows, "n int, u string, s int")
    got = df.select(fn.model_rate("n", "u"), fn.rate_seconds("n", "u"), fn.valid_rate("s", "u"),
                    fn.model_cycle("s")).collect()
    assert [tuple(r) for r in got] == [
        ("1hh", 3600, True, "DAYS"), ("5mm", 300, True, "DAYS"), ("1dd", 86400, True, "WEEK"),
        ("1MM", 2592000, True, "QUARTER"), ("1MM", 2592000, True, "YEAR"), ("1hh", 3600, False, "WEEK"),
        ("1dd", 86400, False, None)]
