import datetime as dt

from pyspark.sql import functions as F

from incidentmart.functions import (clean_text, coerce_int, date_key, exact_ratio, format_int,
                                    iso_weekday, parse_date, time_band, time_key, time_text)


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_clean_text_golden(spark):
    raw = [None, "", "   ", "\t", " ", "NA", "null", " x ", "\tx ", " NA ", "ok"]
    out = one(spark, clean_text("v"), [(v,) for v in raw], "v string")
    assert out == ["Sin especificar"] * 7 + ["x", "x", "NA", "ok"]


def test_coerce_int_golden(spark):
    out = one(spark, coerce_int("v"), [("7",), ("3.7",), ("x",), (None,), (" 12 ",), ("-2.9",)],
              "v string")
    assert out == [7, 3, 0, 0, 12, -2]


def test_only_decimal_notation_is_a_number(spark):
    raw = ["3d", "3f", "3D", "0x1p3", "0x10", "1e2", "-.5e1", "+4", "9007199254740993", "", ".", "1 2", "NaN"]
    out = one(spark, coerce_int("v"), [(v,) for v in raw], "v string")
    assert out == [0, 0, 0, 0, 0, 100, -5, 4, 9007199254740993, 0, 0, 0, 0]


def test_time_key_edges(spark):
    cases = [(0, 0, 0), (5, 59, 559), (6, 0, 600), (11, 59, 1159), (12, 0, 1200), (17, 59, 1759),
             (18, 0, 1800), (23, 59, 2359), (99, 10, -1), (5, 99, -1), (24, 0, -1), (-1, 0, -1)]
    df = spark.createDataFrame([(h, m) for h, m, _ in cases], "h int, m int")
    got = [r[0] for r in df.select(time_key("h", "m")).collect()]
    assert got == [k for _, _, k in cases]


def test_missing_hour_is_midnight(spark):
    df = spark.createDataFrame([(None, "15")], "h string, m string")
    assert df.select(time_key(coerce_int("h"), coerce_int("m"))).first()[0] == 15


def test_band_changes_at_6_12_18(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 23]
    got = one(spark, time_band("h"), [(h,) for h in hours], "h int")
    assert got == ["Madrugada", "Madrugada", "Mañana", "Mañana", "Tarde", "Tarde", "Noche", "Noche"]
    assert one(spark, time_text("h", "m"), [(9, 5)], "h int, m int") == ["09:05"]


def test_parse_date(spark):
    rows = [(2024, 2, 29), (2024, 2, 30), (2023, 2, 29), (2024, 0, 1), (0, 1, 1), (2024, 13, 1),
            (2024, 12, 31)]
    got = one(spark, parse_date("y", "m", "d"), rows, "y int, m int, d int")
    assert got == [dt.date(2024, 2, 29), None, None, None, None, None, dt.date(2024, 12, 31)]


def test_leap_day_attributes(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),)], "d date")
    r = df.select(date_key("d"), iso_weekday("d"), F.quarter("d")).first()
    assert tuple(r) == (20240229, 4, 1)


def test_half_rounding(spark):
    df = spark.createDataFrame([(1, 8), (-1, 8), (1, 0), (2, 3), (5, 2000)], "a long, b long")
    got = [float(r[0]) if r[0] is not None else None
           for r in df.select(exact_ratio("a", "b", 2)).collect()]
    assert got == [0.13, -0.13, None, 0.67, 0.0]
    pct = [float(r[0]) for r in df.limit(1).select(exact_ratio("a", "b", 2, 100)).collect()]
    assert pct == [12.5]


def test_format_int(spark):
    got = one(spark, format_int("v"), [(1234567,), (None,), (0,)], "v long")
    assert got == ["1,234,567", "0", "0"]
