import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerwatch.functions import (clean_string, full_name, minus_one_second, parse_amount,
                                   parse_day, parse_ts, ts_string, lit_ts, epoch_micros)


def test_clean_string_matrix(spark):
    df = spark.createDataFrame([("  a ",), ("",), ("   ",), ("a\tb",), (None,), ("\tx ",)], "s string")
    out = [r[0] for r in df.select(clean_string("s")).collect()]
    # trim removes spaces only; empty becomes NULL
    assert out == ["a", None, None, "a\tb", None, "\tx"]


def test_full_name_null_parts(spark):
    df = spark.createDataFrame([("Ivanov", "Ivan", "Ivanovich"), ("Ivanov", "Ivan", None), (None, None, None)],
                               "l string, f string, p string")
    out = [r[0] for r in df.select(full_name("l", "f", "p")).collect()]
    assert out == ["Ivanov Ivan Ivanovich", "Ivanov Ivan ", "  "]


def test_parse_amount_both_marks(spark):
    df = spark.createDataFrame([("12.5",), ("12,5",), (" 7 ",)], "a string")
    assert [r[0] for r in df.select(parse_amount("a")).collect()] == [Decimal("12.50"), Decimal("12.50"),
                                                                      Decimal("7.00")]


def test_parse_amount_junk_raises(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(Exception):
        df.select(parse_amount("a")).collect()


def test_parse_ts_and_day(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05", "2024-01-02 10:11:12")], "t string, d string")
    r = df.select(parse_ts("t").alias("t"), parse_day("d").alias("d")).first()
    assert r.t == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert r.d == dt.datetime(2024, 1, 2)


def test_minus_one_second_and_render(spark):
    r = spark.range(1).select(ts_string(minus_one_second(lit_ts("2024-01-02 00:00:00"))).alias("x"),
                              ts_string(lit_ts("9999-01-01 00:00:00")).alias("e")).first()
    assert r.x == "2024-01-01 23:59:59"
    assert r.e == "9999-01-01 00:00:00"


def test_epoch_micros_zone_free(spark):
    r = spark.range(1).select(epoch_micros(lit_ts("1970-01-01 01:00:00")).alias("u")).first()
    assert r.u == 3600 * 1_000_000
    _ = F
