"""Micro rows for every parsing policy (FIXTURES §C)."""

from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException, NumberFormatException, SparkRuntimeException
from pyspark.sql import functions as F

from ledgerlake.functions import cleaning as C
from ledgerlake.functions import predicates as P


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_gated_number(spark):
    vals = ["5.", "-3.20", "1e3", ".5", "+5", "1,000", "5\n", "计费基数", "", None]
    got = one_col(spark, vals, C.num_or_null)
    assert got[:2] == [Decimal("5.0000"), Decimal("-3.2000")]
    assert got[2:] == [None] * 8
    zero = one_col(spark, vals, C.num_or_zero)
    assert zero[2:] == [Decimal("0.0000")] * 8


def test_grouped_number(spark):
    assert one_col(spark, ["1,234.5", "--", "", None], C.num_grouped) == [
        Decimal("1234.5000"), Decimal("0.0000"), Decimal("0.0000"), Decimal("0.0000")]
    assert one_col(spark, ["1,234.5", "--", "-", "", "abc"], C.num_grouped_null) == [
        1234.5, None, None, None, None]


def test_strict_number(spark):
    assert one_col(spark, ["", " 12.5 "], C.num_strict) == [None, Decimal("12.5000")]
    with pytest.raises((NumberFormatException, SparkRuntimeException, ArithmeticException, Exception)):
        one_col(spark, ["x"], C.num_strict)


def test_dash_null(spark):
    assert one_col(spark, ["-", "", "2.5"], C.num_dash_null) == [None, None, Decimal("2.5000")]


def test_norm_code(spark):
    assert one_col(spark, ["123.0", "1e3", "-", "A-1\t", "", None, " 77 "], C.norm_code) == [
        "123", "1000", "", "A-1", "", "", "77"]


def test_store_name(spark):
    assert one_col(spark, ["X（A店）", "X(A店)", "X（A）Y(B)", "无括号", "多行(\nA)"], C.paren_extract) == [
        "A店", "A店", "B", "无括号", "\nA"]


def test_clean_text(spark):
    assert one_col(spark, ["123\t", " \t ", "\ta b\t"], C.clean_text) == ["123", None, "a b"]
    assert one_col(spark, ["123\t", "  "], C.trim_null) == ["123\t", None]


def test_day_filter(spark):
    got = one_col(spark, ["2026年03月25日 08:00", "2026-03-25 08:00:00", "2026-03-26 00:00:00", "junk"],
                  P.dual_format_day)
    assert [str(d) if d else None for d in got] == ["2026-03-25", "2026-03-25", "2026-03-26", None]


def test_cancelled_filter_is_three_valued(spark):
    df = spark.createDataFrame([(None, None), ("已完成", None), ("已完成", "无"), ("已取消", "无")],
                               "s string, r string")
    kept = df.where(P.not_cancelled_or_refunded("s", "r")).collect()
    assert [tuple(r) for r in kept] == [("已完成", "无")]


def test_refund_clamp(spark):
    df = spark.createDataFrame([(True, "5"), (True, "-5"), (True, None), (False, None), (False, "7")],
                               "f boolean, v string")
    got = [r[0] for r in df.select(C.refund_clamp(F.col("f"), C.num_or_null("v"))).collect()]
    assert got == [Decimal("0.0000"), Decimal("-5.0000"), Decimal("0.0000"), None, Decimal("7.0000")]


def test_dates(spark):
    assert [str(d) for d in one_col(spark, ["2026-03-05", "2026-3-5"], C.date_lenient)] == [
        "2026-03-05", "2026-03-05"]
    assert [str(d) for d in one_col(spark, ["2026-03-25 08:00:00"], C.date_fmt)] == ["2026-03-25"]
    assert one_col(spark, ["n/a"], C.date_lenient) == [None]


def test_net_vs_abs(spark):
    df = spark.createDataFrame([(Decimal(5),), (Decimal(-3),)], "x decimal(18,4)")
    r = df.agg(F.abs(F.sum("x")).alias("a"), F.sum(F.abs("x")).alias("b")).first()
    assert (r.a, r.b) == (Decimal(2), Decimal(8))


def test_norm_code_long_codes(spark):
    from pyspark.sql import functions as F
    from ledgerlake.functions import cleaning as C
    rows = spark.createDataFrame([("123456789012345678901234567890",), ("0012345678901234567890.00",), ("1e3",), ("-0",), ("1d",), ("1e40",)], "x string")
    got = [r[0] for r in rows.select(C.norm_code(F.col("x"))).collect()]
    assert got == ["123456789012345678901234567890", "12345678901234567890", "1000", "0", "1d", "1e40"]
