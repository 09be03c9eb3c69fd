"""FIXTURES §C micro rows for the jobs' business rules."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import models as M
from ledgerlake.plans import recon as R
from ledgerlake.plans import settlement as S
from ledgerlake.sources import split_files as SF


def test_gbk_csv_detected_and_read(spark, tmp_path):
    (tmp_path / "mt.csv").write_bytes("订单编号,金额\n1\t,5.00\n".encode("gbk"))
    (tmp_path / "el.csv").write_bytes("订单编号,金额\n2,6.00\n".encode("utf-8"))
    rows = sorted(tuple(r) for r in SF.read_csv(spark, str(tmp_path / "*.csv"), "GBK").select("订单编号", "金额").collect())
    assert rows == [("1\t", "5.00"), ("2", "6.00")]


def test_statement_identity(spark):
    base = {c: "0" for c in R.STATEMENT_REQUIRED}
    rows = [dict(base, order_no="ok", goods="10", settlement="10.02"),
            dict(base, order_no="bad", goods="10", settlement="10.03"),
            dict(base, order_no="comma", goods="1,000", settlement="1,000.00")]
    df = spark.createDataFrame(rows)   # optional columns absent → skipped
    got = {r.order_no: r.diff for r in R.statement_identity(df).collect()}
    assert got == {"bad": Decimal("0.0300")}
    with pytest.raises(ValueError):
        R.statement_identity(df.drop("refund"))


def test_subsidy_reasons(spark):
    df = spark.createDataFrame([("10", "10.01", "0"), ("10", "9", "0"), ("10", "10", "1"), (None, "1", "0")],
                               "s string, j string, m string")
    from ledgerlake.functions.cleaning import num_or_null
    got = [r[0] for r in df.select(R.subsidy_reason(num_or_null("s"), num_or_null("j"), num_or_null("m")))
           .collect()]
    assert got == [None, R.REASON_MISMATCH, R.REASON_MERCHANT_NONZERO, R.REASON_UNPARSABLE]


def test_rent_charged_once_platform_ascending(spark):
    day = dt.date(2026, 3, 25)
    rev = spark.createDataFrame([(day, "美团", "S", Decimal(10), Decimal(1), Decimal(1), 5),
                                 (day, "京东", "S", Decimal(20), Decimal(2), Decimal(2), 5)],
                                "dt date, platform string, store_name string, revenue decimal(18,4), "
                                "platform_fee decimal(18,4), shipping decimal(18,4), order_count bigint")
    empty_cost = spark.createDataFrame([], "dt date, store_name string, platform string, cost decimal(18,4)")
    empty_ship = spark.createDataFrame([], "dt date, store_name string, maiyatian_shipping decimal(18,4)")
    empty_promo = spark.createDataFrame([], "dt date, platform string, store_name string, promotion_cost decimal(18,4)")
    ref = spark.createDataFrame([("S", "P", "C", Decimal("100.0000"))],
                                "store_short_name string, province string, city string, daily_rent_labor decimal(10,4)")
    mart = M.ads_daily_report(rev, empty_cost, empty_ship, empty_promo, ref)
    got = {r.platform: r.rent_labor_allocated for r in mart.collect()}
    assert got == {"京东": Decimal("100.00"), "美团": Decimal("0.00")}    # binary order: 京 < 美


def test_jd_null_fee_type_is_not_revenue(spark):
    jd = spark.createDataFrame([(dt.date(2026, 3, 25), "京东", "S", "o1", None, Decimal(5)),
                                (dt.date(2026, 3, 25), "京东", "S", "o1", "用户实付货款", Decimal(7)),
                                (dt.date(2026, 3, 25), "京东", "S", "o2", "代收到家佣金", Decimal(-2))],
                               "dt date, platform string, store_name string, order_no string, fee_type string, "
                               "amount decimal(18,4)")
    r = M.jd_revenue_agg(jd).first()
    assert (r.revenue, r.platform_fee, r.order_count) == (Decimal("7.0000"), Decimal("2.0000"), 2)


def test_freight_without_orders(spark):
    ob = spark.createDataFrame([("S", 0)], "store_label string, order_cnt bigint")
    fd = spark.createDataFrame([(Decimal("12.00"),)], "total_freight decimal(28,4)")
    r = S.freight_allocate(ob, fd).first()
    assert r.freight_alloc == 0 and r.freight_per_order is None


def test_one_day_window_and_sizing():
    from ledgerlake.session import sizing_conf
    w = S.Window.one_day("2026-03-31")
    assert (w.d, w.d_end) == ("2026-03-31", "2026-04-01")
    mb = 1 << 20
    small = sizing_conf(10 * mb, 8)
    big = sizing_conf(100 * (1 << 40), 8000)          # 100 TB on 1000 executors × 8 cores
    assert int(small["spark.sql.files.maxPartitionBytes"]) == mb
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 128 * mb
    assert int(big["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == 64 * mb


def test_tolerance_holds_for_its_day_only(spark):
    from ledgerlake.plans import quality as Q
    mart = spark.createDataFrame([(dt.date(2026, 3, 25), Decimal("100.50")), (dt.date(2026, 3, 26), Decimal("900"))],
                                 "dt date, revenue decimal(14,2)")
    checks = [("revenue", 100, 0.01)]
    row = Q.dq_tolerance_check(mart, "2026-03-25", checks).first()
    assert (row.actual, row.passed) == (Decimal("100.50"), True)
    row = Q.dq_tolerance_check(mart, "2026-03-27", checks).first()
    assert (row.actual, row.passed) == (None, False)


def test_waterfall_by_line_kind(spark):
    from types import SimpleNamespace

    from ledgerlake.plans import quality as Q
    columns = sorted({c for m in Q.WATERFALL_COLUMNS.values() for c in m})
    bill = [{c: "0" for c in columns} | {"platform": p, "shop_id": "s", "order_type": t, "receivable": a,
                                         "settlement": a, "goods": "7"}
            for p, t, a in (("mt", "外卖订单", "7"), ("mt", "赔付扣款", "-3"), ("mt", "推广账户充值", "-100"),
                            ("mt", "新类型", "5"), ("el", None, "7"), ("el", "赔偿单", "4"))]
    v = SimpleNamespace(fin_bill=spark.createDataFrame(bill),
                        fin_line=spark.createDataFrame([("jd", "s", "新费用", "9")],
                                                       "platform string, shop_id string, fee_type string, amount string"))
    got = {r.platform: (r.payable, r.realised, r.unclassified) for r in Q.rule_waterfall(v).collect()}
    assert got == {"mt": (7, 4, 5), "el": (7, 11, None), "jd": (0, 0, 9)}


def test_subsidy_of_unknown_merchant_part_passes(spark):
    from ledgerlake.functions.cleaning import num_or_null
    df = spark.createDataFrame([("10", "10", "x")], "s string, j string, m string")
    assert df.select(R.subsidy_reason(num_or_null("s"), num_or_null("j"), num_or_null("m"))).first()[0] is None
