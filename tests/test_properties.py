"""Properties of the jobs on the test tables (SURVEY §5 (3))."""

from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.functions import cleaning as C
from ledgerlake.plans import models as M
from ledgerlake.plans import settlement as S
from ledgerlake.sources.testdata import Views

SF = "/root/testdata/sf0.001"
W = S.Window("1996-01-01", "2001-01-01")


@pytest.fixture(scope="module")
def views(spark):
    return Views(spark, SF)


def test_rent_charged_once_per_store_day(views):
    mart = M.build_mart(views)
    got = mart.agg(F.sum("rent_labor_allocated")).first()[0]
    want = mart.select("dt", "store_name", "rent_labor").distinct().agg(F.sum("rent_labor")).first()[0]
    assert got == want


def test_matched_plus_pending_equals_anchors(views):
    for p in S.PLATFORMS:
        m = S.match(views, W, p)
        anchors = {"mt": S.mt_anchor(views.product_lines, W), "el": S.el_anchor(views.order_export, W),
                   "jd": S.jd_anchor(views.order_export, W)}[p]
        c = m.groupBy("matched").count().collect()
        assert sum(r["count"] for r in c) == anchors.count()


def test_freight_allocation_sums_to_total(views):
    ob = S.orders_by_store(S.store_rollups(views, W)[1])
    fd = S.freight_day(views.courier, W)
    fa = S.freight_allocate(ob, fd)
    total = fd.first()["total_freight"]
    alloc = fa.agg(F.sum("freight_alloc")).first()[0]
    assert abs(Decimal(alloc) - Decimal(total)) < Decimal("0.0001") * max(1, ob.count())


def test_store_sheet_order_count_matches_platforms(views):
    sheet = S.daily_store_aggregate(views, W)
    r = sheet.agg(F.sum("order_cnt"), F.sum(F.col("mt_order_cnt") + F.col("mt_pending_fin_cnt")
                                            + F.col("ele_order_cnt") + F.col("ele_pending_fin_cnt")
                                            + F.col("jd_order_cnt") + F.col("jd_pending_fin_cnt"))).first()
    assert r[0] == r[1]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.-e ,\t计", max_size=8), min_size=1, max_size=6))
def test_gate_never_wider_than_regex(spark, texts):
    import re
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r[0] for r in df.select(C.num_or_null("x")).collect()]
    for t, g in zip(texts, got):
        s = t.strip(" ")
        ok = re.fullmatch(r"-?[0-9]+(\.[0-9]*)?", s) is not None and len(s.split(".")[0].lstrip("-")) <= 14
        if g is not None:
            assert re.fullmatch(r"-?[0-9]+(\.[0-9]*)?", s)
        elif ok:
            raise AssertionError(f"{t!r} should parse")
