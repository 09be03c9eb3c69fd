"""Queries of the ad-hoc daily store sheet (settlement matching and rollups)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..plans import settlement as S

# Business window of the registered queries.  The reference runs one day; the
# test tables hold ~10 orders per day, so the registered queries take a year
# (one that contains the promotion export's month).
WINDOW = S.Window("1999-07-01", "2000-07-01")
MONEY = "decimal(18,2)"


def _match_out(m):
    return m.select("order_no", "platform_shop_id", "platform_shop_name",
                    F.col("settlement_amt").cast(MONEY).alias("settlement_amt"), "matched")


@query("match_mt")
def match_mt(v):
    """MT: anchors of the window vs latest finance bill per order (matched flag)."""
    return _match_out(S.match(v, WINDOW, "mt"))


@query("match_el")
def match_el(v):
    """EL: anchors vs Σ order receivable per order over the lookback window."""
    return _match_out(S.match(v, WINDOW, "el"))


@query("match_jd")
def match_jd(v):
    """JD: anchors vs Σ settlement amount per order over the lookback window."""
    return _match_out(S.match(v, WINDOW, "jd"))


def _by_store_out(df):
    return df.select("store_label", "province", "city", "store_type", "order_cnt",
                     F.col("settlement_amt").cast(MONEY).alias("settlement_amt"),
                     F.col("rebate_amt").cast(MONEY).alias("rebate_amt"),
                     F.col("receipt_amt").cast(MONEY).alias("receipt_amt"),
                     F.col("rebate_per_order").cast(MONEY).alias("rebate_per_order"),
                     "pending_cnt")


@query("settle_by_store")
def settle_by_store(v):
    """Settled + pending orders of all three platforms by resolved store label."""
    out = None
    for p in S.PLATFORMS:
        df = _by_store_out(S.settle_by_store(S.match(v, WINDOW, p), v.store_alias, v.dim_store, p))
        df = df.select(F.lit(p).alias("platform"), "*")
        out = df if out is None else out.unionByName(df)
    return out


@query("pending_totals")
def pending_totals(v):
    """Pending anchor counts per platform (one row)."""
    return S.pending_totals({p: S.match(v, WINDOW, p) for p in S.PLATFORMS})


@query("orders_by_store")
def orders_by_store(v):
    """Cross-platform store spine with order counts and settlement totals."""
    ob = S.orders_store(v, WINDOW)
    return ob.select(*[F.col(c).cast(MONEY).alias(c) if t.startswith("decimal") else F.col(c)
                       for c, t in ob.dtypes])


@query("freight_allocate")
def freight_allocate(v):
    """Window courier freight allocated to stores by order count."""
    ob = S.orders_store(v, WINDOW)
    fa = S.freight_allocate(ob, S.freight_day(v.courier, WINDOW))
    return fa.select("store_label", "order_cnt",
                     F.col("freight_alloc").cast(MONEY).alias("freight_alloc"),
                     F.col("freight_per_order").cast(MONEY).alias("freight_per_order"))


@query("freight_day")
def freight_day(v):
    """Courier totals of the window (two-level aggregate: MAX per order, then day)."""
    fd = S.freight_day(v.courier, WINDOW)
    return fd.select(F.col("total_freight").cast(MONEY).alias("total_freight"),
                     F.col("avg_dist_km").cast(MONEY).alias("avg_dist_km"), "myt_order_cnt")


@query("promo_by_store")
def promo_by_store(v):
    """Cash promotion spend per resolved store label."""
    pm = S.promo_by_store(v.promo_text, v.store_alias, v.dim_store, WINDOW)
    return pm.select("store_label", F.col("promo_spend").cast(MONEY).alias("promo_spend"))


@query("fixed_cost_enrich")
def fixed_cost_enrich(v):
    """Fixed cost labels with attributes of equal-or-prefix stores."""
    fe = S.fixed_cost_enrich(v.fixed_cost, v.dim_store)
    return fe.select("store_label", "province", "city", "store_type",
                     F.col("rent_util_labor_fixed").cast(MONEY).alias("rent_util_labor_fixed"))


@query("daily_store_aggregate")
def daily_store_aggregate(v):
    """The store sheet of the window (28 columns)."""
    return S.daily_store_aggregate(v, WINDOW)
