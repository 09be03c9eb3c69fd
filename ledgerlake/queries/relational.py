"""Joins (§2.4), aggregations (§2.5), windows (§2.6), sort / set operations (§2.7)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..catalog import money_all, query
from ..functions import cleaning as C
from ..operators.joins import prefix_join, resolve_alias
from ..oracle_sql import (ALIAS_PLATFORMS, D, INT_PROMO, INT_SHIP, MART_CTES,
                          MART_VIEWS, ORACLES, PENDING_TOTALS, SHEET, SHEET_VIEWS, STORE_OUT, TAKINGS,
                          clean, div_round2, gate, gate0, orders_cte, paren, pnorm, stores_cte,
                          strict, tnull)
from ..oracle_sql import D_END
from ..oracle_sql import reg as reg_windowed
from ..plans import models as M
from ..plans import recon as R
from ..plans import settlement as S
from .recon import EL_ITEMS, EL_LINES, EL_PLACED, SUBSIDY_TYPES, subsidies_cte

M2 = "DECIMAL(18,2)"
# generic operators run over whole tables: a window that holds every day
WINDOW = S.Window("1900-01-01", "2100-01-01")


def reg(name: str, views: list[str], sql: str) -> None:
    """Register an oracle whose shared parts carry the business window."""
    reg_windowed(name, views, sql.replace(D, WINDOW.d).replace(D_END, WINDOW.d_end))


# ---------------------------------------------------------------------------
# §2.4 joins
# ---------------------------------------------------------------------------
@query("join_inner_match")
def join_inner_match(v):
    """EL anchors ∩ per-order finance (inner join on the cleaned order number)."""
    j = S.el_anchor(v.order_export, WINDOW).join(S.el_finance(v.fin_bill, WINDOW), "order_no", "inner")
    return money_all(j)


reg("join_inner_match", SHEET_VIEWS, f"""WITH {orders_cte('el')}
SELECT order_no, shop_id AS platform_shop_id, shop_name AS platform_shop_name,
       CAST(settled AS {M2}) AS settlement_amt FROM orders WHERE matched""")


@query("join_anti_pending")
def join_anti_pending(v):
    """EL anchors without finance (anti join); null order numbers stay pending."""
    return S.el_anchor(v.order_export, WINDOW).join(S.el_finance(v.fin_bill, WINDOW), "order_no", "left_anti")


reg("join_anti_pending", SHEET_VIEWS, f"""WITH {orders_cte('el')}
SELECT order_no, shop_id AS platform_shop_id, shop_name AS platform_shop_name FROM orders WHERE NOT matched""")


@query("join_left_multikey")
def join_left_multikey(v):
    """Mart assembly: revenue ⟕ cost (dt, store, platform) ⟕ courier (dt, store)
    ⟕ promotion (dt, store, platform) ⟕ store reference (store)."""
    rev = M.int_platform_revenue(M.stg_wide_revenue(v.fin_bill), M.stg_multi_revenue(v.fin_bill),
                                 M.stg_long_fees(v.fin_line, v.order_export))
    keys3, keys2 = ["dt", "store_name", "platform"], ["dt", "store_name"]
    j = (rev.select(*keys3, "revenue")
         .join(M.int_item_cost(v.item_detail, v.sku_map), keys3, "left")
         .join(M.int_thirdparty_shipping(v.courier), keys2, "left")
         .join(M.int_promotion_cost(v.promo_typed, v.promo_text), keys3, "left")
         .join(v.store_ref.select(F.col("store_short_name").alias("store_name"), "daily_rent_labor"),
               "store_name", "left"))
    return money_all(j.select(*keys3, "revenue", "cost", "maiyatian_shipping", "promotion_cost",
                              "daily_rent_labor"))


reg("join_left_multikey", MART_VIEWS, f"""WITH {MART_CTES}
SELECT dt, store_name, platform, CAST(revenue AS {M2}) AS revenue, CAST(goods AS {M2}) AS cost,
  CAST(courier AS {M2}) AS maiyatian_shipping, CAST(promotion AS {M2}) AS promotion_cost,
  (SELECT CAST(MAX(daily_rent_labor) AS {M2}) FROM store_ref WHERE store_short_name = takings.store_name) AS daily_rent_labor
FROM takings LEFT JOIN charged USING (dt, store_name, platform)""")


@query("join_left_lookup")
def join_left_lookup(v):
    """Item lines ⟕ SKU map: price lookup, fanning out for multi-code SKUs."""
    i = v.item_detail
    j = i.join(v.sku_map, i["sku"] == v.sku_map["mini_code"], "left")
    return money_all(j.select("sku", "kingdee_code", "headquarters_price"))


reg("join_left_lookup", ["item_detail", "sku_map"], f"""
SELECT r.sku, sk.kingdee_code, CAST(sk.headquarters_price AS {M2}) AS headquarters_price
FROM item_detail r LEFT JOIN sku_map sk ON r.sku = sk.mini_code""")


@query("join_full_outer")
def join_full_outer(v):
    """EL settled-by-store ⟗ pending-by-store on the store label."""
    s = S.settle_by_store(S.match(v, WINDOW, "el"), v.store_alias, v.dim_store, "el")
    return s.select("store_label", "province", "order_cnt", "pending_cnt")


reg("join_full_outer", SHEET_VIEWS, f"""WITH {stores_cte('el')}
SELECT label AS store_label, province, settled_orders AS order_cnt, pending_orders AS pending_cnt FROM store""")


@query("join_or_alias")
def join_or_alias(v):
    """Shop keys of every platform's orders resolved through the alias dimension
    (id = id OR name = name OR bracket-normalised name = name; may fan out)."""
    out = None
    for p in S.PLATFORMS:
        keys = (v.order_export.where(F.col("platform") == p)
                .select(C.clean_text("shop_id").alias("platform_shop_id"),
                        C.clean_text("shop_name").alias("platform_shop_name")).distinct())
        r = resolve_alias(keys, v.store_alias, S.ALIAS_PLATFORMS[p]).select(F.lit(p).alias("platform"), "*")
        out = r if out is None else out.unionByName(r)
    return out


reg("join_or_alias", ["order_export", "store_alias"], " UNION ALL ".join(f"""
SELECT '{p}' AS platform, k.platform_shop_id, k.platform_shop_name, o2o.store_short_name
FROM (SELECT DISTINCT {clean('shop_id')} AS platform_shop_id, {clean('shop_name')} AS platform_shop_name
      FROM order_export WHERE platform = '{p}') k
LEFT JOIN store_alias o2o ON o2o.platform IN ({ALIAS_PLATFORMS[p]}) AND (
     CAST(o2o.platform_store_id AS VARCHAR) = k.platform_shop_id OR o2o.store_name = k.platform_shop_name
     OR {pnorm('o2o.store_name')} = {pnorm('k.platform_shop_name')})""" for p in ("mt", "el", "jd")))


@query("join_prefix")
def join_prefix(v):
    """Fixed-cost label ⟕ store whose short name equals or starts with the label."""
    ds = v.dim_store.select(F.col("store_short_name").alias("matched_store"))
    return prefix_join(v.fixed_cost.select("store_label"), ds, "store_label", "matched_store", "left")


reg("join_prefix", ["fixed_cost", "dim_store"], """
SELECT c.store_label, ds.store_short_name AS matched_store
FROM fixed_cost c LEFT JOIN dim_store ds
  ON ds.store_short_name = c.store_label OR starts_with(ds.store_short_name, c.store_label)""")


@query("join_semi_in")
def join_semi_in(v):
    """JD lines whose order is an hour-delivery bill and whose fee type is listed."""
    return money_all(R.jd_subsidies(v, WINDOW).select("order_no", "fee_type", "settled"))


reg("join_semi_in", SHEET_VIEWS, f"""WITH {subsidies_cte()}
SELECT order_no, fee_type, CAST(settled AS {M2}) AS settled FROM subsidies""")


@query("join_filter_keys")
def join_filter_keys(v):
    """EL finance rows restricted to the window's matched orders before aggregation."""
    matched = S.match(v, WINDOW, "el").where("matched").select("order_no")
    f = R.el_fin_rows(v.fin_bill, WINDOW)
    return money_all(f.join(matched, "order_no", "inner").select("order_no", "line_no", "settlement"))


reg("join_filter_keys", SHEET_VIEWS, f"""WITH {orders_cte('el')}
SELECT {clean('f.order_no')} AS order_no, CAST(f.line_no AS BIGINT) AS line_no,
       CAST({gate0('f.settlement', True)} AS {M2}) AS settlement
FROM fin_bill f JOIN (SELECT order_no FROM orders WHERE matched) k ON k.order_no = {clean('f.order_no')}
WHERE f.platform = 'el' AND f.dt >= DATE '{D}' - 120""")


def _orders_store(v):
    return S.orders_store(v, WINDOW)


@query("join_cross_scalar")
def join_cross_scalar(v):
    """Every store row with the window's total order count attached (scalar)."""
    ob = _orders_store(v)
    tot = ob.agg(F.coalesce(F.sum("order_cnt"), F.lit(0)).cast("bigint"))
    return ob.select("store_label", "order_cnt").withColumn("total_order_cnt", tot.scalar())


reg("join_cross_scalar", SHEET_VIEWS, f"""WITH {stores_cte()}, {SHEET}
SELECT store_label, order_cnt, CAST(SUM(order_cnt) OVER () AS BIGINT) AS total_order_cnt FROM sheet""")


@query("join_spine")
def join_spine(v):
    """Union of all platforms' store labels, each platform left-joined to it."""
    return _orders_store(v).select("store_label", "mt_order_cnt", "el_order_cnt", "jd_order_cnt")


reg("join_spine", SHEET_VIEWS, f"""WITH {stores_cte()}, {SHEET}
SELECT store_label, mt_order_cnt, el_order_cnt, jd_order_cnt FROM sheet""")


@query("scalar_subquery")
def scalar_subquery(v):
    """Uncorrelated counts as columns: pending orders per platform."""
    return S.pending_totals({p: S.match(v, WINDOW, p) for p in S.PLATFORMS})


reg("scalar_subquery", SHEET_VIEWS,
    f"WITH {orders_cte()}\nSELECT {PENDING_TOTALS} FROM orders")


# ---------------------------------------------------------------------------
# §2.5 aggregations
# ---------------------------------------------------------------------------
@query("agg_group_sum")
def agg_group_sum(v):
    """Courier cost summed per day × store (GROUP BY expression)."""
    return money_all(M.int_thirdparty_shipping(v.courier))


reg("agg_group_sum", MART_VIEWS, f"""WITH {INT_SHIP}
SELECT dt, store_name, CAST(maiyatian_shipping AS {M2}) AS maiyatian_shipping FROM ma""")


def _jd_amount_by_shop(v):
    f = v.fin_line.where(F.col("platform") == "jd")
    return f.select("shop_id", C.num_or_null("amount").alias("amount"))


@query("agg_abs_of_sum")
def agg_abs_of_sum(v):
    """Net first, then absolute: ABS(SUM(amount)) per JD shop."""
    return money_all(_jd_amount_by_shop(v).groupBy("shop_id").agg(F.abs(F.sum("amount")).alias("net_abs")))


reg("agg_abs_of_sum", ["fin_line"], f"""
SELECT shop_id, CAST(ABS(SUM({gate('amount')})) AS {M2}) AS net_abs FROM fin_line WHERE platform = 'jd'
GROUP BY shop_id""")


@query("agg_sum_of_abs")
def agg_sum_of_abs(v):
    """Absolute per row, then sum: SUM(ABS(amount)) per JD shop."""
    return money_all(_jd_amount_by_shop(v).groupBy("shop_id").agg(F.sum(F.abs("amount")).alias("gross_abs")))


reg("agg_sum_of_abs", ["fin_line"], f"""
SELECT shop_id, CAST(SUM(ABS({gate('amount')})) AS {M2}) AS gross_abs FROM fin_line WHERE platform = 'jd'
GROUP BY shop_id""")


@query("agg_count_distinct")
def agg_count_distinct(v):
    """Exact distinct orders per partition day × platform."""
    return v.fin_bill.groupBy("dt", "platform").agg(F.countDistinct("order_no").alias("orders"))


reg("agg_count_distinct", ["fin_bill"], """
SELECT dt, platform, COUNT(DISTINCT order_no) AS orders FROM fin_bill GROUP BY dt, platform""")


@query("agg_conditional_sum")
def agg_conditional_sum(v):
    """JD long fee lines → revenue / fee / shipping columns (conditional sums)."""
    return money_all(M.jd_revenue_agg(M.stg_long_fees(v.fin_line, v.order_export)))


reg("agg_conditional_sum", MART_VIEWS, f"""WITH {TAKINGS}
SELECT dt, platform, store_name, CAST(revenue AS {M2}) AS revenue, CAST(platform_fee AS {M2}) AS platform_fee,
       CAST(shipping AS {M2}) AS shipping, CAST(order_count AS BIGINT) AS order_count
FROM takings WHERE platform = '京东'""")


@query("agg_count_filter")
def agg_count_filter(v):
    """Per shop: EL lines whose receivable differs from the settlement by > 0.02."""
    f = v.fin_bill.where(F.col("platform") == "el")
    d = F.abs(C.num_or_zero("receivable") - C.num_or_zero("settlement"))
    return money_all(f.groupBy("shop_id").agg(F.count(F.lit(1)).alias("lines"),
                                              F.count_if(d > 0.02).alias("lines_off")))


reg("agg_count_filter", ["fin_bill"], f"""
SELECT shop_id, CAST(COUNT(*) AS BIGINT) AS lines,
       CAST(COUNT(*) FILTER (WHERE ABS({gate0('receivable')} - {gate0('settlement')}) > 0.02) AS BIGINT) AS lines_off
FROM fin_bill WHERE platform = 'el' GROUP BY shop_id""")


@query("agg_bool_or")
def agg_bool_or(v):
    """Per EL order: does any bill line carry a compensation order type."""
    f = v.fin_bill.where(F.col("platform") == "el")
    return f.groupBy(C.clean_text("order_no").alias("order_no")).agg(
        F.bool_or(F.coalesce(F.col("order_type"), F.lit("")).contains("赔偿")).alias("has_compensation"))


reg("agg_bool_or", ["fin_bill"], f"""
SELECT {clean('order_no')} AS order_no, BOOL_OR(COALESCE(order_type, '') LIKE '%赔偿%') AS has_compensation
FROM fin_bill WHERE platform = 'el' GROUP BY 1""")


@query("agg_having")
def agg_having(v):
    """JD finance per order; the null order key is excluded (HAVING … IS NOT NULL)."""
    return money_all(S.jd_finance(v.fin_line, WINDOW))


reg("agg_having", SHEET_VIEWS, f"""WITH {orders_cte('jd')}
SELECT order_no, CAST(settled AS {M2}) AS settlement_amt FROM finance""")


@query("agg_two_level")
def agg_two_level(v):
    """Courier legs → MAX per order → per partition day total / mean / orders."""
    c = v.courier.select("dt", C.trim_null("order_no").alias("order_no"),
                         C.num_strict("fee").alias("fee"), C.num_strict("dist_km").alias("dist_km"))
    per_order = c.groupBy("dt", "order_no").agg(F.max("fee").alias("fee"), F.max("dist_km").alias("dist_km"))
    day = per_order.groupBy("dt").agg(F.coalesce(F.sum("fee"), F.lit(0)).alias("total_fee"),
                                      F.coalesce(F.avg("dist_km"), F.lit(0)).alias("avg_dist_km"),
                                      F.countDistinct("order_no").alias("orders"))
    return money_all(day)


reg("agg_two_level", ["courier"], f"""
SELECT dt, CAST(COALESCE(SUM(fee), 0) AS {M2}) AS total_fee,
  CAST(COALESCE(CASE WHEN COUNT(dist_km) > 0 THEN {div_round2('SUM(dist_km)', 'COUNT(dist_km)')} END, 0)
       AS {M2}) AS avg_dist_km,
  CAST(COUNT(DISTINCT order_no) AS BIGINT) AS orders
FROM (SELECT dt, {tnull('order_no')} AS order_no, MAX({strict('fee')}) AS fee, MAX({strict('dist_km')}) AS dist_km
      FROM courier GROUP BY 1, 2) t GROUP BY dt""")


@query("agg_rollup_labels")
def agg_rollup_labels(v):
    """(label, province, city, type) groups collapsed to one row per label:
    MAX attributes, SUM measures (MT settled and pending)."""
    s = S.settle_by_store(S.match(v, WINDOW, "mt"), v.store_alias, v.dim_store, "mt")
    return money_all(s.select("store_label", "province", "city", "store_type", "order_cnt",
                              "settlement_amt", "pending_cnt"))


reg("agg_rollup_labels", SHEET_VIEWS, f"""WITH {stores_cte('mt')}
SELECT * EXCLUDE (rebate_amt, receipt_amt, rebate_per_order) FROM (SELECT {STORE_OUT} FROM store)""")


@query("agg_count_times_rate")
def agg_count_times_rate(v):
    """MT enterprise rebate: matched orders × the store's per-order rate (0 if none)."""
    s = S.settle_by_store(S.match(v, WINDOW, "mt"), v.store_alias, v.dim_store, "mt")
    return money_all(s.select("store_label", "order_cnt", "rebate_per_order", "rebate_amt", "receipt_amt"))


reg("agg_count_times_rate", SHEET_VIEWS, f"""WITH {stores_cte('mt')}
SELECT store_label, order_cnt, rebate_per_order, rebate_amt, receipt_amt FROM (SELECT {STORE_OUT} FROM store)""")


@query("agg_avg")
def agg_avg(v):
    """Mean courier distance per store, 0 when no distance parses."""
    c = v.courier.select(C.paren_extract("store").alias("store_name"), C.num_strict("dist_km").alias("d"))
    return money_all(c.groupBy("store_name").agg(F.coalesce(F.avg("d"), F.lit(0)).alias("avg_dist_km")))


reg("agg_avg", ["courier"], f"""
SELECT store_name, CAST(COALESCE(CASE WHEN COUNT(d) > 0 THEN {div_round2('SUM(d)', 'COUNT(d)')} END, 0)
                        AS {M2}) AS avg_dist_km
FROM (SELECT {paren('store')} AS store_name,
             {strict('dist_km')} AS d FROM courier) t GROUP BY store_name""")


@query("agg_global_recon")
def agg_global_recon(v):
    """Whole EL finance table in one row: Σ settlement, Σ rebuilt, Σ|diff|, rows off."""
    f = v.fin_bill.where(F.col("platform") == "el")
    comps = [C.num_or_zero(c) for c in R.EL_COMPONENTS]
    rebuilt = R.total(comps)
    return money_all(f.agg(F.count(F.lit(1)).alias("rows"),
                           *R.identity_measures(C.num_or_zero("settlement"), rebuilt, "el")))


_REB = " + ".join(gate0(c) for c in EL_ITEMS)
reg("agg_global_recon", ["fin_bill"], f"""
SELECT CAST(COUNT(*) AS BIGINT) AS rows, CAST(COALESCE(SUM(t), 0) AS {M2}) AS el_sum_target,
  CAST(COALESCE(SUM(r), 0) AS {M2}) AS el_sum_rebuilt,
  CAST(COALESCE(SUM(t), 0) - COALESCE(SUM(r), 0) AS {M2}) AS el_diff,
  CAST(COALESCE(SUM(ABS(t - r)), 0) AS {M2}) AS el_sum_abs_diff,
  CAST(COUNT(*) FILTER (WHERE ABS(t - r) > 0.02) AS BIGINT) AS el_rows_off
FROM (SELECT {gate0('settlement')} AS t, {_REB} AS r FROM fin_bill WHERE platform = 'el') x""")


@query("agg_distinct")
def agg_distinct(v):
    """Distinct cleaned order keys present in the EL finance export."""
    f = v.fin_bill.where(F.col("platform") == "el")
    return f.select(C.clean_text("order_no").alias("order_no")).where(F.col("order_no").isNotNull()).distinct()


reg("agg_distinct", ["fin_bill"], f"""
SELECT DISTINCT {clean('order_no')} AS order_no FROM fin_bill
WHERE platform = 'el' AND {clean('order_no')} IS NOT NULL""")


@query("agg_by_region")
def agg_by_region(v):
    """Store sheet summarised by province / city / store type (SUM measures,
    MAX of the repeated global counts)."""
    s = S.daily_store_aggregate(v, WINDOW)
    g = s.groupBy("report_date", "province", "city", "store_type").agg(
        *[F.sum(c).alias(c) for c in ("settlement_amt", "zh_cost_total", "freight_total_alloc", "order_cnt",
                                       "rent_util_labor_fixed", "promo_spend")],
        *[F.max(c).alias(c) for c in ("mt_pending_fin_match_total", "ele_pending_fin_match_total",
                                       "jd_pending_fin_match_total")])
    return money_all(g)


# ---------------------------------------------------------------------------
# §2.6 windows
# ---------------------------------------------------------------------------
@query("win_row_number_first")
def win_row_number_first(v):
    """First platform of each store-day by order count desc, platform asc."""
    rev = M.int_platform_revenue(M.stg_wide_revenue(v.fin_bill), M.stg_multi_revenue(v.fin_bill),
                                 M.stg_long_fees(v.fin_line, v.order_export))
    w = Window.partitionBy("dt", "store_name").orderBy(F.desc("order_count"), F.asc("platform"))
    return rev.select("dt", "store_name", "platform", "order_count",
                      (F.row_number().over(w) == 1).alias("charges_rent"))


reg("win_row_number_first", MART_VIEWS, f"""WITH {TAKINGS}
SELECT dt, store_name, platform, order_count,
  platform IS NOT DISTINCT FROM FIRST(platform ORDER BY order_count DESC, platform) OVER (PARTITION BY dt, store_name) AS charges_rent
FROM takings""")


@query("win_global_row_number")
def win_global_row_number(v):
    """Line numbers within each EL order: bill date (nulls last), day, line."""
    return money_all(R.recon_order_lines(v, WINDOW).select("order_no", "line_seq", "dt", "bill_date"))


reg("win_global_row_number", SHEET_VIEWS, f"""WITH {EL_LINES}
SELECT order_no, CAST(ROW_NUMBER() OVER (PARTITION BY order_no ORDER BY CAST(bill_date AS DATE) NULLS LAST,
  dt, line_no, {", ".join(f"{c} NULLS LAST" for c in ["settlement", "receivable", "net_sales", "service_fee"]
                          + EL_ITEMS)}) AS BIGINT) AS line_seq, dt, bill_date
FROM el_lines""")


@query("win_distinct_on")
def win_distinct_on(v):
    """Latest MT bill row per order (DISTINCT ON, bill date desc nulls last)."""
    return money_all(S.mt_finance(v.fin_bill, WINDOW))


reg("win_distinct_on", SHEET_VIEWS, f"""WITH {orders_cte('mt')}
SELECT order_no, CAST(settled AS {M2}) AS settlement_amt FROM finance""")


# ---------------------------------------------------------------------------
# §2.7 sort / limit / set operations
# ---------------------------------------------------------------------------
@query("sort_report")
def sort_report(v):
    """The store sheet ordered by province, city, store type, label."""
    return S.daily_store_aggregate(v, WINDOW).orderBy("province", "city", "store_type", "store_label")


@query("sort_abs_desc")
def sort_abs_desc(v):
    """Per EL shop: Σ receivable vs Σ settlement, largest absolute gap first."""
    f = v.fin_bill.where(F.col("platform") == "el")
    g = f.groupBy("shop_id").agg(F.sum(C.num_or_null("receivable")).alias("receivable"),
                                 F.sum(C.num_or_null("settlement")).alias("settlement"),
                                 F.count(F.lit(1)).alias("n"))
    g = g.withColumn("gap", F.col("settlement") - F.col("receivable"))
    return money_all(g.orderBy(F.desc_nulls_last(F.abs("gap")), F.desc("n")))


reg("sort_abs_desc", ["fin_bill"], f"""
SELECT shop_id, CAST(SUM({gate('receivable')}) AS {M2}) AS receivable,
       CAST(SUM({gate('settlement')}) AS {M2}) AS settlement, CAST(COUNT(*) AS BIGINT) AS n,
       CAST(SUM({gate('settlement')}) - SUM({gate('receivable')}) AS {M2}) AS gap
FROM fin_bill WHERE platform = 'el' GROUP BY shop_id
ORDER BY ABS(SUM({gate('settlement')}) - SUM({gate('receivable')})) DESC NULLS LAST, n DESC""")


@query("topk_mismatch")
def topk_mismatch(v):
    """The 50 EL orders with the largest |order receivable − finance receivable|
    (ties by order number)."""
    a = R.el_order_anchor_all(v.order_export, WINDOW)
    f = R.el_fin_rows(v.fin_bill, WINDOW).groupBy("order_no").agg(F.sum("receivable").alias("fin_receivable"))
    m = a.join(f, "order_no", "inner").withColumn(
        "order_amt", C.refund_clamp(F.col("is_cancel_or_full_refund"), F.col("order_receivable")))
    m = m.withColumn("diff", F.coalesce("order_amt", F.lit(0)) - F.col("fin_receivable"))
    top = m.orderBy(F.desc(F.abs("diff")), F.asc("order_no")).limit(50)
    return money_all(top.select("order_no", "order_amt", "fin_receivable", "diff"))


@query("set_union_all")
def set_union_all(v):
    """Typed MT promotion ∪ALL text EL promotion (same columns)."""
    return money_all(M.int_promotion_cost(v.promo_typed, v.promo_text))


reg("set_union_all", MART_VIEWS, f"""WITH {INT_PROMO}
SELECT dt, platform, store_name, CAST(promotion_cost AS {M2}) AS promotion_cost FROM pr""")


@query("set_union_distinct")
def set_union_distinct(v):
    """De-duplicated store spine of the three platforms (nulls equal)."""
    by = S.store_rollups(v, WINDOW)[1]
    spine = None
    for df in by.values():
        spine = df.select("store_label") if spine is None else spine.union(df.select("store_label"))
    return spine.distinct()


reg("set_union_distinct", SHEET_VIEWS, f"""WITH {stores_cte()}
SELECT DISTINCT label AS store_label FROM store""")


@query("arr_unnest")
def arr_unnest(v):
    """The literal subsidy fee-type list as rows, with its JD line counts."""
    types = v.spark.range(1).select(F.explode(F.array(*[F.lit(t) for t in R.SUBSIDY_FEE_TYPES])).alias("fee_type"))
    counts = (v.fin_line.where(F.col("platform") == "jd").groupBy(C.clean_text("fee_type").alias("fee_type"))
              .agg(F.count(F.lit(1)).alias("lines")))
    return types.join(counts, "fee_type", "left").select("fee_type",
                                                         F.coalesce("lines", F.lit(0)).cast("bigint").alias("lines"))


reg("arr_unnest", ["fin_line"], f"""
SELECT t.fee_type, CAST(COALESCE(c.lines, 0) AS BIGINT) AS lines
FROM (SELECT unnest({SUBSIDY_TYPES}) AS fee_type) t
LEFT JOIN (SELECT {clean('fee_type')} AS fee_type, COUNT(*) AS lines FROM fin_line WHERE platform = 'jd'
           GROUP BY 1) c ON c.fee_type = t.fee_type""")


# oracles composed from the store-sheet oracle
_SHEET = ORACLES["daily_store_aggregate"]
reg("sort_report", [], _SHEET)
reg("agg_by_region", [], f"""
SELECT report_date, province, city, store_type,
  CAST(SUM(settlement_amt) AS {M2}) AS settlement_amt, CAST(SUM(zh_cost_total) AS {M2}) AS zh_cost_total,
  CAST(SUM(freight_total_alloc) AS {M2}) AS freight_total_alloc, CAST(SUM(order_cnt) AS BIGINT) AS order_cnt,
  CAST(SUM(rent_util_labor_fixed) AS {M2}) AS rent_util_labor_fixed, CAST(SUM(promo_spend) AS {M2}) AS promo_spend,
  CAST(MAX(mt_pending_fin_match_total) AS BIGINT) AS mt_pending_fin_match_total,
  CAST(MAX(ele_pending_fin_match_total) AS BIGINT) AS ele_pending_fin_match_total,
  CAST(MAX(jd_pending_fin_match_total) AS BIGINT) AS jd_pending_fin_match_total
FROM ({_SHEET}) x GROUP BY 1, 2, 3, 4""")

reg("topk_mismatch", SHEET_VIEWS, f"""WITH {EL_PLACED}, {EL_LINES},
m AS (
  SELECT order_no, CASE WHEN void THEN LEAST(COALESCE(listed, 0), 0) ELSE listed END AS order_amt,
         (SELECT SUM(receivable) FROM el_lines l WHERE l.order_no = p.order_no) AS fin_receivable
  FROM el_placed p WHERE order_no IN (SELECT order_no FROM el_lines))
SELECT order_no, CAST(order_amt AS {M2}) AS order_amt, CAST(fin_receivable AS {M2}) AS fin_receivable,
       CAST(COALESCE(order_amt, 0) - fin_receivable AS {M2}) AS diff
FROM m ORDER BY ABS(COALESCE(order_amt, 0) - fin_receivable) DESC, order_no ASC LIMIT 50""")
