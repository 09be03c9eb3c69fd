"""Data-quality (§2.9) and documented-rule (§2.10) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import money_all, query
from ..oracle_sql import (D, MART_CTES, MART_VIEWS, SHEET_VIEWS, clean, gate, gate0, in_win, orders_cte, paren,
                          reg, strict)
from ..plans import models as M
from ..plans import quality as Q
from ..sources import export_fixtures as X
from ..sources import ledger as L
from ..sources import split_files as SF
from .recon import EL_LINES, EL_PLACED
from .settlement import WINDOW

M2 = "DECIMAL(18,2)"
AS_OF_EVENTS = "2024-02-01 00:00:00"
AS_OF_ORDERS = "2001-08-01"

def _mart_oracle(body: str) -> str:
    return f"WITH {MART_CTES}\n{body}"


# ---------------------------------------------------------------------------
# §2.9
# ---------------------------------------------------------------------------
@query("dq_not_null")
def dq_not_null(v):
    """Null dt / platform / store_name rows in the mart (one pass)."""
    return money_all(Q.dq_not_null(M.build_mart(v)))


reg("dq_not_null", MART_VIEWS, _mart_oracle("""SELECT column_name, CAST(failing_rows AS BIGINT) AS failing_rows FROM (
  SELECT 'dt' AS column_name, COUNT(*) FILTER (WHERE dt IS NULL) AS failing_rows FROM pnl
  UNION ALL SELECT 'platform', COUNT(*) FILTER (WHERE platform IS NULL) FROM pnl
  UNION ALL SELECT 'store_name', COUNT(*) FILTER (WHERE store_name IS NULL) FROM pnl) t"""))


@query("dq_freshness")
def dq_freshness(v):
    """Latest event time per event type vs the reference time: ok / warn / error."""
    return Q.dq_freshness(v.events, "ts", AS_OF_EVENTS, by="event_type")


reg("dq_freshness", [], f"""
SELECT event_type, max_load_time,
  CAST(floor((epoch(TIMESTAMP '{AS_OF_EVENTS}') - epoch(max_load_time)) / 3600.0) AS BIGINT) AS age_hours,
  CASE WHEN max_load_time IS NULL THEN 'error'
       WHEN (epoch(TIMESTAMP '{AS_OF_EVENTS}') - epoch(max_load_time)) / 3600.0 > 72 THEN 'error'
       WHEN (epoch(TIMESTAMP '{AS_OF_EVENTS}') - epoch(max_load_time)) / 3600.0 > 48 THEN 'warn'
       ELSE 'ok' END AS status
FROM (SELECT event_type, MAX(ts) AS max_load_time FROM events GROUP BY event_type) t""")


@query("load_ledger")
def load_ledger(v):
    """Order exports loaded by platform at set times, then once more: files,
    rows and freshness per target from the load ledger, and what the second
    load found."""
    root = X.new_root(v.spark)
    X.export_csv(v, root)
    again = 0
    for plat, when in (("mt", "2024-01-31 12:00:00"), ("el", "2024-01-29 06:00:00"), ("jd", "2024-01-20 00:00:00")):
        for turn in range(2):
            entry = L.load(v.spark, f"{root}/csv/platform={plat}", f"{root}/ods_{plat}", f"{root}/ledger",
                           lambda paths: SF.read_csv(v.spark, paths, declared="GBK").drop("_source_file"), f"ods_{plat}_order", when, "*.csv")
            again += entry.count() if turn else 0
    done = L.current(L.read_ledger(v.spark, f"{root}/ledger"))
    sums = done.groupBy("target").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))
    fresh = Q.dq_freshness(done.withColumn("load_time", F.col("load_time").cast("timestamp_ntz")), "load_time", AS_OF_EVENTS, by="target")
    return sums.join(fresh, "target").withColumn("found_again", F.lit(again).cast("bigint"))


reg("load_ledger", ["order_export"], """
SELECT 'ods_' || platform || '_order' AS target, COUNT(DISTINCT shop_id) AS files, COUNT(*) AS rows, t AS max_load_time,
       CAST(floor(date_diff('second', t, TIMESTAMP '2024-02-01 00:00:00') / 3600) AS BIGINT) AS age_hours,
       CASE WHEN t < TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 72 HOUR THEN 'error'
            WHEN t < TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 48 HOUR THEN 'warn' ELSE 'ok' END AS status,
       CAST(0 AS BIGINT) AS found_again
FROM order_export JOIN (VALUES ('mt', TIMESTAMP '2024-01-31 12:00:00'), ('el', TIMESTAMP '2024-01-29 06:00:00'),
                               ('jd', TIMESTAMP '2024-01-20 00:00:00')) w(platform, t) USING (platform)
GROUP BY platform, t""")


@query("dq_unmatched_store")
def dq_unmatched_store(v):
    """Mart stores with no store reference."""
    return Q.dq_unmatched_store(M.build_mart(v))


reg("dq_unmatched_store", MART_VIEWS, _mart_oracle(
    "SELECT store_name, COUNT(*) AS mart_rows FROM pnl WHERE NOT has_store_ref GROUP BY store_name"))


@query("dq_load_summary")
def dq_load_summary(v):
    """Typed promotion table: rows and amount per loaded day, and a sample of
    the loaded stores."""
    return money_all(Q.dq_load_summary(v.promo_typed, "amount", key_col="store_id"))


reg("dq_load_summary", ["promo_typed"], f"""
SELECT dt, CAST(COUNT(*) AS BIGINT) AS rows, CAST(COALESCE(SUM(amount), 0) AS {M2}) AS amount,
       array_to_string(list_transform(list_sort(list(DISTINCT md5(CAST(store_id AS VARCHAR)) || ':' || store_id))[1:5],
                                      lambda x: split_part(x, ':', 2)), ',') AS sample
FROM promo_typed GROUP BY dt""")


@query("dq_tolerance_check")
def dq_tolerance_check(v):
    """One day's mart totals vs the hand-checked figures with their tolerances."""
    return Q.dq_tolerance_check(M.build_mart(v), D)


# fixed values, from the document: measure, figure of the day, tolerance
reg("dq_tolerance_check", MART_VIEWS, _mart_oracle(f"""
SELECT DATE '{D}' AS dt, measure, CAST(actual AS {M2}) AS actual, CAST(expected AS {M2}) AS expected,
       CAST(tolerance AS DECIMAL(6,4)) AS tolerance,
       COALESCE(actual BETWEEN expected * (1 - tolerance) AND expected * (1 + tolerance), FALSE) AS passed
FROM (VALUES ('revenue', 81152, 0.01), ('cost', 53324, 0.01), ('gross_profit', 21216, 0.01),
             ('rent_labor_allocated', 18623, 0.00), ('net_profit', 2592, 0.05)) e(measure, expected, tolerance)
JOIN (SELECT measure, actual
      FROM (SELECT SUM(revenue) AS revenue, SUM(cost) AS cost, SUM(gross_profit) AS gross_profit,
                   SUM(rent_labor_allocated) AS rent_labor_allocated, SUM(net_profit) AS net_profit
            FROM pnl WHERE dt = DATE '{D}')
      UNPIVOT INCLUDE NULLS (actual FOR measure IN (revenue, cost, gross_profit, rent_labor_allocated, net_profit))
     ) t USING (measure)"""))


# ---------------------------------------------------------------------------
# §2.10
# ---------------------------------------------------------------------------
@query("rule_all_txn_match")
def rule_all_txn_match(v):
    """Matched EL orders valued over all their finance rows."""
    return money_all(Q.rule_all_txn_match(v, WINDOW))


reg("rule_all_txn_match", SHEET_VIEWS, f"""WITH {orders_cte('el')}, {EL_LINES}
SELECT order_no, COUNT(*) AS txn_rows, CAST(SUM(settlement) AS {M2}) AS settlement_sum,
       COUNT(DISTINCT order_type) AS txn_types
FROM el_lines SEMI JOIN orders USING (order_no) GROUP BY order_no""")

_CLASSIFIED = f"""{orders_cte('el')}, {EL_PLACED},
cls AS (
  SELECT *, CASE WHEN kind LIKE '%充值%' THEN 'top_up'
                 WHEN order_no IS NULL OR amt IS NULL THEN 'other'
                 WHEN order_no IN (SELECT o.order_no FROM orders o WHERE o.order_no IS NOT NULL) THEN 'matched'
                 WHEN order_no IN (SELECT e.order_no FROM el_placed e WHERE e.order_no IS NOT NULL)
                   THEN IF(amt < 0, 'same_day_refund', 'other')
                 ELSE IF(amt < 0, 'delayed_refund', 'cross_day') END AS row_class
  FROM (SELECT {clean('order_no')} AS order_no, shop_id, COALESCE({clean('order_type')}, '') AS kind,
               {gate('receivable', strip_tabs=True)} AS amt
        FROM fin_bill WHERE platform = 'el' AND {in_win('dt')}))"""


@query("rule_cross_day_class")
def rule_cross_day_class(v):
    """Window finance rows by class with row counts and amounts."""
    return money_all(Q.rule_cross_day_class(v, WINDOW))


reg("rule_cross_day_class", SHEET_VIEWS, f"""WITH {_CLASSIFIED}
SELECT row_class, CAST(COUNT(*) AS BIGINT) AS rows, CAST(COALESCE(SUM(amt), 0) AS {M2}) AS amount
FROM cls GROUP BY row_class""")


@query("rule_delayed_refund")
def rule_delayed_refund(v):
    """Refunds of orders placed before the window: separate bucket per shop."""
    return money_all(Q.rule_delayed_refund(v, WINDOW))


reg("rule_delayed_refund", SHEET_VIEWS, f"""WITH {_CLASSIFIED}
SELECT shop_id, CAST(COUNT(*) AS BIGINT) AS refund_rows, CAST(SUM(amt) AS {M2}) AS delayed_refund_amt
FROM cls WHERE row_class = 'delayed_refund' GROUP BY shop_id""")


@query("rule_pending_by_store")
def rule_pending_by_store(v):
    """Pending orders per platform and store with count and order amount."""
    return money_all(Q.rule_pending_by_store(v, WINDOW))


reg("rule_pending_by_store", SHEET_VIEWS, f"""WITH {orders_cte()},
listed AS (SELECT platform, {clean('order_no')} AS order_no, MAX({gate('receivable', strip_tabs=True)}) AS amount
           FROM order_export WHERE {in_win('dt')} GROUP BY ALL)
SELECT platform, {paren('shop_name')} AS store_name, COUNT(*) AS pending_orders,
       CAST(COALESCE(SUM(amount), 0) AS {M2}) AS pending_amount
FROM orders LEFT JOIN listed USING (platform, order_no) WHERE NOT matched GROUP BY ALL""")


@query("rule_missing_batch")
def rule_missing_batch(v):
    """Platform order days ≥ 3 days old whose orders have no finance row at all."""
    return money_all(Q.rule_missing_batch(v, AS_OF_ORDERS))


reg("rule_missing_batch", ["order_export", "fin_bill", "fin_line"], f"""
WITH fin_keys AS (
  SELECT DISTINCT platform, order_no FROM (
    SELECT platform, {clean('order_no')} AS order_no FROM fin_bill WHERE platform IN ('mt', 'el')
    UNION ALL SELECT platform, {clean('order_no')} FROM fin_line WHERE platform = 'jd') t
  WHERE order_no IS NOT NULL)
SELECT o.platform, o.dt, CAST(COUNT(*) AS BIGINT) AS orders,
       CAST(COUNT(f.order_no) AS BIGINT) AS orders_with_finance
FROM (SELECT platform, dt, {clean('order_no')} AS order_no FROM order_export) o
LEFT JOIN fin_keys f ON f.platform = o.platform AND f.order_no = o.order_no
WHERE o.dt <= DATE '{AS_OF_ORDERS}' - 3
GROUP BY o.platform, o.dt HAVING COUNT(f.order_no) = 0""")


@query("rule_unknown_fee_type")
def rule_unknown_fee_type(v):
    """JD fee types outside the classification (alert rows)."""
    return money_all(Q.rule_unknown_fee_type(v))


# fixed values, from the document: the fee types of each bucket
_BUCKETS = {
    "goods": ["用户实付货款"],
    "activity_subsidy": ["优惠券-平台-小时购", "优惠券-京东平台-小时购", "京豆-平台-小时达", "积分-平台-小时购"],
    "merchant_subsidy": ["商家券", "账扣款", "限时抢购商家"],
    "packaging": ["到家包装费", "包装费"],
    "freight": ["基础配送费", "商家承担远距离运费", "满减运费", "秒送基础服务费", "免运券"],
    "commission": ["代收到家佣金", "CPS推广服务费"],
}
_KNOWN = ", ".join(f"'{t}'" for types in _BUCKETS.values() for t in types)
reg("rule_unknown_fee_type", ["fin_line"], f"""
SELECT fee_type, CAST(COUNT(*) AS BIGINT) AS rows, CAST(COALESCE(SUM(amount), 0) AS {M2}) AS amount
FROM (SELECT {clean('fee_type')} AS fee_type, {gate('amount')} AS amount FROM fin_line WHERE platform = 'jd') t
WHERE fee_type IS NULL OR fee_type NOT IN ({_KNOWN}) GROUP BY fee_type""")


@query("rule_reserved_column")
def rule_reserved_column(v):
    """Reserved bill columns carrying non-zero values."""
    return money_all(Q.rule_reserved_column(v))


reg("rule_reserved_column", ["fin_bill"], " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT(*) FILTER (WHERE COALESCE({gate(c)}, 0) <> 0) AS BIGINT) "
    f"AS nonzero_rows FROM fin_bill" for c in ("box_fee", "bag_fee", "voucher")))


@query("rule_mt_rebuild")
def rule_mt_rebuild(v):
    """MT bill lines: receivable vs the component rebuild."""
    return money_all(Q.rule_mt_rebuild(v))


_MT_REB = " + ".join(f"COALESCE(CAST(NULLIF(NULLIF(TRIM({c}), ''), '-') AS DECIMAL(18,4)), 0)" for c in (
    "goods", "delivery_income", "box_fee", "bag_fee", "shop_goods_subsidy", "shop_delivery_subsidy",
    "shop_bag_subsidy", "coupon_shop", "commission", "delivery_fee", "delivery_rebate", "donation"))
reg("rule_mt_rebuild", ["fin_bill"], f"""
SELECT order_no, CAST(line_no AS BIGINT) AS line_no, CAST(receivable AS {M2}) AS receivable,
       CAST(rebuilt AS {M2}) AS rebuilt, CAST(receivable - rebuilt AS {M2}) AS diff
FROM (SELECT order_no, line_no, {strict('receivable')} AS receivable, {_MT_REB} AS rebuilt
      FROM fin_bill WHERE platform = 'mt') t""")


@query("rule_el_identity")
def rule_el_identity(v):
    """EL settlement identities over the whole finance export (one row)."""
    return money_all(Q.rule_el_identity(v))


reg("rule_el_identity", ["fin_bill"], f"""
SELECT CAST(s AS {M2}) AS sum_settlement, CAST(r AS {M2}) AS sum_receivable, CAST(c AS {M2}) AS sum_comp_settlement,
  CAST(n AS {M2}) AS sum_net_sales, CAST(f AS {M2}) AS sum_service_fee,
  CAST(s - r - c AS {M2}) AS gap_receivable_identity, CAST(s - n - f - c AS {M2}) AS gap_component_identity
FROM (SELECT SUM({gate0('settlement')}) AS s, SUM({gate0('receivable')}) AS r,
             SUM(CASE WHEN COALESCE(order_type, '') LIKE '%赔偿%' THEN {gate0('settlement')} ELSE 0 END) AS c,
             SUM({gate0('net_sales')}) AS n, SUM({gate0('service_fee')}) AS f
      FROM fin_bill WHERE platform = 'el') t""")


@query("rule_jd_fee_buckets")
def rule_jd_fee_buckets(v):
    """JD fee lines per shop pivoted into business buckets."""
    return money_all(Q.rule_jd_fee_buckets(v))


reg("rule_jd_fee_buckets", ["fin_line"], "SELECT shop_id, " + ", ".join(
    f"CAST(SUM(amount) FILTER (list_contains({types}, fee_type)) AS {M2}) AS {b}" for b, types in _BUCKETS.items())
    + f""", CAST(SUM(amount) FILTER (fee_type IS NULL OR fee_type NOT IN ({_KNOWN})) AS {M2}) AS unclassified
FROM (SELECT shop_id, {clean('fee_type')} AS fee_type, {gate('amount')} AS amount FROM fin_line WHERE platform = 'jd')
GROUP BY shop_id""")


@query("rule_waterfall")
def rule_waterfall(v):
    """MT and EL bill lines and JD fee lines on the level-1 P&L waterfall, per platform × shop."""
    return money_all(Q.rule_waterfall(v))


# fixed values, from the document: what each level holds, per platform — bill
# columns of ordinary lines, line types of the others, fee types
_BY_COLUMN = {
    "mt": {"list_price": ["goods"], "marketing_passive": ["commission"], "packaging": ["box_fee", "bag_fee"],
           "marketing_active": ["shop_goods_subsidy", "shop_delivery_subsidy", "shop_bag_subsidy", "coupon_shop"],
           "delivery": ["delivery_income", "delivery_fee", "delivery_rebate"], "other": ["donation"]},
    "el": {"list_price": ["goods"], "marketing_passive": ["commission", "pay_fee"], "packaging": ["box_fee"],
           "marketing_active": ["activity_subsidy", "coupon_subsidy", "discount_total"],
           "delivery": ["delivery_income", "shop_delivery_subsidy", "fulfil_fee", "delivery_fee", "rider_tip"]},
}
_BY_TYPE = {
    "mt": {"refund": ["订单退款", "订单部分退款", "部分退款", "部分退款冲抵"], "marketing_active": ["赏金联盟服务费"],
           "delivery": ["配送费用", "配送小费", "汽车送配送费"],
           "compensation": ["餐损赔付", "商服赔付", "合作商售后赔付"], "penalty": ["赔付扣款", "医药治理"],
           "other": ["保险"]},
    "el": {"refund": ["全部退单", "部分退单", "部分退款"], "compensation": ["赔偿单"], "other": ["售中逆向退"]},
    "jd": {"list_price": ["用户实付货款"],
           "marketing_active": ["优惠券-平台-小时购", "优惠券-京东平台-小时购", "京豆-平台-小时达", "积分-平台-小时购",
                                "商家券", "限时抢购商家"],
           "marketing_passive": ["代收到家佣金", "CPS推广服务费"],
           "delivery": ["基础配送费", "商家承担远距离运费"], "packaging": ["到家包装费", "包装费"]},
}
_PAYABLE = ["list_price", "refund", "marketing_active", "marketing_passive", "delivery", "packaging"]
_LEVELS = _PAYABLE + ["compensation", "penalty", "other"]
_PARTS = [f"""SELECT platform, shop_id, '{lv}' AS level1, {gate(c)} AS amount FROM bill
  WHERE platform = '{p}' AND kind IN ('', '外卖订单', '正常订单')"""
          for p in _BY_COLUMN for lv, cols in _BY_COLUMN[p].items() for c in cols]
_TYPE_CASE = "CASE " + " ".join(f"WHEN platform = '{p}' AND list_contains({types}, kind) THEN '{lv}'"
                                for p in _BY_TYPE for lv, types in _BY_TYPE[p].items()) + " ELSE 'unclassified' END"
reg("rule_waterfall", ["fin_bill", "fin_line"], f"""
WITH bill AS (SELECT *, COALESCE({clean('order_type')}, '') AS kind FROM fin_bill),
items AS (
  {" UNION ALL ".join(_PARTS)}
  UNION ALL
  SELECT platform, shop_id, {_TYPE_CASE}, IF(platform = 'mt', {gate('receivable')}, {gate('settlement')}) FROM bill
  WHERE platform IN ('mt', 'el')
    AND kind NOT IN ('', '外卖订单', '正常订单', '推广账户充值', '企客配送返款', '代充值预扣')
  UNION ALL
  SELECT platform, shop_id, {_TYPE_CASE}, amt
  FROM (SELECT platform, shop_id, {clean('fee_type')} AS kind, {gate('amount')} AS amt FROM fin_line WHERE platform = 'jd'))
SELECT platform, shop_id, {", ".join(f"CAST(SUM(amount) FILTER (level1 = '{lv}') AS {M2}) AS {lv}" for lv in _LEVELS + ["unclassified"])},
  CAST(COALESCE(SUM(amount) FILTER (list_contains({_PAYABLE}, level1)), 0) AS {M2}) AS payable,
  CAST(COALESCE(SUM(amount) FILTER (level1 <> 'unclassified'), 0) AS {M2}) AS realised
FROM items GROUP BY platform, shop_id""")


@query("rule_city_rebate")
def rule_city_rebate(v):
    """MT enterprise rebate per city: valid orders × city rate."""
    return money_all(Q.rule_city_rebate(v))


reg("rule_city_rebate", ["order_export", "dim_store"], f"""
WITH rates AS (SELECT city, MAX(meituan_enterprise_rebate) AS rate FROM dim_store GROUP BY city),
o AS (SELECT {paren(clean('shop_name'))} AS store_short_name,
             COALESCE({clean('status')} = '已取消' OR {clean('refund_status')} = '全部退款', FALSE) AS void
      FROM order_export WHERE platform = 'mt')
SELECT s.city, CAST(COUNT(*) FILTER (WHERE NOT o.void) AS BIGINT) AS valid_orders,
       CAST(SUM(CASE WHEN NOT o.void THEN COALESCE(r.rate, 0) ELSE 0 END) AS {M2}) AS rebate
FROM o JOIN dim_store s ON s.store_short_name = o.store_short_name LEFT JOIN rates r ON r.city = s.city
GROUP BY s.city""")
