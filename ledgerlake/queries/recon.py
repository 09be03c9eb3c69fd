"""Reconciliation queries (§2.8): identities of reported vs rebuilt settlement."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import money_all, query
from ..oracle_sql import (D, D_END, PENDING_TOTALS, SHEET_VIEWS, clean, gate, gate0, in_win, largest,
                          orders_cte, placed_day, reg, smallest)
from ..functions import cleaning as C
from ..plans import recon as R
from ..session import materialize
from ..sources import export_fixtures as X
from ..sources import files as FL
from .settlement import WINDOW

M2 = "DECIMAL(18,2)"

# Fixed values for the oracles, written out from the documents: the 15 items of
# an MT bill line, the 11 of an EL one, the platform-borne JD subsidy types.
MT_ITEMS = ["goods", "delivery_income", "box_fee", "bag_fee", "plat_goods_subsidy", "plat_delivery_subsidy",
            "plat_bag_subsidy", "shop_goods_subsidy", "shop_delivery_subsidy", "shop_bag_subsidy", "commission",
            "delivery_fee", "coupon_platform", "coupon_shop", "coupon_user"]
EL_ITEMS = ["goods", "delivery_income", "commission", "pay_fee", "activity_subsidy", "coupon_subsidy",
            "shop_delivery_subsidy", "fulfil_fee", "delivery_fee", "rider_tip", "discount_total"]
SUBSIDY_TYPES = ["优惠券-平台-小时购", "优惠券-京东平台-小时购", "京豆-平台-小时达", "积分-平台-小时购"]

_EL_FULL = " + ".join(EL_ITEMS)
_EL_NO_GOODS = " + ".join(EL_ITEMS[1:])

# EL finance lines of the lookback; an amount that doesn't parse is 0
EL_LINES = f"""el_lines AS (
  SELECT {clean('order_no')} AS order_no, line_no, dt, {clean('bill_date')} AS bill_date,
         {clean('order_type')} AS order_type, {clean('order_type')} LIKE '%赔偿%' AS compensates,
         {", ".join(f"{gate0(c, True)} AS {c}" for c in
                    ["receivable", "settlement", "net_sales", "service_fee"] + EL_ITEMS)}
  FROM fin_bill WHERE platform = 'el' AND dt >= DATE '{D}' - 120 AND {clean('order_no')} IS NOT NULL)"""

# EL orders placed in the window, void ones included, with the listed receivable
EL_PLACED = f"""el_placed AS (
  SELECT order_no, o.void AS void, o.listed AS listed
  FROM (SELECT {clean('order_no')} AS order_no, {smallest(
      seq='order_seq',
      void=f"COALESCE({clean('status')} = '已取消' OR {clean('refund_status')} = '全部退款', FALSE)",
      listed=gate('receivable', strip_tabs=True))} AS o
    FROM order_export
    WHERE platform = 'el' AND {in_win('dt')} AND {in_win(placed_day(clean('placed_at')))}
    GROUP BY ALL))"""


@query("recon_two_logic")
def recon_two_logic(v):
    """Reported vs component sums for matched MT / EL orders; JD matched total."""
    return money_all(R.recon_two_logic(v, WINDOW))


def _total(x: str) -> str:
    return f"CAST(COALESCE(SUM({x}), 0) AS {M2})"


def _off(a: str, b: str) -> str:
    return f"COUNT(*) FILTER (ABS({a} - ({b})) > 0.02)"


_MT_SUM = " + ".join(f"COALESCE(CAST(NULLIF({clean(c)}, '-') AS DECIMAL(18,4)), 0)" for c in MT_ITEMS)
_MT_KEY = {c: f"CAST(NULLIF({clean(c)}, '-') AS DECIMAL(18,4))" for c in MT_ITEMS}
_MT_PICK = largest(day=clean("bill_date"), target=f"CAST({clean('receivable')} AS DECIMAL(18,4))",
                   **_MT_KEY, rebuilt=f"({_MT_SUM})")
reg("recon_two_logic", SHEET_VIEWS, f"""WITH {orders_cte()}, {EL_LINES},
mt_bill AS (
  SELECT {clean('order_no')} AS order_no, {_MT_PICK} AS b FROM fin_bill
  WHERE platform = 'mt' AND dt >= DATE '{D}' - 120 AND COALESCE({clean('fin_status')}, '') <> '订单取消'
  GROUP BY ALL),
mt AS (SELECT b.target AS target, b.rebuilt AS rebuilt FROM mt_bill
       WHERE order_no IN (SELECT order_no FROM orders WHERE matched AND platform = 'mt')),
el AS (SELECT order_no, SUM(receivable) AS receivable, SUM(net_sales) AS net, SUM(settlement) AS settlement,
              SUM({_EL_FULL}) AS full_sum, SUM({_EL_NO_GOODS}) AS no_goods
       FROM el_lines WHERE order_no IN (SELECT order_no FROM orders WHERE matched AND platform = 'el')
       GROUP BY order_no)
SELECT DATE '{D}' AS report_date, * FROM
  (SELECT {PENDING_TOTALS}, COUNT(*) FILTER (platform = 'jd' AND matched) AS jd_matched_orders,
          CAST(COALESCE(SUM(settled) FILTER (platform = 'jd' AND matched), 0) AS {M2}) AS jd_sum_settlement_matched
   FROM orders),
  (SELECT COUNT(*) AS mt_matched_orders, {_total('target')} AS mt_sum_target, {_total('rebuilt')} AS mt_sum_rebuilt,
          CAST({_total('target')} - {_total('rebuilt')} AS {M2}) AS mt_diff,
          {_total('ABS(target - rebuilt)')} AS mt_sum_abs_diff, {_off('target', 'rebuilt')} AS mt_rows_off FROM mt),
  (SELECT COUNT(*) AS el_matched_orders, {_total('receivable')} AS el_sum_receivable,
          {_total('net')} AS el_sum_net_sales, {_total('settlement')} AS el_sum_settlement,
          {_total('full_sum')} AS el_sum_formula_full, {_total('no_goods')} AS el_sum_formula_no_goods,
          {_off('receivable', 'settlement')} AS el_orders_receivable_ne_settlement,
          {_off('net', 'settlement')} AS el_orders_net_ne_settlement,
          {_off('receivable', 'full_sum')} AS el_orders_receivable_ne_full,
          {_off('full_sum', 'settlement')} AS el_orders_full_ne_settlement,
          {_total('ABS(receivable - full_sum)')} AS el_sum_abs_receivable_vs_full FROM el)""")


@query("recon_order_vs_finance")
def recon_order_vs_finance(v):
    """EL orders of the window vs their finance lines: counts, sums, differences."""
    return money_all(R.recon_order_vs_finance(v, WINDOW))


reg("recon_order_vs_finance", SHEET_VIEWS, f"""WITH {EL_PLACED}, {EL_LINES},
billed AS (
  SELECT order_no, SUM(receivable) AS rec, SUM(net_sales) AS net, SUM(settlement) AS stl, SUM({_EL_FULL}) AS reb,
         COALESCE(SUM(settlement) FILTER (compensates), 0) AS comp
  FROM el_lines GROUP BY order_no),
met AS (
  SELECT void, COALESCE(listed, 0) AS raw,
         CASE WHEN void THEN LEAST(COALESCE(listed, 0), 0) ELSE COALESCE(listed, 0) END AS due, billed.*
  FROM el_placed JOIN billed USING (order_no))
SELECT DATE '{D}' AS report_date,
  (SELECT COUNT(*) FROM el_placed) AS anchor_orders,
  (SELECT COUNT(*) FILTER (void) FROM el_placed) AS anchor_cancelled_orders,
  (SELECT COUNT(*) FROM el_placed ANTI JOIN billed USING (order_no)) AS pending_orders,
  COUNT(*) AS matched_orders, COUNT(*) FILTER (void) AS cancelled_or_refunded_orders,
  {_total('due')} AS sum_order_receivable, {_total('raw')} AS sum_order_receivable_raw,
  {_total('rec')} AS sum_fin_receivable, {_total('net')} AS sum_fin_net_sales,
  {_total('stl')} AS sum_fin_settlement, {_total('reb')} AS sum_fin_rebuilt,
  {_total('comp')} AS sum_comp_settlement, {_total('stl - comp')} AS sum_noncomp_settlement,
  {_total('rec + comp')} AS sum_receivable_plus_comp,
  {_total('rec + comp - stl')} AS diff_receivable_plus_comp_minus_settlement,
  {_total('due - rec')} AS diff_order_minus_fin, {_total('rec - reb')} AS diff_receivable_minus_rebuilt,
  {_total('rec - stl')} AS diff_receivable_minus_settlement, {_total('reb - stl')} AS diff_rebuilt_minus_settlement,
  {_off('due', 'rec')} AS orders_order_ne_fin, {_off('raw', 'rec')} AS orders_raw_ne_fin,
  COUNT(*) FILTER (void AND ABS(due - rec) > 0.02) AS cancelled_orders_ne_fin,
  {_off('reb', 'stl')} AS orders_rebuilt_ne_settlement, {_off('rec', 'stl')} AS orders_receivable_ne_settlement,
  {_off('reb', 'rec')} AS orders_rebuilt_ne_receivable, {_total('ABS(due - rec)')} AS sum_abs_order_vs_fin
FROM met""")


@query("recon_by_type")
def recon_by_type(v):
    """Settlement − receivable by bill order type for matched EL orders, worst first."""
    return money_all(R.recon_by_type(v, WINDOW))


reg("recon_by_type", SHEET_VIEWS, f"""WITH {EL_PLACED}, {EL_LINES}
SELECT IFNULL(order_type, '(空)') AS order_type, COALESCE(BOOL_OR(compensates), FALSE) AS has_compensation_mark,
       COUNT(*) AS rows, {_total('settlement')} AS sum_settlement, {_total('receivable')} AS sum_receivable,
       {_total('settlement - receivable')} AS diff_settlement_minus_receivable
FROM el_lines SEMI JOIN el_placed USING (order_no) GROUP BY ALL""")


@query("recon_order_lines")
def recon_order_lines(v):
    """Every EL finance line of the window with its 11-component rebuild and diff."""
    return money_all(R.recon_order_lines(v, WINDOW))


reg("recon_order_lines", SHEET_VIEWS, f"""WITH {EL_LINES}
SELECT ROW_NUMBER() OVER (PARTITION BY order_no ORDER BY CAST(bill_date AS DATE) NULLS LAST,
                          dt, line_no, {", ".join(["settlement", "receivable", "net_sales", "service_fee"] + EL_ITEMS)})
       AS line_seq,
  order_no, dt, bill_date, {", ".join(f"CAST({c} AS {M2}) AS {c}" for c in EL_ITEMS)},
  CAST({_EL_FULL} AS {M2}) AS rebuilt_settlement, CAST(settlement AS {M2}) AS actual_settlement,
  CAST({_EL_FULL} - settlement AS {M2}) AS diff,
  CAST(net_sales + service_fee AS {M2}) AS net_plus_service, CAST(receivable AS {M2}) AS ref_receivable
FROM el_lines""")


@query("recon_order_total")
def recon_order_total(v):
    """Per EL order: Σ rebuilt vs Σ settlement vs Σ receivable."""
    return money_all(R.recon_order_total(v, WINDOW))


reg("recon_order_total", SHEET_VIEWS, f"""WITH {EL_LINES}
SELECT order_no, {_total(_EL_FULL)} AS sum_rebuilt, {_total('settlement')} AS sum_settlement,
  {_total('receivable')} AS sum_receivable, {_total(f'{_EL_FULL} - settlement')} AS diff_rebuilt_minus_settlement,
  {_total(f'{_EL_FULL} - receivable')} AS diff_rebuilt_minus_receivable
FROM el_lines GROUP BY order_no""")


@query("jd_store_settlement")
def jd_store_settlement(v):
    """Per JD store: distinct bills, fee lines, Σ settlement, latest store name."""
    return money_all(R.jd_store_settlement(v, WINDOW))


# the name is the least one of the shop's last day
reg("jd_store_settlement", SHEET_VIEWS, f"""WITH per_shop AS (
  SELECT {clean('shop_id')} AS store_id, COUNT(DISTINCT {clean('order_no')}) AS bills, COUNT(*) AS fee_lines,
         {_total(gate('amount', strip_tabs=True))} AS settlement_total
  FROM fin_line WHERE platform = 'jd' AND {in_win('dt')} GROUP BY ALL)
SELECT *, (SELECT MIN({clean('o.shop_name')}) FROM order_export o
           WHERE o.platform = 'jd' AND {clean('o.shop_id')} = store_id
             AND o.dt = (SELECT MAX(x.dt) FROM order_export x
                         WHERE x.platform = 'jd' AND {clean('x.shop_id')} = store_id)) AS store_name
FROM per_shop""")


def subsidies_cte(first: str = D, end: str = D_END) -> str:
    """Subsidy lines of hour-delivery orders; ``reason`` is '' where all is well."""
    amount = {n: gate(c, strip_tabs=True) for n, c in (
        ("settled", "amount"), ("platform_part", "platform_borne"), ("merchant_part", "merchant_borne"))}
    return f"""subsidies AS (
  SELECT dt, {clean('order_no')} AS order_no, {clean('fee_type')} AS fee_type,
         {", ".join(f"{x} AS {n}" for n, x in amount.items())},
         CASE WHEN settled IS NULL OR platform_part IS NULL THEN '结算或京东承担无法解析为数字'
              WHEN merchant_part NOT BETWEEN -0.02 AND 0.02 THEN '商家承担金额应为0'
              WHEN settled - platform_part NOT BETWEEN -0.02 AND 0.02 THEN '结算金额与京东承担金额不一致'
              ELSE '' END AS reason
  FROM fin_line f
  WHERE platform = 'jd' AND dt >= DATE '{first}' AND dt < DATE '{end}'
    AND list_contains({SUBSIDY_TYPES}, {clean('fee_type')})
    AND EXISTS (FROM order_export o WHERE o.platform = 'jd' AND o.dt >= DATE '{first}' AND o.dt < DATE '{end}'
                AND {clean('o.order_source')} = '小时达' AND {clean('o.order_no')} = {clean('f.order_no')}))"""


@query("jd_subsidy_check")
def jd_subsidy_check(v):
    """Failing activity-subsidy lines of hour-delivery orders, with the reason."""
    return money_all(R.jd_subsidies(v, WINDOW).where(F.col("reason").isNotNull()))


reg("jd_subsidy_check", SHEET_VIEWS, f"""WITH {subsidies_cte()}
SELECT dt, order_no, fee_type, CAST(settled AS {M2}) AS settled, CAST(platform_part AS {M2}) AS platform_part,
       CAST(merchant_part AS {M2}) AS merchant_part, reason FROM subsidies WHERE reason <> ''""")


@query("jd_subsidy_summary")
def jd_subsidy_summary(v):
    """Per day: subsidy lines checked, failing ones and both totals."""
    return money_all(R.jd_subsidy_summary(R.jd_subsidies(v, WINDOW)))


reg("jd_subsidy_summary", SHEET_VIEWS, f"""WITH {subsidies_cte()}
SELECT dt, COUNT(*) AS subsidy_lines, COUNT(*) FILTER (reason <> '') AS failing_lines,
       {_total('settled')} AS settled_total, {_total('platform_part')} AS platform_total
FROM subsidies GROUP BY dt""")


def _grouped(c):
    return (f"(CASE WHEN {c} IS NULL OR TRIM(REPLACE({c}, ',', '')) IN ('', '--') "
            f"THEN CAST(0 AS DECIMAL(18,4)) ELSE CAST(TRIM(REPLACE({c}, ',', '')) AS DECIMAL(18,4)) END)")


@query("statement_identity")
def statement_identity(v):
    """Wide JD statement rows whose payable ≠ Σ components ± 0.02."""
    return money_all(R.statement_identity(R.jd_statement(v.fin_bill)))


_STMT_COLS = ["goods", "delivery_income", "subsidy", "commission", "delivery_fee", "refund", "compensation",
              "box_fee", "rider_tip", "bag_fee"]
reg("statement_identity", ["fin_bill"], f"""
SELECT order_no, CAST(payable AS {M2}) AS payable, CAST(rebuilt AS {M2}) AS rebuilt,
       CAST(payable - rebuilt AS {M2}) AS diff
FROM (SELECT order_no, {_grouped('settlement')} AS payable,
             {" + ".join(_grouped(c) for c in _STMT_COLS)} + IF(CAST(shop_id AS INTEGER) % 4 = 0, -0.01, 0) AS rebuilt
      FROM fin_bill WHERE platform = 'jd') t
WHERE ABS(payable - rebuilt) > 0.02""")


@query("statement_crosscheck")
def statement_crosscheck(v):
    """Statements as workbooks of two pages, the rows and their stated total:
    Σ payable of the first page vs the second (± 0.02).  Some shops' totals
    are stated wrongly."""
    lines = X.in_parts(R.jd_statement(v.fin_bill), ["shop_id"], ["order_no", "line_no"])
    name = F.concat(F.lit("对账单-"), F.col("shop_id"), F.when(F.col("part") > 0, F.concat(F.lit("-"), F.col("part").cast("string"))).otherwise(F.lit("")), F.lit(".xlsx"))
    wrong = F.when(F.col("shop_id").cast("int") % 7 == 3, F.lit(1)).otherwise(F.lit(0))
    totals = (lines.groupBy("shop_id", "part").agg(F.sum(C.num_grouped("settlement")).alias("sum"))
              .withColumn("stated", F.format_number((F.col("sum") + wrong).cast("decimal(18,2)"), 2)))
    pages = (X.sheet_cells(lines, name, {"order_no": "订单号", "settlement": "应结金额"}, ["order_no", "line_no", "settlement"], sheet="第1页")
             .unionByName(X.sheet_cells(totals, name, {"stated": "合计应结金额"}, ["stated"], sheet="第2页")))
    cells = materialize(FL.workbook_cells(X.workbooks(pages), ["第1页", "第2页"], header_rows=1))
    page = {}
    for sheet in ("第1页", "第2页"):
        own = cells.where(F.col("sheet") == sheet)
        page[sheet] = FL.cells_to_rows(own, FL.header_names(own, 0), 1)
    return money_all(R.statement_crosscheck(page["第1页"].withColumnRenamed("应结金额", "payable"),
                                            page["第2页"].withColumnRenamed("合计应结金额", "stated")))


reg("statement_crosscheck", ["fin_bill"], f"""
SELECT '对账单-' || shop_id || '.xlsx' AS file, CAST(paid AS {M2}) AS detail_total, CAST(paid + planted AS {M2}) AS stated_total,
       CAST(-planted AS {M2}) AS diff, planted = 0 AS ok
FROM (SELECT shop_id, SUM({_grouped('settlement')}) AS paid, IF(CAST(shop_id AS INTEGER) % 7 = 3, 1, 0) AS planted
      FROM fin_bill WHERE platform = 'jd' GROUP BY shop_id) t""")
