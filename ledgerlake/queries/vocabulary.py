"""Cleaning vocabulary (§2.2) and filters (§2.3), each applied to a whole raw table.

Every query projects the raw text next to the parsed value so the parsing
policy is visible row by row; the oracle states the reference's SQL form.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..functions import cleaning as C
from ..functions import predicates as P
from ..oracle_sql import (clean, div_round2, gate, gate0, paren, pnorm, reg, strict, tnull)
from ..plans.recon import TARGET_ORDER

M2 = "decimal(18,2)"
N4 = "decimal(18,4)"
D, D_END = "1999-07-01", "2000-07-01"


# ---------------------------------------------------------------------------
# §2.2 scalar functions
# ---------------------------------------------------------------------------
@query("fn_clean_text")
def fn_clean_text(v):
    """Tabs removed, spaces trimmed, blank → null (order numbers, bill dates)."""
    f = v.fin_bill
    return f.select(F.col("order_no").alias("raw_order_no"), C.clean_text("order_no").alias("order_no"),
                    F.col("bill_date").alias("raw_bill_date"), C.clean_text("bill_date").alias("bill_date"))


reg("fn_clean_text", ["fin_bill"], f"""
SELECT order_no AS raw_order_no, {clean('order_no')} AS order_no,
       bill_date AS raw_bill_date, {clean('bill_date')} AS bill_date FROM fin_bill""")


@query("fn_trim_null")
def fn_trim_null(v):
    """Trim + blank → null, tabs kept (placed time, refund status)."""
    o = v.product_lines
    return o.select(F.col("order_no").alias("raw"), C.trim_null("order_no").alias("trimmed"),
                    C.trim_null("placed_at").alias("placed_at"))


reg("fn_trim_null", ["product_lines"], f"""
SELECT order_no AS raw, {tnull('order_no')} AS trimmed, {tnull('placed_at')} AS placed_at
FROM product_lines""")


@query("fn_num_strict")
def fn_num_strict(v):
    """Strict numbers: blank → null, junk would raise."""
    f = v.fin_bill
    return f.select("order_no", C.num_strict("goods").alias("goods"),
                    C.num_strict("compensation").alias("compensation"),
                    C.num_strict("box_fee").alias("box_fee"))


reg("fn_num_strict", ["fin_bill"], f"""
SELECT order_no, {strict('goods')} AS goods, {strict('compensation')} AS compensation,
       {strict('box_fee')} AS box_fee FROM fin_bill""")


@query("fn_num_or_null")
def fn_num_or_null(v):
    """Regex-gated numbers, junk (``-``, ``计费基数``, ``n/a``) → null."""
    return v.fin_bill.select("order_no", "settlement", "receivable",
                             C.num_or_null("settlement").alias("settlement_amt"),
                             C.num_or_null("receivable").alias("receivable_amt"))


reg("fn_num_or_null", ["fin_bill"], f"""
SELECT order_no, settlement, receivable, {gate('settlement')} AS settlement_amt,
       {gate('receivable')} AS receivable_amt FROM fin_bill""")


@query("fn_num_or_zero")
def fn_num_or_zero(v):
    """Regex-gated numbers, junk → 0 (order export receivable)."""
    return v.order_export.select("order_no", "receivable",
                                 C.num_or_zero("receivable").alias("receivable_amt"))


reg("fn_num_or_zero", ["order_export"], f"""
SELECT order_no, receivable, {gate0('receivable')} AS receivable_amt FROM order_export""")


@query("fn_num_dash_null")
def fn_num_dash_null(v):
    """``'-'`` sentinel → null, then strict (voucher columns)."""
    return v.fin_bill.select("order_no", "voucher", C.num_dash_null("voucher").alias("voucher_amt"))


reg("fn_num_dash_null", ["fin_bill"], """
SELECT order_no, voucher, CAST(NULLIF(NULLIF(TRIM(voucher), ''), '-') AS DECIMAL(18,4)) AS voucher_amt
FROM fin_bill""")


@query("fn_num_grouped")
def fn_num_grouped(v):
    """Thousands separators removed; blank / ``--`` → 0."""
    return v.order_export.select("order_no", "receivable_fmt",
                                 C.num_grouped("receivable_fmt").alias("amount"))


reg("fn_num_grouped", ["order_export"], """
SELECT order_no, receivable_fmt,
       CASE WHEN receivable_fmt IS NULL OR TRIM(REPLACE(receivable_fmt, ',', '')) IN ('', '--')
            THEN CAST(0 AS DECIMAL(18,4))
            ELSE CAST(TRIM(REPLACE(receivable_fmt, ',', '')) AS DECIMAL(18,4)) END AS amount
FROM order_export""")


@query("fn_num_grouped_null")
def fn_num_grouped_null(v):
    """Thousands separators removed; blank, ``-``, ``--``, junk → null."""
    return v.order_export.select("order_no", "receivable_fmt",
                                 C.num_grouped_null("receivable_fmt").alias("amount"))


reg("fn_num_grouped_null", ["order_export"], """
SELECT order_no, receivable_fmt,
       CASE WHEN TRIM(REPLACE(receivable_fmt, ',', '')) IN ('', '-', '--') THEN NULL
            ELSE TRY_CAST(TRIM(REPLACE(receivable_fmt, ',', '')) AS DOUBLE) END AS amount
FROM order_export""")


@query("fn_norm_code")
def fn_norm_code(v):
    """Product codes: ``123.0`` → ``123``, ``1e2`` → ``100``, ``-`` → '', tabs removed."""
    return v.product_lines.select("order_no", "code_raw", C.norm_code("code_raw").alias("code"))


reg("fn_norm_code", ["product_lines"], """
SELECT order_no, code_raw,
  CASE WHEN code_raw IS NULL OR TRIM(REPLACE(code_raw, chr(9), '')) IN ('', '-') THEN ''
       WHEN TRY_CAST(TRIM(REPLACE(code_raw, chr(9), '')) AS DOUBLE) IS NOT NULL
            AND TRY_CAST(TRIM(REPLACE(code_raw, chr(9), '')) AS DOUBLE)
                = floor(TRY_CAST(TRIM(REPLACE(code_raw, chr(9), '')) AS DOUBLE))
            AND abs(TRY_CAST(TRIM(REPLACE(code_raw, chr(9), '')) AS DOUBLE)) < 1e18
       THEN CAST(CAST(TRY_CAST(TRIM(REPLACE(code_raw, chr(9), '')) AS DOUBLE) AS DECIMAL(38,0)) AS VARCHAR)
       ELSE TRIM(REPLACE(code_raw, chr(9), '')) END AS code
FROM product_lines""")


@query("fn_paren_extract")
def fn_paren_extract(v):
    """Store short name = text in the last bracket pair, else unchanged."""
    return v.order_export.select("order_no", "shop_name",
                                 C.paren_extract("shop_name").alias("store_name"))


reg("fn_paren_extract", ["order_export"], f"""
SELECT order_no, shop_name, {paren('shop_name')} AS store_name FROM order_export""")


@query("fn_paren_normalize")
def fn_paren_normalize(v):
    """Full-width brackets → half-width."""
    return v.store_alias.select("platform", "store_name",
                                C.paren_normalize("store_name").alias("store_name_norm"))


reg("fn_paren_normalize", ["store_alias"], f"""
SELECT platform, store_name, {pnorm('store_name')} AS store_name_norm FROM store_alias""")


@query("fn_map_values")
def fn_map_values(v):
    """Sales channel → platform, unknown channels pass through."""
    from ..plans.models import CHANNEL_TO_PLATFORM
    return v.item_detail.select("channel", C.map_values("channel", CHANNEL_TO_PLATFORM).alias("platform"))


reg("fn_map_values", ["item_detail"], """
SELECT channel, CASE channel WHEN '淘宝闪购' THEN '饿了么' WHEN '京东秒送' THEN '京东'
                             WHEN '美团外卖' THEN '美团' ELSE channel END AS platform
FROM item_detail""")


@query("fn_coalesce")
def fn_coalesce(v):
    """First non-blank of placed / accepted time, else ''."""
    return v.order_export.select("order_no", C.first_non_blank("accepted_at", "placed_at",
                                                               default="").alias("event_time"))


reg("fn_coalesce", ["order_export"], """
SELECT order_no, COALESCE(NULLIF(accepted_at, ''), NULLIF(placed_at, ''), '') AS event_time
FROM order_export""")


@query("fn_date_strict")
def fn_date_strict(v):
    """Bill date text → date, blank → null."""
    return v.fin_bill.select("order_no", "bill_date", C.date_strict("bill_date").alias("bill_day"))


reg("fn_date_strict", ["fin_bill"], f"""
SELECT order_no, bill_date, CAST({tnull('bill_date')} AS DATE) AS bill_day FROM fin_bill""")


@query("fn_date_fmt")
def fn_date_fmt(v):
    """``YYYY-MM-DD`` pattern, trailing time tolerated."""
    return v.courier.select("order_no", "placed_on", C.date_fmt("placed_on").alias("placed_day"))


reg("fn_date_fmt", ["courier"], f"""
SELECT order_no, placed_on,
       CAST(strptime(substr({tnull('placed_on')}, 1, 10), '%Y-%m-%d') AS DATE) AS placed_day
FROM courier""")


@query("fn_date_lenient")
def fn_date_lenient(v):
    """``YYYY-MM-DD`` or ``YYYY-M-D``; junk → null."""
    return v.promo_text.select("store", "day_loose", C.date_lenient("day_loose").alias("day"))


reg("fn_date_lenient", ["promo_text"], f"""
SELECT store, day_loose, TRY_CAST({tnull('day_loose')} AS DATE) AS day FROM promo_text""")


@query("fn_ts_fmt")
def fn_ts_fmt(v):
    """Placed-time text → wall-clock timestamp (non-ISO text → null)."""
    return v.order_export.select("order_no", "placed_at", C.ts_fmt("placed_at").alias("placed_ts"))


reg("fn_ts_fmt", ["order_export"], f"""
SELECT order_no, placed_at,
       COALESCE(try_strptime({tnull('placed_at')}, '%Y-%m-%d %H:%M:%S'),
                TRY_CAST({tnull('placed_at')} AS TIMESTAMP)) AS placed_ts
FROM order_export""")


@query("fn_date_text")
def fn_date_text(v):
    """Date → ``YYYY年MM月DD日`` and ISO text."""
    return v.order_export.select("order_no", C.cn_day_text("dt").alias("cn_day"),
                                 C.day_text("dt").alias("iso_day"))


reg("fn_date_text", ["order_export"], """
SELECT order_no, strftime(dt, '%Y年%m月%d日') AS cn_day, strftime(dt, '%Y-%m-%d') AS iso_day
FROM order_export""")


@query("fn_date_shift")
def fn_date_shift(v):
    """Day arithmetic: lookback start of each partition day (dt − 120)."""
    return v.fin_bill.select("order_no", "dt", F.date_sub("dt", 120).alias("lookback_from"))


reg("fn_date_shift", ["fin_bill"], """
SELECT order_no, dt, CAST(dt - 120 AS DATE) AS lookback_from FROM fin_bill""")


@query("fn_concat_like")
def fn_concat_like(v):
    """``placed LIKE cn_day(dt) || '%'`` as a literal prefix test."""
    o = v.order_export
    return o.select("order_no", F.col("placed_at").startswith(C.cn_day_text("dt")).alias("cn_same_day"))


reg("fn_concat_like", ["order_export"], """
SELECT order_no, starts_with(placed_at, strftime(dt, '%Y年%m月%d日')) AS cn_same_day FROM order_export""")


@query("fn_abs_round")
def fn_abs_round(v):
    """ABS and ROUND(x, 2) half-up on decimals."""
    x = C.num_strict("commission") * F.lit(0.15).cast("decimal(3,2)")
    return v.fin_bill.select("order_no", F.abs(C.num_strict("commission")).alias("abs_commission"),
                             F.round(x, 2).cast(M2).alias("commission_share"))


reg("fn_abs_round", ["fin_bill"], f"""
SELECT order_no, ABS({strict('commission')}) AS abs_commission,
       CAST(ROUND({strict('commission')} * CAST(0.15 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2))
         AS commission_share
FROM fin_bill""")


@query("fn_cast_numeric")
def fn_cast_numeric(v):
    """Rounding casts to (14,2) and (10,2)."""
    x = C.num_strict("delivery_income") * F.lit(0.125).cast("decimal(4,3)")
    return v.fin_bill.select("order_no", x.cast("decimal(14,2)").alias("v14"),
                             x.cast("decimal(10,2)").alias("v10"))


reg("fn_cast_numeric", ["fin_bill"], f"""
SELECT order_no,
       CAST({strict('delivery_income')} * CAST(0.125 AS DECIMAL(4,3)) AS DECIMAL(14,2)) AS v14,
       CAST({strict('delivery_income')} * CAST(0.125 AS DECIMAL(4,3)) AS DECIMAL(10,2)) AS v10
FROM fin_bill""")


@query("fn_safe_ratio")
def fn_safe_ratio(v):
    """``COALESCE(kingdee_qty / NULLIF(mini_qty, 0), 1)``."""
    return v.sku_map.select("mini_code", "kingdee_code",
                            C.safe_ratio(F.col("kingdee_qty"), F.col("mini_qty"))
                            .cast("decimal(18,6)").alias("ratio"))


reg("fn_safe_ratio", ["sku_map"], """
SELECT mini_code, kingdee_code,
       CAST(COALESCE(kingdee_qty / NULLIF(mini_qty, 0), 1) AS DECIMAL(18,6)) AS ratio FROM sku_map""")


@query("fn_guarded_div")
def fn_guarded_div(v):
    """Average line amount per shop: division only when the count is > 0."""
    g = (v.fin_line.groupBy("shop_id")
         .agg(F.sum(C.num_or_null("amount")).alias("s"), F.count(C.num_or_null("amount")).alias("n")))
    return g.select("shop_id", F.when(F.col("n") > 0, F.round(F.col("s") / F.col("n"), 2))
                    .otherwise(F.lit(0)).cast(M2).alias("avg_amount"))


reg("fn_guarded_div", ["fin_line"], f"""
SELECT shop_id, CAST(CASE WHEN n > 0 THEN {div_round2('s', 'n')} ELSE 0 END AS DECIMAL(18,2)) AS avg_amount
FROM (SELECT shop_id, SUM({gate('amount')}) AS s, COUNT({gate('amount')}) AS n
      FROM fin_line GROUP BY shop_id) t""")


@query("fn_refund_clamp")
def fn_refund_clamp(v):
    """Cancelled / fully refunded orders: positive receivable → 0, negative kept."""
    o = v.order_export
    flag = F.coalesce((C.clean_text("status") == C.CANCELLED)
                      | (C.clean_text("refund_status") == C.FULL_REFUND), F.lit(False))
    return o.select("order_no", flag.alias("is_cancel_or_full_refund"),
                    C.refund_clamp(flag, C.num_or_null("receivable")).alias("receivable_clamped"))


reg("fn_refund_clamp", ["order_export"], f"""
SELECT order_no, is_cancel_or_full_refund,
  CASE WHEN NOT is_cancel_or_full_refund THEN amt WHEN amt > 0 THEN CAST(0 AS DECIMAL(18,4))
       WHEN amt < 0 THEN amt ELSE CAST(0 AS DECIMAL(18,4)) END AS receivable_clamped
FROM (SELECT order_no, {gate('receivable')} AS amt,
             COALESCE({clean('status')} = '已取消' OR {clean('refund_status')} = '全部退款', FALSE)
               AS is_cancel_or_full_refund
      FROM order_export) t""")


@query("fn_reason_code")
def fn_reason_code(v):
    """Failure reason of the subsidy identity, in priority order."""
    from ..plans.recon import subsidy_reason
    f = v.fin_line
    s, j, m = (C.num_or_null(c, strip_tabs=True) for c in ("amount", "platform_borne", "merchant_borne"))
    return f.select("order_no", "line_no", subsidy_reason(s, j, m).alias("reason"))


reg("fn_reason_code", ["fin_line"], f"""
SELECT order_no, line_no,
  CASE WHEN s IS NULL OR j IS NULL THEN '结算或京东承担无法解析为数字'
       WHEN ABS(COALESCE(m, 0)) > 0.02 THEN '商家承担金额应为0'
       WHEN ABS(s - j) <= 0.02 THEN NULL
       ELSE '结算金额与京东承担金额不一致' END AS reason
FROM (SELECT order_no, line_no, {gate('amount', strip_tabs=True)} AS s,
             {gate('platform_borne', strip_tabs=True)} AS j,
             {gate('merchant_borne', strip_tabs=True)} AS m FROM fin_line) t""")


@query("fn_typed_null")
def fn_typed_null(v):
    """Typed null placeholder column (goods-cost placeholder of the store sheet)."""
    return v.fixed_cost.select("store_label", C.typed_null(M2).alias("zh_cost_total"))


reg("fn_typed_null", ["fixed_cost"], """
SELECT store_label, CAST(NULL AS DECIMAL(18,2)) AS zh_cost_total FROM fixed_cost""")


# ---------------------------------------------------------------------------
# §2.3 filters
# ---------------------------------------------------------------------------
@query("flt_is_distinct")
def flt_is_distinct(v):
    """Null-safe ≠ keeps orders with a null status."""
    o = v.order_export
    return o.where(P.is_distinct_from(C.clean_text("status"), C.CANCELLED)).select("order_no", "status")


reg("flt_is_distinct", ["order_export"], f"""
SELECT order_no, status FROM order_export WHERE {clean('status')} IS DISTINCT FROM '已取消'""")


@query("flt_not_or")
def flt_not_or(v):
    """NOT (cancelled OR fully refunded), three-valued: null refund status drops."""
    o = v.order_export
    return o.where(P.not_cancelled_or_refunded("status", "refund_status")).select(
        "order_no", "status", "refund_status")


reg("flt_not_or", ["order_export"], f"""
SELECT order_no, status, refund_status FROM order_export
WHERE NOT ({clean('status')} = '已取消' OR {clean('refund_status')} = '全部退款')""")


@query("flt_half_open_day")
def flt_half_open_day(v):
    """Placed-time text in ``[D, D_end)`` compared as text."""
    p = v.product_lines
    t = F.trim(F.replace(F.col("placed_at"), F.lit("\t"), F.lit("")))
    return p.where((t >= F.lit(D)) & (t < F.lit(D_END))).select("order_no", "placed_at")


reg("flt_half_open_day", ["product_lines"], f"""
SELECT order_no, placed_at FROM product_lines
WHERE TRIM(REPLACE(placed_at, chr(9), '')) >= '{D}' AND TRIM(REPLACE(placed_at, chr(9), '')) < '{D_END}'""")


@query("flt_dual_format_day")
def flt_dual_format_day(v):
    """Placed time in the window in either ``YYYY年MM月DD日`` or ISO format."""
    o = v.order_export
    day = P.dual_format_day(C.clean_text("placed_at"))
    return o.where(P.half_open(day, D, D_END)).select("order_no", "placed_at", day.alias("placed_day"))


def _placed_day_sql(p):
    return (f"(CASE WHEN regexp_matches({p}, '^[0-9]{{4}}年[0-9]{{2}}月[0-9]{{2}}日') "
            f"THEN CAST(try_strptime(substr({p}, 1, 11), '%Y年%m月%d日') AS DATE) "
            f"WHEN regexp_matches({p}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
            f"THEN CAST(try_strptime({p}, '%Y-%m-%d %H:%M:%S') AS DATE) END)")


reg("flt_dual_format_day", ["order_export"], f"""
SELECT order_no, placed_at, placed_day FROM (
  SELECT order_no, placed_at, {_placed_day_sql(clean('placed_at'))} AS placed_day FROM order_export) t
WHERE placed_day >= DATE '{D}' AND placed_day < DATE '{D_END}'""")


@query("flt_lookback_window")
def flt_lookback_window(v):
    """Finance partitions from D − 120 on, no upper bound."""
    f = v.fin_bill
    return f.where(P.lookback(F.col("dt"), D, 120)).select("order_no", "line_no", "dt")


reg("flt_lookback_window", ["fin_bill"], f"""
SELECT order_no, line_no, dt FROM fin_bill WHERE dt >= DATE '{D}' - 120""")


@query("flt_in_list")
def flt_in_list(v):
    """Fee types in / not in the JD shipping list (null fee type in neither)."""
    from ..plans.models import JD_SHIPPING
    f = v.fin_line
    return f.select("order_no", "line_no", "fee_type",
                    P.in_list("fee_type", JD_SHIPPING).alias("is_shipping"),
                    P.not_in_list("fee_type", JD_SHIPPING).alias("not_shipping")) \
        .where(F.col("is_shipping") | F.col("not_shipping"))


reg("flt_in_list", ["fin_line"], """
SELECT order_no, line_no, fee_type,
       fee_type IN ('基础配送费', '商家承担远距离运费') AS is_shipping,
       fee_type NOT IN ('基础配送费', '商家承担远距离运费') AS not_shipping
FROM fin_line
WHERE fee_type IN ('基础配送费', '商家承担远距离运费') OR fee_type NOT IN ('基础配送费', '商家承担远距离运费')""")


@query("flt_regex")
def flt_regex(v):
    """Rows whose settlement text passes the number gate."""
    return v.fin_bill.where(P.regex_gate(F.trim("settlement"), C.NUM_GATE)).select("order_no", "settlement")


reg("flt_regex", ["fin_bill"], """
SELECT order_no, settlement FROM fin_bill WHERE regexp_matches(TRIM(settlement), '^-?[0-9]+(\\.[0-9]*)?$')""")


@query("flt_contains")
def flt_contains(v):
    """Compensation bills: order type contains 赔偿."""
    return v.fin_bill.where(P.contains("order_type", "赔偿")).select("order_no", "line_no", "order_type")


reg("flt_contains", ["fin_bill"], """
SELECT order_no, line_no, order_type FROM fin_bill WHERE order_type LIKE '%赔偿%'""")


@query("flt_not_null")
def flt_not_null(v):
    """Required fields present: bill date and amount."""
    f = v.fin_bill
    return f.where(C.trim_null("bill_date").isNotNull() & C.trim_null("settlement").isNotNull()) \
        .select("order_no", "line_no")


reg("flt_not_null", ["fin_bill"], f"""
SELECT order_no, line_no FROM fin_bill
WHERE {tnull('bill_date')} IS NOT NULL AND {tnull('settlement')} IS NOT NULL""")


@query("flt_point_lookup")
def flt_point_lookup(v):
    """All finance lines of one order inside the lookback window."""
    f = v.fin_bill
    return f.where(P.lookback(F.col("dt"), D, 120) & (C.clean_text("order_no") == TARGET_ORDER)) \
        .select("order_no", "line_no", "dt", "settlement")


reg("flt_point_lookup", ["fin_bill"], f"""
SELECT order_no, line_no, dt, settlement FROM fin_bill
WHERE dt >= DATE '{D}' - 120 AND {clean('order_no')} = '{TARGET_ORDER}'""")
