"""DuckDB oracle SQL for every registered query.

Each oracle states its rule over the same raw export views
(``sources.testdata`` supplies them as leading CTEs); component lists and
maps are written out here, not taken from the Spark code.  Outputs are cast to the same types as the Spark side:
money DECIMAL(18,2) / (14,2), counts BIGINT.

DuckDB divides decimals into DOUBLE; where a quotient is rounded, the
oracle uses exact integer half-up arithmetic (``div_round2``) instead.
"""

from __future__ import annotations

from .sources.testdata import duck_with

ORACLES: dict[str, str] = {}


# ---------------------------------------------------------------------------
# SQL snippet helpers (DuckDB dialect)
# ---------------------------------------------------------------------------
def clean(x: str) -> str:
    return f"NULLIF(TRIM(REPLACE({x}, chr(9), '')), '')"


def tnull(x: str) -> str:
    return f"NULLIF(TRIM({x}), '')"


def strict(x: str, t: str = "DECIMAL(18,4)") -> str:
    return f"CAST(NULLIF(TRIM({x}), '') AS {t})"


def gate(x: str, other: str = "NULL", strip_tabs: bool = False) -> str:
    b = f"TRIM(REPLACE({x}, chr(9), ''))" if strip_tabs else f"TRIM({x})"
    return (f"(CASE WHEN regexp_matches({b}, '^-?[0-9]+(\\.[0-9]*)?$') "
            f"THEN CAST({b} AS DECIMAL(18,4)) ELSE {other} END)")


def gate0(x: str, strip_tabs: bool = False) -> str:
    return gate(x, "CAST(0 AS DECIMAL(18,4))", strip_tabs)


def paren(x: str) -> str:
    return (f"(CASE WHEN regexp_matches({x}, '(?s)[（(].+?[）)]') "
            f"THEN regexp_replace({x}, '(?s).*[（(](.+?)[）)].*', '\\1') ELSE {x} END)")


def pnorm(x: str) -> str:
    return f"REPLACE(REPLACE({x}, '（', '('), '）', ')')"


def div_round2(num: str, den: str, t: str = "DECIMAL(18,2)") -> str:
    """ROUND(num / den, 2) half away from zero, exact (num: decimal with at
    most 4 decimals, den: positive integer)."""
    x4 = f"CAST(({num}) * 10000 AS HUGEINT)"
    q = f"((2 * abs({x4}) + 100 * ({den})) // (200 * ({den})))"
    return f"CAST(sign({x4}) * {q} AS DECIMAL(38,0)) * CAST(0.01 AS DECIMAL(3,2))"


def reg(name: str, views: list[str], body: str) -> None:
    ORACLES[name] = duck_with(views, body)


# ---------------------------------------------------------------------------
# dbt layer: staging / intermediate / mart
# ---------------------------------------------------------------------------
# Finance of all platforms as one long table of amounts (a row per order line
# and kind); results are FILTERed sums over it.
# ---------------------------------------------------------------------------
BILLS = f"""bills AS (
  SELECT platform AS code, CAST({tnull('bill_date')} AS DATE) AS dt, {paren('shop_name')} AS store_name, order_no,
         CASE platform WHEN 'mt' THEN {strict('receivable')} ELSE {gate('receivable')} END AS income,
         {strict('commission')} AS fee, {strict('delivery_fee')} AS ship, {strict('box_fee')} AS haul,
         {gate('net_sales')} AS net_sales
  FROM fin_bill
  WHERE {tnull('bill_date')} IS NOT NULL
    AND (platform = 'el' OR platform = 'mt' AND {tnull('fin_status')} IS DISTINCT FROM '订单取消')),
shops AS (SELECT shop_id, MIN({paren('shop_name')}) AS store_name FROM order_export WHERE platform = 'jd' GROUP BY ALL),
fees AS (
  SELECT dt, shops.store_name, order_no, fee_type, {strict('amount')} AS amount
  FROM fin_line l LEFT JOIN shops USING (shop_id)
  WHERE l.platform = 'jd' AND {tnull('amount')} IS NOT NULL)"""

AMOUNTS = """amounts AS (
  SELECT * FROM (SELECT dt, '美团' AS platform, store_name, order_no, income, fee, ship FROM bills WHERE code = 'mt')
    UNPIVOT INCLUDE NULLS (amount FOR kind IN (income, fee, ship))
  UNION ALL BY NAME
  SELECT * FROM (SELECT dt, '饿了么' AS platform, store_name, order_no, income, fee, ship, haul FROM bills WHERE code = 'el')
    UNPIVOT INCLUDE NULLS (amount FOR kind IN (income, fee, ship, haul))
  UNION ALL BY NAME
  SELECT dt, '京东' AS platform, store_name, order_no, k.kind, CASE k.kind WHEN own THEN amount ELSE 0 END AS amount
  FROM (SELECT *, CASE WHEN fee_type = '代收到家佣金' THEN 'fee'
                       WHEN fee_type IN ('基础配送费', '商家承担远距离运费') THEN 'ship'
                       WHEN fee_type IS NOT NULL AND amount > 0 THEN 'income' END AS own FROM fees) f,
       (VALUES ('income'), ('fee'), ('ship')) k(kind)),
takings AS (
  SELECT dt, platform, store_name, COUNT(DISTINCT order_no) AS order_count,
         SUM(amount) FILTER (kind = 'income') AS revenue,
         ABS(SUM(amount) FILTER (kind = 'fee')) AS platform_fee,
         ABS(SUM(amount) FILTER (kind = 'ship')) + COALESCE(ABS(SUM(amount) FILTER (kind = 'haul')), 0) AS shipping
  FROM amounts GROUP BY ALL)"""

# exact: products at 12 decimals, divided per mini_qty, kept at 8
INT_COST = f"""priced AS (
  SELECT r.dt, {paren('r.shop_name')} AS store_name,
         CASE r.channel WHEN '淘宝闪购' THEN '饿了么' WHEN '京东秒送' THEN '京东'
                        WHEN '美团外卖' THEN '美团' ELSE r.channel END AS platform,
         CASE WHEN k.kingdee_qty IS NULL OR COALESCE(k.mini_qty, 0) = 0 THEN 1 ELSE k.mini_qty END AS mini,
         CAST(COALESCE(k.headquarters_price, 0) * 10000 AS HUGEINT) * CAST({strict('r.qty')} * 10000 AS HUGEINT)
           * CAST(CASE WHEN COALESCE(k.mini_qty, 0) = 0 THEN 1 ELSE COALESCE(k.kingdee_qty, 1) END * 10000 AS HUGEINT)
           AS num
  FROM item_detail r LEFT JOIN sku_map k ON k.mini_code = r.sku
  WHERE COALESCE({tnull('r.status')}, '') <> '已取消'),
ic AS (
  SELECT dt, store_name, platform, SUM(part) AS cost
  FROM (SELECT dt, store_name, platform, CAST(CAST(SUM(num) AS HUGEINT) // CAST(mini * 10000 AS HUGEINT)
               AS DECIMAL(28,0)) * CAST(0.00000001 AS DECIMAL(9,8)) AS part
        FROM priced GROUP BY dt, store_name, platform, mini)
  GROUP BY ALL)"""

INT_SHIP = f"""ma AS (
  SELECT m.dt, {paren('m.store')} AS store_name,
         SUM({strict('m.fee')}) AS maiyatian_shipping
  FROM courier m WHERE {tnull('m.status')} IS DISTINCT FROM '已取消'
  GROUP BY 1, 2)"""

INT_PROMO = f"""pr AS (
  SELECT dt, '美团' AS platform, store_name, SUM(amount) AS promotion_cost
  FROM promo_typed GROUP BY dt, store_name
  UNION ALL
  SELECT CAST({tnull('day')} AS DATE), '饿了么', {paren('store')},
         SUM(ABS({strict('spend')}))
  FROM promo_text GROUP BY 1, 3)"""

# Costs beside the platforms' own as one long table (a courier's cost counts
# for each platform of its store and day); rent goes to the platform that
# comes first by orders, then by name.
PNL = """charges AS (
  SELECT dt, store_name, platform, 'goods' AS kind, cost AS amount FROM ic
  UNION ALL SELECT dt, store_name, platform, 'promotion', promotion_cost FROM pr
  UNION ALL SELECT dt, store_name, platform, 'courier', maiyatian_shipping FROM takings JOIN ma USING (dt, store_name)),
charged AS (
  SELECT dt, store_name, platform, SUM(amount) FILTER (kind = 'goods') AS goods,
         SUM(amount) FILTER (kind = 'promotion') AS promotion, SUM(amount) FILTER (kind = 'courier') AS courier
  FROM charges GROUP BY ALL),
rents AS (
  SELECT dt, store_name, FIRST(platform ORDER BY order_count DESC, platform) AS payer FROM takings GROUP BY ALL),
exact AS (
  SELECT t.dt, t.platform, t.store_name, t.order_count, COALESCE(revenue, 0) AS income, COALESCE(t.platform_fee, 0) AS fee,
         COALESCE(t.shipping, 0) AS own_ship, COALESCE(courier, 0) AS courier, COALESCE(goods, 0) AS goods,
         COALESCE(promotion, 0) AS promotion, COALESCE(daily_rent_labor, 0) AS rent, payer IS NOT DISTINCT FROM t.platform AS pays,
         province, city, store_short_name IS NOT NULL AS has_store_ref, IF(daily_rent_labor IS NULL, NULL, '直营') AS store_type
  FROM takings t JOIN rents ON rents.dt IS NOT DISTINCT FROM t.dt AND rents.store_name IS NOT DISTINCT FROM t.store_name
  LEFT JOIN charged c ON (c.dt, c.store_name, c.platform) = (t.dt, t.store_name, t.platform)
  LEFT JOIN store_ref ON store_short_name = t.store_name),
pnl AS (
  SELECT *, CAST(gross_profit - rent_labor_allocated AS DECIMAL(14,2)) AS net_profit
  FROM (SELECT dt, platform, store_name, province, city, has_store_ref, store_type, CAST(order_count AS BIGINT) AS order_count,
               CAST(income AS DECIMAL(14,2)) AS revenue, CAST(fee AS DECIMAL(14,2)) AS platform_fee,
               CAST(own_ship AS DECIMAL(14,2)) AS platform_shipping, CAST(courier AS DECIMAL(14,2)) AS maiyatian_shipping,
               CAST(own_ship + courier AS DECIMAL(14,2)) AS shipping,
               CAST(IF(order_count > 0, {avg}, 0) AS DECIMAL(10,2)) AS avg_shipping,
               CAST(promotion AS DECIMAL(14,2)) AS promotion_cost, CAST(goods AS DECIMAL(14,2)) AS cost,
               CAST(rent AS DECIMAL(14,2)) AS rent_labor, CAST(IF(pays, rent, 0) AS DECIMAL(14,2)) AS rent_labor_allocated,
               CAST(income - goods - fee AS DECIMAL(14,2)) AS gross_profit
        FROM exact))""".replace("{avg}", div_round2("own_ship + courier", "order_count"))

MART_VIEWS = ["fin_bill", "fin_line", "order_export", "item_detail", "sku_map", "courier",
              "promo_typed", "promo_text", "store_ref"]
TAKINGS = f"{BILLS},\n{AMOUNTS}"
MART_CTES = ",\n".join([TAKINGS, INT_COST, INT_SHIP, INT_PROMO, PNL])

reg("ads_daily_report", MART_VIEWS, f"WITH {MART_CTES}\nFROM pnl")


# ---------------------------------------------------------------------------
# ad-hoc daily store sheet
#
# One table of orders for all platforms (finance sums and live orders are
# tagged with their platform), one aggregate per platform and store label,
# and the sheet as FILTERed sums over it.
# ---------------------------------------------------------------------------
D, D_END = "1999-07-01", "2000-07-01"
PLATFORMS = ("mt", "el", "jd")
ALIAS_PLATFORMS = {"mt": "'美团买药'", "el": "'饿了么', '淘宝闪购'",
                   "jd": "'京东买药', '京东小时达', '京东'"}
M2 = "DECIMAL(18,2)"


def in_win(x: str) -> str:
    return f"({x} >= DATE '{D}' AND {x} < DATE '{D_END}')"


def placed_day(p: str) -> str:
    return (f"(CASE WHEN regexp_matches({p}, '^[0-9]{{4}}年[0-9]{{2}}月[0-9]{{2}}日') "
            f"THEN CAST(try_strptime(substr({p}, 1, 11), '%Y年%m月%d日') AS DATE) "
            f"WHEN regexp_matches({p}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
            f"THEN CAST(try_strptime({p}, '%Y-%m-%d %H:%M:%S') AS DATE) END)")


def largest(**cols: str) -> str:
    """The greatest row of the named expressions, nulls least."""
    return "MAX({" + ", ".join(f"'has_{k}': {x} IS NOT NULL, '{k}': {x}" for k, x in cols.items()) + "})"


def smallest(**cols: str) -> str:
    """The least row of the named expressions, nulls greatest."""
    return "MIN({" + ", ".join(f"'no_{k}': {x} IS NULL, '{k}': {x}" for k, x in cols.items()) + "})"


_NO, _SHOP_ID, _SHOP = clean("order_no"), clean("shop_id"), clean("shop_name")
_LOOKBACK = f"dt >= DATE '{D}' - 120"

# per platform: (order number, settled amount) of the finance exports
_SETTLED = {
    "mt": f"""SELECT {_NO} AS order_no,
      {largest(day=clean('bill_date'), amount=f"CAST({clean('receivable')} AS DECIMAL(18,4))")}.amount AS settled
    FROM fin_bill
    WHERE platform = 'mt' AND {_LOOKBACK} AND COALESCE({clean('fin_status')}, '') <> '订单取消'
    GROUP BY ALL""",
    "el": f"""SELECT {_NO} AS order_no, SUM({gate0('receivable', True)}) AS settled
    FROM fin_bill WHERE platform = 'el' AND {_LOOKBACK} AND {_NO} IS NOT NULL GROUP BY ALL""",
    "jd": f"""SELECT {_NO} AS order_no, SUM(CAST({clean('amount')} AS DECIMAL(18,4))) AS settled
    FROM fin_line WHERE platform = 'jd' AND {_LOOKBACK} AND {_NO} IS NOT NULL GROUP BY ALL""",
}
# per platform: one row ``o`` (shop_id, shop_name among its fields) per live order of the window
_PLACED = {
    "mt": f"""SELECT {_NO} AS order_no,
      {largest(done=clean('done_at'), shop_id=_SHOP_ID, shop_name=_SHOP)} AS o
    FROM product_lines
    WHERE platform = 'mt' AND COALESCE({clean('status')}, '') <> '已取消'
      AND {clean('placed_at')} >= '{D}' AND {clean('placed_at')} < '{D_END}'
    GROUP BY ALL""",
    "el": f"""SELECT {_NO} AS order_no,
      {smallest(seq='order_seq', shop_id=_SHOP_ID, shop_name=_SHOP)} AS o
    FROM order_export
    WHERE platform = 'el' AND {in_win('dt')} AND {in_win(placed_day(clean('placed_at')))}
      AND NOT ({clean('status')} = '已取消' OR {clean('refund_status')} = '全部退款')
    GROUP BY ALL""",
    "jd": f"""SELECT * FROM (SELECT {_NO} AS order_no,
      {smallest(shop_id=_SHOP_ID, shop_name=_SHOP, status=clean('status'),
                at=f"COALESCE({clean('placed_at')}, {clean('accepted_at')})")} AS o
    FROM order_export WHERE platform = 'jd' AND {in_win('dt')}
    GROUP BY ALL)
    WHERE COALESCE(o.status, '') <> '已取消' AND {in_win("try_strptime(o.at, '%Y-%m-%d %H:%M:%S')")}""",
}


def _tagged(parts: dict[str, str], platforms) -> str:
    return "\n  UNION ALL ".join(f"SELECT '{p}' AS platform, * FROM (\n    {parts[p]})" for p in platforms)


def orders_cte(*platforms: str) -> str:
    """``finance`` and ``orders``: live orders of the window with their shop,
    the settled amount and whether finance knows them."""
    platforms = platforms or PLATFORMS
    return f"""finance AS (
  {_tagged(_SETTLED, platforms)}),
orders AS (
  SELECT p.platform, p.order_no, p.o.shop_id AS shop_id, p.o.shop_name AS shop_name, f.settled,
         f.platform IS NOT NULL AS matched
  FROM ({_tagged(_PLACED, platforms)}) p
  LEFT JOIN finance f ON f.platform = p.platform AND f.order_no = p.order_no)"""


def stores_cte(*platforms: str) -> str:
    """``orders_cte`` and ``store``: one row per platform and store label."""
    alias_of = " OR ".join(f"(o.platform = '{p}' AND a.platform IN ({ALIAS_PLATFORMS[p]}))"
                           for p in platforms or PLATFORMS)
    return f"""{orders_cte(*platforms)},
visits AS (
  SELECT o.platform, o.matched, o.settled, COALESCE(d.store_short_name, o.shop_name) AS label,
         COALESCE(d.province, '') AS province, COALESCE(d.city, '') AS city,
         COALESCE(d.store_nature, '未匹配') AS nature, COALESCE(d.meituan_enterprise_rebate, 0) AS rate
  FROM orders o
  LEFT JOIN store_alias a ON ({alias_of})
    AND (CAST(a.platform_store_id AS VARCHAR) = o.shop_id OR {pnorm('a.store_name')} = {pnorm('o.shop_name')})
  LEFT JOIN dim_store d ON d.store_short_name = a.store_short_name),
store AS (
  SELECT platform, label,
    COALESCE(NULLIF(MAX(province) FILTER (matched), ''), MAX(province) FILTER (NOT matched), '') AS province,
    COALESCE(NULLIF(MAX(city) FILTER (matched), ''), MAX(city) FILTER (NOT matched), '') AS city,
    COALESCE(MAX(nature) FILTER (matched), MAX(nature)) AS nature,
    COUNT(*) FILTER (matched) AS settled_orders, COUNT(*) FILTER (NOT matched) AS pending_orders,
    COALESCE(SUM(settled) FILTER (matched), 0) AS settled,
    COALESCE(SUM(rate) FILTER (matched), 0) AS rebate, COALESCE(MAX(rate) FILTER (matched), 0) AS rate
  FROM visits GROUP BY platform, label)"""


SHEET_VIEWS = ["fin_bill", "fin_line", "product_lines", "order_export", "store_alias",
               "dim_store", "courier", "promo_text", "fixed_cost"]

for _p in PLATFORMS:
    reg(f"match_{_p}", SHEET_VIEWS, f"""WITH {orders_cte(_p)}
SELECT order_no, shop_id AS platform_shop_id, shop_name AS platform_shop_name,
       CAST(settled AS {M2}) AS settlement_amt, matched FROM orders""")

# the columns of ``store`` under their report names
STORE_OUT = f"""label AS store_label, province, city, nature AS store_type,
  CAST(settled_orders AS BIGINT) AS order_cnt, CAST(settled AS {M2}) AS settlement_amt,
  CAST(rebate AS {M2}) AS rebate_amt, CAST(settled + rebate AS {M2}) AS receipt_amt,
  CAST(rate AS {M2}) AS rebate_per_order, CAST(pending_orders AS BIGINT) AS pending_cnt"""
reg("settle_by_store", SHEET_VIEWS, f"WITH {stores_cte()}\nSELECT platform, {STORE_OUT} FROM store")

PENDING_TOTALS = ", ".join(f"COUNT(*) FILTER (platform = '{p}' AND NOT matched) AS {p}_pending_total" for p in PLATFORMS)
reg("pending_totals", SHEET_VIEWS, f"WITH {orders_cte()}\nSELECT {PENDING_TOTALS} FROM orders")


def _of(p: str, x: str, t: str) -> str:
    return f"CAST(COALESCE(SUM({x}) FILTER (platform = '{p}'), 0) AS {t})"


# one row per label; its place is that of the first platform that has the label
SHEET = f"""sheet AS (
  SELECT label AS store_label,
    ARG_MIN(province, list_position(['mt', 'el', 'jd'], platform)) AS province,
    ARG_MIN(city, list_position(['mt', 'el', 'jd'], platform)) AS city,
    ARG_MIN(nature, list_position(['mt', 'el', 'jd'], platform)) AS store_type,
    CAST(SUM(settled_orders + pending_orders) AS BIGINT) AS order_cnt,
    CAST(SUM(settled + CASE WHEN platform = 'mt' THEN rebate ELSE 0 END) AS {M2}) AS settlement_amt,
    {_of('mt', 'settled_orders', 'BIGINT')} AS mt_order_cnt,
    {_of('mt', 'pending_orders', 'BIGINT')} AS mt_pending_fin_cnt,
    {_of('mt', 'settled', M2)} AS mt_receivable_amt,
    {_of('mt', 'rebate', M2)} AS mt_qike_rebate_amt,
    {_of('mt', 'settled + rebate', M2)} AS mt_receipt_amt,
    {_of('mt', 'rate', M2)} AS mt_qike_rebate_per_order,
    {_of('el', 'settled_orders', 'BIGINT')} AS el_order_cnt,
    {_of('el', 'pending_orders', 'BIGINT')} AS el_pending_fin_cnt,
    {_of('el', 'settled', M2)} AS el_settlement_amt,
    {_of('jd', 'settled_orders', 'BIGINT')} AS jd_order_cnt,
    {_of('jd', 'pending_orders', 'BIGINT')} AS jd_pending_fin_cnt,
    {_of('jd', 'settled', M2)} AS jd_settlement_amt
  FROM store GROUP BY label)"""
reg("orders_by_store", SHEET_VIEWS, f"WITH {stores_cte()},\n{SHEET}\nSELECT * FROM sheet")

_LEG_DAY = f"CAST(strptime(substr({tnull('placed_on')}, 1, 10), '%Y-%m-%d') AS DATE)"
COURIER_DAY = f"""legs AS (
  SELECT {tnull('order_no')} AS order_no, MAX({strict('fee')}) AS fee, MAX({strict('dist_km')}) AS km
  FROM courier WHERE {in_win('dt')} AND {in_win(_LEG_DAY)}
  GROUP BY ALL),
courier_day AS (
  SELECT COALESCE(SUM(fee), 0) AS fees, COUNT(order_no) AS orders,
         COALESCE({div_round2('SUM(km)', 'NULLIF(COUNT(km), 0)')}, 0) AS mean_km FROM legs)"""
reg("freight_day", SHEET_VIEWS, f"""WITH {COURIER_DAY}
SELECT CAST(fees AS {M2}) AS total_freight, CAST(mean_km AS {M2}) AS avg_dist_km,
       CAST(orders AS BIGINT) AS myt_order_cnt FROM courier_day""")

# the day's courier fees, spread over all orders of the sheet
SHARED = f"""shared AS (
  SELECT s.*, mean_km,
    CAST(COALESCE({div_round2('fees * order_cnt', 'NULLIF(SUM(order_cnt) OVER (), 0)')}, 0) AS {M2}) AS freight_alloc,
    CAST(CASE WHEN order_cnt > 0 THEN {div_round2('fees', 'NULLIF(SUM(order_cnt) OVER (), 0)')} END AS {M2})
      AS freight_per_order
  FROM sheet s, courier_day)"""
reg("freight_allocate", SHEET_VIEWS, f"""WITH {stores_cte()},
{SHEET},
{COURIER_DAY},
{SHARED}
SELECT store_label, order_cnt, freight_alloc, freight_per_order FROM shared""")

_PROMO_DAY = f"CAST(strptime(substr({tnull('p.day')}, 1, 10), '%Y-%m-%d') AS DATE)"
PROMO = f"""promo AS (
  SELECT COALESCE(known.store_short_name, {tnull('p.store')}) AS store_label,
         CAST(SUM({strict('p.cash_spend')}) AS {M2}) AS promo_spend
  FROM promo_text p
  LEFT JOIN (SELECT a.platform_store_id, a.store_name, d.store_short_name
             FROM store_alias a LEFT JOIN dim_store d USING (store_short_name)
             WHERE a.platform IN ({ALIAS_PLATFORMS['el']})) known
    ON CAST(known.platform_store_id AS VARCHAR) = {tnull('p.shop_id')}
       OR {pnorm('known.store_name')} = {pnorm(tnull('p.store'))}
  WHERE {in_win('p.dt')} AND {in_win(_PROMO_DAY)}
  GROUP BY 1 HAVING COALESCE(known.store_short_name, {tnull('p.store')}) IS NOT NULL)"""
reg("promo_by_store", SHEET_VIEWS, f"WITH {PROMO}\nSELECT store_label, promo_spend FROM promo")

FIXED = f"""fixed AS (
  SELECT c.store_label, COALESCE(d.province, {tnull('c.province')}) AS province,
         COALESCE(d.city, {tnull('c.city')}) AS city, COALESCE(d.store_nature, '未匹配') AS store_type,
         CAST(c.daily_fixed_cost AS {M2}) AS rent_util_labor_fixed
  FROM fixed_cost c LEFT JOIN dim_store d ON starts_with(d.store_short_name, c.store_label))"""
reg("fixed_cost_enrich", SHEET_VIEWS, f"WITH {FIXED}\nSELECT * FROM fixed")

# a label's activity (orders, promotion or both) meets its fixed cost in one full join
reg("daily_store_aggregate", SHEET_VIEWS, f"""WITH {stores_cte()},
{SHEET},
{COURIER_DAY},
{SHARED},
{PROMO},
{FIXED},
active AS (SELECT * FROM shared FULL JOIN promo USING (store_label)),
waiting AS (SELECT {PENDING_TOTALS} FROM orders)
SELECT DATE '{D}' AS report_date, store_label,
  COALESCE(f.province, a.province, '') AS province, COALESCE(f.city, a.city, '') AS city,
  COALESCE(f.store_type, a.store_type, '未匹配') AS store_type,
  COALESCE(settlement_amt, 0) AS settlement_amt,
  COALESCE(mt_order_cnt, 0) AS mt_order_cnt, COALESCE(mt_pending_fin_cnt, 0) AS mt_pending_fin_cnt,
  COALESCE(mt_receivable_amt, 0) AS mt_receivable_amt, COALESCE(mt_qike_rebate_amt, 0) AS mt_qike_rebate_amt,
  COALESCE(mt_receipt_amt, 0) AS mt_receipt_amt,
  COALESCE(mt_qike_rebate_per_order, 0) AS mt_qike_rebate_per_order,
  COALESCE(el_order_cnt, 0) AS ele_order_cnt, COALESCE(el_pending_fin_cnt, 0) AS ele_pending_fin_cnt,
  COALESCE(el_settlement_amt, 0) AS ele_settlement_amt,
  COALESCE(jd_order_cnt, 0) AS jd_order_cnt, COALESCE(jd_pending_fin_cnt, 0) AS jd_pending_fin_cnt,
  COALESCE(jd_settlement_amt, 0) AS jd_settlement_amt,
  (SELECT mt_pending_total FROM waiting) AS mt_pending_fin_match_total,
  (SELECT el_pending_total FROM waiting) AS ele_pending_fin_match_total,
  (SELECT jd_pending_total FROM waiting) AS jd_pending_fin_match_total,
  CAST(0 AS {M2}) AS zh_cost_total,
  COALESCE(freight_alloc, 0) AS freight_total_alloc, freight_per_order,
  COALESCE(order_cnt, 0) AS order_cnt,
  CAST((SELECT c.mean_km FROM courier_day c) AS {M2}) AS avg_order_distance_km_global,
  COALESCE(rent_util_labor_fixed, 0) AS rent_util_labor_fixed,
  COALESCE(promo_spend, 0) AS promo_spend
FROM active a FULL JOIN fixed f USING (store_label)""")
