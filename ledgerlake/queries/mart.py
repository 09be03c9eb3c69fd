"""Queries of the dbt layer: staging, intermediate models and the P&L mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query
from ..plans import models as M


@query("ads_daily_report")
def ads_daily_report(v):
    """Daily P&L mart (flagship)."""
    return M.build_mart(v)


from ..catalog import money_all  # noqa: E402
from ..oracle_sql import BILLS, INT_COST, INT_PROMO, INT_SHIP, MART_CTES, MART_VIEWS, TAKINGS, reg  # noqa: E402

M2 = "DECIMAL(18,2)"


@query("stg_wide_revenue")
def stg_wide_revenue(v):
    """MT finance bills cleaned: dt, platform, store, order, revenue, fee, shipping."""
    return M.stg_wide_revenue(v.fin_bill)


reg("stg_wide_revenue", MART_VIEWS, f"""WITH {BILLS}
SELECT dt, '美团' AS platform, store_name, order_no, income AS revenue, fee AS platform_fee_raw, ship AS shipping_raw
FROM bills WHERE code = 'mt'""")


@query("stg_multi_revenue")
def stg_multi_revenue(v):
    """EL finance detail cleaned (gated receivable, strict fees)."""
    return M.stg_multi_revenue(v.fin_bill)


reg("stg_multi_revenue", MART_VIEWS, f"""WITH {BILLS}
SELECT dt, '饿了么' AS platform, store_name, order_no, income AS revenue, net_sales AS net_sales_total,
       fee AS platform_fee_raw, ship AS shipping_platform_raw, haul AS shipping_logistics_raw
FROM bills WHERE code = 'el'""")


@query("stg_long_fees")
def stg_long_fees(v):
    """JD long fee lines with store names looked up by store id."""
    return M.stg_long_fees(v.fin_line, v.order_export)


reg("stg_long_fees", MART_VIEWS, f"WITH {BILLS} SELECT '京东' AS platform, * FROM fees")


@query("int_platform_revenue")
def int_platform_revenue(v):
    """Revenue / fee / shipping / order count per dt × platform × store."""
    return money_all(M.int_platform_revenue(M.stg_wide_revenue(v.fin_bill), M.stg_multi_revenue(v.fin_bill),
                                            M.stg_long_fees(v.fin_line, v.order_export)))


reg("int_platform_revenue", MART_VIEWS, f"""WITH {TAKINGS}
SELECT dt, platform, store_name, CAST(revenue AS {M2}) AS revenue, CAST(platform_fee AS {M2}) AS platform_fee,
       CAST(shipping AS {M2}) AS shipping, CAST(order_count AS BIGINT) AS order_count FROM takings""")


@query("int_item_cost")
def int_item_cost(v):
    """Goods cost per dt × store × platform (SKU map, conversion ratio)."""
    return money_all(M.int_item_cost(v.item_detail, v.sku_map))


reg("int_item_cost", MART_VIEWS, f"""WITH {INT_COST}
SELECT dt, store_name, platform, CAST(cost AS {M2}) AS cost FROM ic""")


@query("int_thirdparty_shipping")
def int_thirdparty_shipping(v):
    """Courier cost per dt × store."""
    return money_all(M.int_thirdparty_shipping(v.courier))


reg("int_thirdparty_shipping", MART_VIEWS, f"""WITH {INT_SHIP}
SELECT dt, store_name, CAST(maiyatian_shipping AS {M2}) AS maiyatian_shipping FROM ma""")


@query("int_promotion_cost")
def int_promotion_cost(v):
    """Promotion cost per dt × platform × store (typed + text source)."""
    return money_all(M.int_promotion_cost(v.promo_typed, v.promo_text))


reg("int_promotion_cost", MART_VIEWS, f"""WITH {INT_PROMO}
SELECT dt, platform, store_name, CAST(promotion_cost AS {M2}) AS promotion_cost FROM pr""")


@query("pl_profit_formula")
def pl_profit_formula(v):
    """gross = revenue − cost − platform fee; net = gross − rent allocated."""
    m = M.build_mart(v)
    return m.select("dt", "platform", "store_name", "revenue", "cost", "platform_fee", "gross_profit",
                    "rent_labor_allocated", "net_profit")


reg("pl_profit_formula", MART_VIEWS, f"""WITH {MART_CTES}
SELECT dt, platform, store_name, revenue, cost, platform_fee, gross_profit, rent_labor_allocated, net_profit FROM pnl""")
