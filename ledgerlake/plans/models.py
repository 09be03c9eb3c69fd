"""Staging → intermediate → mart models of the daily P&L (pure DataFrame functions).

Grain of every intermediate model and of the mart: ``dt × platform ×
store_name`` (third-party shipping: ``dt × store_name``).  Each function takes
raw export DataFrames (text columns) and returns a DataFrame; composing them
yields one Catalyst plan for the mart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cleaning as C

# JD fee types of the revenue rules.
JD_COMMISSION = "代收到家佣金"
JD_SHIPPING = ("基础配送费", "商家承担远距离运费")
# Store-system sales channel → platform.
CHANNEL_TO_PLATFORM = {"淘宝闪购": "饿了么", "京东秒送": "京东", "美团外卖": "美团"}


def stg_wide_revenue(fin_bill: DataFrame, platform: str = "mt") -> DataFrame:
    """One-row-per-bill finance (MT): date, store, order, revenue, fee, shipping.
    Drops cancelled bills and undated rows; amounts parsed strictly."""
    f = fin_bill.where(F.col("platform") == platform)
    return (f.where(~C.trim_null("fin_status").eqNullSafe(C.FIN_CANCELLED)
                    & C.trim_null("bill_date").isNotNull())
            .select(C.date_strict("bill_date").alias("dt"),
                    F.lit(C.PLATFORM_MT).alias("platform"),
                    C.paren_extract("shop_name").alias("store_name"),
                    F.col("order_no"),
                    C.num_strict("receivable").alias("revenue"),
                    C.num_strict("commission").alias("platform_fee_raw"),
                    C.num_strict("delivery_fee").alias("shipping_raw")))


def stg_multi_revenue(fin_bill: DataFrame, platform: str = "el") -> DataFrame:
    """EL finance detail: revenue = order receivable (regex-gated), net sales as a
    reference column, commission and two shipping parts (strict)."""
    f = fin_bill.where(F.col("platform") == platform)
    return (f.where(C.trim_null("bill_date").isNotNull())
            .select(C.date_strict("bill_date").alias("dt"),
                    F.lit(C.PLATFORM_EL).alias("platform"),
                    C.paren_extract("shop_name").alias("store_name"),
                    F.col("order_no"),
                    C.num_or_null("receivable").alias("revenue"),
                    C.num_or_null("net_sales").alias("net_sales_total"),
                    C.num_strict("commission").alias("platform_fee_raw"),
                    C.num_strict("delivery_fee").alias("shipping_platform_raw"),
                    C.num_strict("box_fee").alias("shipping_logistics_raw")))


def jd_store_map(order_export: DataFrame, platform: str = "jd") -> DataFrame:
    """One store name per JD store id (bracket short name); ties broken by name."""
    o = (order_export.where(F.col("platform") == platform)
         .select(F.col("shop_id"), C.paren_extract("shop_name").alias("store_name")))
    return o.groupBy("shop_id").agg(F.min("store_name").alias("store_name"))


def stg_long_fees(fin_line: DataFrame, order_export: DataFrame, platform: str = "jd") -> DataFrame:
    """JD long fee lines with the store name looked up by store id."""
    f = fin_line.where(F.col("platform") == platform)
    m = jd_store_map(order_export, platform)
    return (f.where(C.trim_null("amount").isNotNull())
            .join(m, on="shop_id", how="left")
            .select(F.col("dt"),
                    F.lit(C.PLATFORM_JD).alias("platform"),
                    F.col("store_name"),
                    F.col("order_no"),
                    F.col("fee_type"),
                    C.num_strict("amount").alias("amount")))


_KEYS = ["dt", "platform", "store_name"]
# The mart's columns.
MART_COLUMNS = ["dt", "platform", "store_name", "province", "city", "has_store_ref", "revenue", "platform_fee", "platform_shipping",
                "maiyatian_shipping", "shipping", "avg_shipping", "promotion_cost", "order_count", "cost", "rent_labor",
                "rent_labor_allocated", "gross_profit", "net_profit", "store_type"]


def _platform_agg(df: DataFrame, revenue, fee, shipping) -> DataFrame:
    return df.groupBy(*_KEYS).agg(
        revenue.alias("revenue"), fee.alias("platform_fee"), shipping.alias("shipping"),
        F.countDistinct("order_no").alias("order_count"))


def mt_revenue_agg(mt: DataFrame) -> DataFrame:
    return _platform_agg(mt, F.sum("revenue"), F.abs(F.sum("platform_fee_raw")),
                         F.abs(F.sum("shipping_raw")))


def el_revenue_agg(el: DataFrame) -> DataFrame:
    return _platform_agg(
        el, F.sum("revenue"), F.abs(F.sum("platform_fee_raw")),
        F.abs(F.sum("shipping_platform_raw"))
        + F.abs(F.sum(F.coalesce("shipping_logistics_raw", F.lit(0).cast(C.NUM)))))


def jd_revenue_agg(jd: DataFrame) -> DataFrame:
    """Long fee lines → columns by conditional sums: revenue = positive lines
    that are neither commission nor shipping (a null fee type is not revenue)."""
    zero = F.lit(0).cast(C.NUM)
    fee_t, amt = F.col("fee_type"), F.col("amount")
    return _platform_agg(
        jd,
        F.sum(F.when(~fee_t.isin(JD_COMMISSION, *JD_SHIPPING) & (amt > 0), amt).otherwise(zero)),
        F.abs(F.sum(F.when(fee_t == JD_COMMISSION, amt).otherwise(zero))),
        F.abs(F.sum(F.when(fee_t.isin(*JD_SHIPPING), amt).otherwise(zero))))


def int_platform_revenue(mt: DataFrame, el: DataFrame, jd: DataFrame) -> DataFrame:
    """Uniform revenue / fee / shipping / order count per dt × platform × store."""
    cols = _KEYS + ["revenue", "platform_fee", "shipping", "order_count"]
    return (mt_revenue_agg(mt).select(cols).unionByName(el_revenue_agg(el).select(cols))
            .unionByName(jd_revenue_agg(jd).select(cols)))


def int_item_cost(item_detail: DataFrame, sku_map: DataFrame) -> DataFrame:
    """Goods cost: Σ HQ price × qty × (kingdee_qty / mini_qty, default 1).
    Unmapped SKUs cost 0; a SKU mapped to several codes fans out.

    Quantities are summed per SKU before the map is joined, so a hot SKU is
    one row per day and store; the exact products are summed per mini_qty and
    divided once.
    """
    keys = ["dt", "store_name", "platform"]
    sold = (item_detail.where(~C.trim_null("status").eqNullSafe(C.CANCELLED))
            .groupBy("dt", C.paren_extract("shop_name").alias("store_name"),
                     C.map_values("channel", CHANNEL_TO_PLATFORM).alias("platform"), "sku")
            .agg(F.sum(C.num_strict("qty")).cast("decimal(17,4)").alias("qty")))
    convertible = F.col("kingdee_qty").isNotNull() & (F.col("mini_qty") != 0)
    one = F.lit(1).cast(C.NUM)
    # (20,8) × (17,4) is exact at (38,12)
    price = (F.coalesce("headquarters_price", F.lit(0).cast(C.NUM))
             * F.when(convertible, F.col("kingdee_qty")).otherwise(one)).cast("decimal(20,8)")
    j = sold.join(sku_map, sold["sku"] == sku_map["mini_code"], "left")
    per_mini = (j.groupBy(*keys, F.when(convertible, F.col("mini_qty")).otherwise(one).alias("mini_qty"))
                .agg(F.sum(price * F.col("qty")).alias("num")))
    return per_mini.groupBy(*keys).agg(F.sum(F.col("num") / F.col("mini_qty")).alias("cost"))


def int_thirdparty_shipping(courier: DataFrame) -> DataFrame:
    """Courier cost per dt × store (shared by all platforms)."""
    c = courier.where(~C.trim_null("status").eqNullSafe(C.CANCELLED))
    return (c.groupBy(F.col("dt"), C.paren_extract("store").alias("store_name"))
            .agg(F.sum(C.num_strict("fee")).alias("maiyatian_shipping")))


def int_promotion_cost(promo_typed: DataFrame, promo_text: DataFrame) -> DataFrame:
    """Promotion per dt × platform × store: typed MT source + text EL source
    (per-row absolute value, then sum)."""
    mt = (promo_typed.groupBy("dt", "store_name")
          .agg(F.sum("amount").cast(C.NUM).alias("promotion_cost"))
          .select("dt", F.lit(C.PLATFORM_MT).alias("platform"), "store_name", "promotion_cost"))
    el = (promo_text.groupBy(C.date_strict("day").alias("dt"),
                             C.paren_extract("store").alias("store_name"))
          .agg(F.sum(F.abs(C.num_strict("spend"))).cast(C.NUM).alias("promotion_cost"))
          .select("dt", F.lit(C.PLATFORM_EL).alias("platform"), "store_name", "promotion_cost"))
    return mt.unionByName(el)


def ads_daily_report(platform_revenue: DataFrame, item_cost: DataFrame,
                     thirdparty_shipping: DataFrame, promotion: DataFrame,
                     store_ref: DataFrame) -> DataFrame:
    """Daily P&L mart, one row per dt × platform × store.

    gross_profit = revenue − cost − platform_fee; net_profit = gross_profit −
    rent allocated, where the store-day's rent is charged once, to the
    platform with the most orders (ties: platform name ascending, binary).
    Shipping and promotion are display columns, not deducted.
    """
    grain, store_day = ["dt", "platform", "store_name"], ["dt", "store_name"]
    # the three tables of this grain as one, a column per measure: one shuffle
    measures = (platform_revenue.withColumn("sold", F.lit(True))
                .unionByName(item_cost.select(*grain, "cost").na.drop(subset=grain), allowMissingColumns=True)
                .unionByName(promotion.select(*grain, "promotion_cost").na.drop(subset=grain), allowMissingColumns=True))
    amounts = ["revenue", "platform_fee", "shipping", "cost", "promotion_cost"]
    summed = (measures.groupBy(*grain).agg(F.max("sold").alias("sold"), F.sum("order_count").alias("order_count"),
                                           *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in amounts]).where("sold"))
    stores = store_ref.select(F.col("store_short_name").alias("store_name"), "province", "city",
                              F.col("daily_rent_labor").alias("rent"), F.lit(True).alias("known"))
    day = (summed.join(thirdparty_shipping.select(*store_day, F.col("maiyatian_shipping").alias("courier")), store_day, "left")
           .join(stores, "store_name", "left"))
    # a store's rent of a day is charged to the platform that comes first
    payer = F.min(F.struct((-F.col("order_count")).alias("n"), "platform")).over(Window.partitionBy(*store_day))
    whole = {"rent": F.coalesce("rent", F.lit(0)), "courier": F.coalesce("courier", F.lit(0)),
             "store_type": F.when(F.col("rent").isNotNull(), F.lit(C.DIRECT_STORE)), "pays": payer["platform"].eqNullSafe(F.col("platform"))}
    day = day.withColumns(whole)
    delivery = F.col("shipping") + F.col("courier")
    per_order = F.when(F.col("order_count") > 0, F.round(delivery / F.col("order_count"), 2)).otherwise(F.lit(0))
    money = {"revenue": F.col("revenue"), "platform_fee": F.col("platform_fee"), "platform_shipping": F.col("shipping"),
             "maiyatian_shipping": F.col("courier"), "shipping": delivery, "promotion_cost": F.col("promotion_cost"),
             "cost": F.col("cost"), "rent_labor": F.col("rent"), "rent_labor_allocated": F.when(F.col("pays"), F.col("rent")).otherwise(F.lit(0)),
             "gross_profit": F.col("revenue") - F.col("cost") - F.col("platform_fee")}
    out = day.select(*grain, "province", "city", F.col("known").isNotNull().alias("has_store_ref"), "store_type", "order_count",
                     per_order.cast("decimal(10,2)").alias("avg_shipping"), *[c.cast("decimal(14,2)").alias(k) for k, c in money.items()])
    net = (F.col("gross_profit") - F.col("rent_labor_allocated")).cast("decimal(14,2)")
    return out.withColumn("net_profit", net).select(*MART_COLUMNS)


def build_mart(v) -> DataFrame:
    """The flagship: all models composed from the raw export views ``v``."""
    rev = int_platform_revenue(stg_wide_revenue(v.fin_bill), stg_multi_revenue(v.fin_bill),
                               stg_long_fees(v.fin_line, v.order_export))
    return ads_daily_report(rev, int_item_cost(v.item_detail, v.sku_map),
                            int_thirdparty_shipping(v.courier),
                            int_promotion_cost(v.promo_typed, v.promo_text), v.store_ref)


__all__ = ["stg_wide_revenue", "stg_multi_revenue", "stg_long_fees", "jd_store_map",
           "mt_revenue_agg", "el_revenue_agg", "jd_revenue_agg", "int_platform_revenue",
           "int_item_cost", "int_thirdparty_shipping", "int_promotion_cost", "ads_daily_report",
           "build_mart"]
