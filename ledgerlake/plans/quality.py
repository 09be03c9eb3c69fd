"""Data-quality jobs (§2.9) and the documented bookkeeping rules (§2.10)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cleaning as C
from . import recon as R
from . import settlement as S

# ---------------------------------------------------------------------------
# fixed values of the reference's rules
# ---------------------------------------------------------------------------
# Source freshness: warn after 2 days, error after 3 days.
FRESH_WARN_HOURS, FRESH_ERROR_HOURS = 48, 72
# Hand-checked day totals and their relative tolerances (measure, expected, tolerance).
DAY_EXPECTATIONS = [("revenue", 81152, 0.01), ("cost", 53324, 0.01), ("gross_profit", 21216, 0.01),
                    ("rent_labor_allocated", 18623, 0.0), ("net_profit", 2592, 0.05)]
# Missing-batch rule: orders at least this many days old with zero finance rows.
MISSING_BATCH_DAYS = 3
# JD hour-delivery fee type → business bucket.
JD_FEE_BUCKETS = {
    "用户实付货款": "goods",
    "优惠券-平台-小时购": "activity_subsidy", "优惠券-京东平台-小时购": "activity_subsidy",
    "京豆-平台-小时达": "activity_subsidy", "积分-平台-小时购": "activity_subsidy",
    "商家券": "merchant_subsidy", "账扣款": "merchant_subsidy", "限时抢购商家": "merchant_subsidy",
    "到家包装费": "packaging", "包装费": "packaging",
    "基础配送费": "freight", "商家承担远距离运费": "freight", "满减运费": "freight",
    "秒送基础服务费": "freight", "免运券": "freight",
    "代收到家佣金": "commission", "CPS推广服务费": "commission",
}
# P&L waterfall: the levels that make up the payable amount, those that lead
# from it to the realised one, and the level of each (platform, item).  An item
# is a bill column of an ordinary MT / EL line, the type of any other such
# line, or a JD fee type.
PAYABLE_LEVELS = ["list_price", "refund", "marketing_active", "marketing_passive", "delivery", "packaging"]
REALISED_LEVELS = ["compensation", "penalty", "other"]
WATERFALL_COLUMNS = {
    "mt": {"goods": "list_price", "shop_goods_subsidy": "marketing_active",
           "shop_delivery_subsidy": "marketing_active", "shop_bag_subsidy": "marketing_active",
           "coupon_shop": "marketing_active", "commission": "marketing_passive",
           "delivery_income": "delivery", "delivery_fee": "delivery", "delivery_rebate": "delivery",
           "box_fee": "packaging", "bag_fee": "packaging", "donation": "other"},
    "el": {"goods": "list_price", "activity_subsidy": "marketing_active", "coupon_subsidy": "marketing_active",
           "discount_total": "marketing_active", "commission": "marketing_passive",
           "pay_fee": "marketing_passive", "delivery_income": "delivery", "shop_delivery_subsidy": "delivery",
           "fulfil_fee": "delivery", "delivery_fee": "delivery", "rider_tip": "delivery", "box_fee": "packaging"},
}
WATERFALL_TYPES = {
    "mt": {"订单退款": "refund", "订单部分退款": "refund", "部分退款": "refund", "部分退款冲抵": "refund",
           "赏金联盟服务费": "marketing_active", "配送费用": "delivery", "配送小费": "delivery",
           "汽车送配送费": "delivery", "餐损赔付": "compensation", "商服赔付": "compensation",
           "合作商售后赔付": "compensation", "赔付扣款": "penalty", "医药治理": "penalty", "保险": "other"},
    "el": {"全部退单": "refund", "部分退单": "refund", "部分退款": "refund", "赔偿单": "compensation",
           "售中逆向退": "other"},
    "jd": {"用户实付货款": "list_price", "优惠券-平台-小时购": "marketing_active",
           "优惠券-京东平台-小时购": "marketing_active", "京豆-平台-小时达": "marketing_active",
           "积分-平台-小时购": "marketing_active", "商家券": "marketing_active",
           "限时抢购商家": "marketing_active", "代收到家佣金": "marketing_passive",
           "CPS推广服务费": "marketing_passive", "基础配送费": "delivery", "商家承担远距离运费": "delivery",
           "到家包装费": "packaging", "包装费": "packaging"},
}
WATERFALL_ORDINARY = ["外卖订单", "正常订单"]
WATERFALL_EXCLUDED = ["推广账户充值", "企客配送返款", "代充值预扣"]
# What an MT line's receivable is made of (platform-borne subsidies excluded).
MT_RECEIVABLE = ["goods", "delivery_income", "box_fee", "bag_fee", "shop_goods_subsidy",
                 "shop_delivery_subsidy", "shop_bag_subsidy", "coupon_shop", "commission", "delivery_fee",
                 "delivery_rebate", "donation"]
RESERVED_COLUMNS = ["box_fee", "bag_fee", "voucher"]
TOP_UP_MARK = "充值"


def _map_expr(col, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


# ---------------------------------------------------------------------------
# §2.9 data quality
# ---------------------------------------------------------------------------
def dq_not_null(mart: DataFrame, columns=("dt", "platform", "store_name")) -> DataFrame:
    """One pass over the mart: failing (null) rows per required column."""
    row = mart.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    return row.select(F.expr(f"stack({len(columns)}, {stack}) AS (column_name, failing_rows)"))


def dq_freshness(df: DataFrame, load_col: str, as_of: str, by: str | None = None) -> DataFrame:
    """Latest load time (per ``by``) against a reference time: ok / warn / error."""
    g = df.groupBy(by) if by else df.groupBy()
    out = g.agg(F.max(load_col).alias("max_load_time"))
    age = (F.unix_timestamp(F.lit(as_of).cast("timestamp_ntz"))
           - F.unix_timestamp(F.col("max_load_time"))) / 3600.0
    status = (F.when(F.col("max_load_time").isNull(), F.lit("error"))
              .when(age > FRESH_ERROR_HOURS, F.lit("error"))
              .when(age > FRESH_WARN_HOURS, F.lit("warn")).otherwise(F.lit("ok")))
    return out.withColumn("age_hours", F.floor(age).cast("bigint")).withColumn("status", status)


def dq_unmatched_store(mart: DataFrame) -> DataFrame:
    """Mart stores without a store reference (rows per store)."""
    return (mart.where(~F.col("has_store_ref")).groupBy("store_name")
            .agg(F.count(F.lit(1)).alias("mart_rows")))


def key_sample(df: DataFrame, by: str, key: str, k: int) -> DataFrame:
    """(by, sample): the ``k`` keys of each group that come first by their
    MD5, comma-joined.

    The same whatever the partitioning, and mergeable: the first k of two
    parts' first k are the whole's.  Each task keeps k keys of a group before
    anything is shuffled.
    """
    keys = df.select(by, F.col(key).cast("string").alias("_key")).where(F.col("_key").isNotNull()).distinct()
    keys = keys.withColumn("_hash", F.md5(F.col("_key").cast("binary")))
    first = keys.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy("_hash", "_key"))).where(F.col("_n") <= k)
    inner = F.array_sort(F.collect_list(F.struct("_n", "_key")))
    return first.groupBy(by).agg(F.array_join(F.transform(inner, lambda x: x["_key"]), ",").alias("sample"))


def dq_load_summary(df: DataFrame, amount_col: str, day_col: str = "dt", key_col: str | None = None, k: int = 5) -> DataFrame:
    """Per loaded day: row count and amount sum, and a sample of ``k`` keys."""
    out = df.groupBy(day_col).agg(F.count(F.lit(1)).alias("rows"),
                                  F.coalesce(F.sum(amount_col), F.lit(0)).alias("amount"))
    if key_col is None:
        return out
    sample = key_sample(df, day_col, key_col, k).withColumnRenamed(day_col, "_day")
    return out.join(sample, F.col(day_col).eqNullSafe(F.col("_day")), "left").drop("_day")


def dq_tolerance_check(mart: DataFrame, day: str, expectations=DAY_EXPECTATIONS) -> DataFrame:
    """The mart's totals of one day vs the figures checked by hand for that
    day, each with its relative tolerance; a day without rows has null
    actuals and passes nothing."""
    sums = mart.where(F.col("dt") == F.lit(day).cast("date")).agg(*[F.sum(m).alias(m) for m, _, _ in expectations])
    checks = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("decimal(18,2)").alias("actual"),
                                F.lit(e).cast("decimal(18,2)").alias("expected"),
                                F.lit(t).cast("decimal(6,4)").alias("tolerance")) for m, e, t in expectations])
    return sums.select(F.lit(day).cast("date").alias("dt"), F.inline(checks)).withColumn(
        "passed", F.coalesce(F.abs(F.col("actual") - F.col("expected")) <= F.col("expected") * F.col("tolerance"),
                             F.lit(False)))


# ---------------------------------------------------------------------------
# §2.10 documented rules
# ---------------------------------------------------------------------------
def el_window_rows(v, w: S.Window) -> DataFrame:
    """EL finance rows billed inside the window, receivable gated (junk → null)."""
    return (v.fin_bill.where((F.col("platform") == "el") & S._in_window(F.col("dt"), w))
            .select(C.clean_text("order_no").alias("order_no"), "shop_id",
                    C.clean_text("order_type").alias("order_type"),
                    C.num_or_null("receivable", strip_tabs=True).alias("amt")))


def window_anchor_keys(v, w: S.Window) -> DataFrame:
    """Orders of the EL export placed in the window (no status filter)."""
    return R.el_order_anchor_all(v.order_export, w).select("order_no")


def rule_all_txn_match(v, w: S.Window) -> DataFrame:
    """Matched orders valued over *all* their finance rows (every transaction
    type), not one row per order."""
    a = S.el_anchor(v.order_export, w).select("order_no")
    f = R.el_fin_rows(v.fin_bill, w)
    per = f.groupBy("order_no").agg(F.count(F.lit(1)).alias("txn_rows"),
                                    F.sum("settlement").alias("settlement_sum"),
                                    F.countDistinct("order_type").alias("txn_types"))
    return a.join(per, "order_no", "inner")


def classify_window_rows(v, w: S.Window) -> DataFrame:
    """Finance rows of the window by class: matched (every transaction of a
    live order placed in the window, refunds included) / same_day_refund (of
    an order placed in the window that isn't live) / delayed_refund /
    cross_day / top_up / other."""
    rows = el_window_rows(v, w)
    live = S.el_anchor(v.order_export, w).select("order_no").distinct().withColumn("_live", F.lit(True))
    anchors = window_anchor_keys(v, w).withColumn("_in", F.lit(True))
    j = rows.join(anchors, "order_no", "left").join(live, "order_no", "left")
    amt = F.col("amt")
    cls = (F.when(F.coalesce(F.col("order_type"), F.lit("")).contains(TOP_UP_MARK), F.lit("top_up"))
           .when(F.col("order_no").isNull() | amt.isNull(), F.lit("other"))
           .when(F.col("_live"), F.lit("matched"))
           .when(F.col("_in") & (amt < 0), F.lit("same_day_refund"))
           .when(F.col("_in"), F.lit("other"))
           .when(amt < 0, F.lit("delayed_refund"))
           .otherwise(F.lit("cross_day")))
    return j.withColumn("row_class", cls).drop("_in", "_live")


def rule_cross_day_class(v, w: S.Window) -> DataFrame:
    c = classify_window_rows(v, w)
    return c.groupBy("row_class").agg(F.count(F.lit(1)).alias("rows"),
                                      F.coalesce(F.sum("amt"), F.lit(0)).alias("amount"))


def rule_delayed_refund(v, w: S.Window) -> DataFrame:
    """Refund rows whose order was not placed in the window: a separate
    bucket per shop, still deducted."""
    c = classify_window_rows(v, w).where(F.col("row_class") == "delayed_refund")
    return c.groupBy("shop_id").agg(F.count(F.lit(1)).alias("refund_rows"),
                                    F.sum("amt").alias("delayed_refund_amt"))


def rule_pending_by_store(v, w: S.Window) -> DataFrame:
    """Pending orders of each platform listed per store with count and amount
    (the window's largest listed receivable of that platform's order)."""
    amounts = (v.order_export.where(S._in_window(F.col("dt"), w))
               .select("platform", C.clean_text("order_no").alias("order_no"),
                       C.num_or_null("receivable", strip_tabs=True).alias("amount"))
               .groupBy("platform", "order_no").agg(F.max("amount").alias("amount")))
    pending = reduce(DataFrame.unionByName, [
        S.match(v, w, p).where(~F.col("matched")).select(F.lit(p).alias("platform"), "order_no", "platform_shop_name")
        for p in S.PLATFORMS])
    return pending.join(amounts, ["platform", "order_no"], "left").groupBy(
        "platform", C.paren_extract("platform_shop_name").alias("store_name")).agg(
        F.count(F.lit(1)).alias("pending_orders"), F.coalesce(F.sum("amount"), F.lit(0)).alias("pending_amount"))


def rule_missing_batch(v, as_of: str) -> DataFrame:
    """Per platform and order day at least 3 days before ``as_of``: days with
    orders but no finance row for any of them (a whole batch not fetched)."""
    orders = v.order_export.select("platform", "dt", C.clean_text("order_no").alias("order_no"))
    fin_keys = (v.fin_bill.select("platform", C.clean_text("order_no").alias("order_no"))
                .where(F.col("platform").isin("mt", "el"))
                .unionByName(v.fin_line.where(F.col("platform") == "jd")
                             .select("platform", C.clean_text("order_no").alias("order_no")))
                .where(F.col("order_no").isNotNull()).distinct().withColumn("_fin", F.lit(1)))
    j = orders.join(fin_keys, ["platform", "order_no"], "left")
    old = F.col("dt") <= F.date_sub(F.lit(as_of).cast("date"), MISSING_BATCH_DAYS)
    g = j.where(old).groupBy("platform", "dt").agg(F.count(F.lit(1)).alias("orders"),
                                                  F.coalesce(F.sum("_fin"), F.lit(0)).alias("orders_with_finance"))
    return g.where(F.col("orders_with_finance") == 0)


def rule_unknown_fee_type(v) -> DataFrame:
    """JD fee types outside the bucket classification (null included): alert rows."""
    f = v.fin_line.where(F.col("platform") == "jd").select(
        C.clean_text("fee_type").alias("fee_type"), C.num_or_null("amount").alias("amount"))
    known = f.sparkSession.createDataFrame([(k,) for k in JD_FEE_BUCKETS], "fee_type string")
    unknown = f.join(F.broadcast(known), "fee_type", "left_anti")
    return unknown.groupBy("fee_type").agg(F.count(F.lit(1)).alias("rows"),
                                           F.coalesce(F.sum("amount"), F.lit(0)).alias("amount"))


def rule_reserved_column(v) -> DataFrame:
    """Reserved bill columns that carry non-zero values (count per column)."""
    counts = [F.struct(F.lit(c).alias("column_name"),
                       F.count_if(F.coalesce(C.num_or_null(c), F.lit(0)) != 0).alias("nonzero_rows"))
              for c in RESERVED_COLUMNS]
    return v.fin_bill.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def rule_mt_rebuild(v) -> DataFrame:
    """MT bill lines: receivable vs goods + delivery + box + bag + merchant
    promotion + commission + delivery fee + rebate + donation (subsidies that
    the platform bears are no part of it)."""
    f = v.fin_bill.where(F.col("platform") == "mt")
    rebuilt = R.total([F.coalesce(C.num_dash_null(c), F.lit(0)) for c in MT_RECEIVABLE])
    return f.select("order_no", "line_no", C.num_strict("receivable").alias("receivable"),
                    rebuilt.alias("rebuilt")).withColumn("diff", F.col("receivable") - F.col("rebuilt"))


def rule_el_identity(v) -> DataFrame:
    """EL: Σ settlement = Σ receivable + Σ settlement of compensation rows
    = Σ net sales + Σ service fees + compensation.  One row."""
    f = v.fin_bill.where(F.col("platform") == "el")
    comp = F.coalesce(F.col("order_type"), F.lit("")).contains(R.COMPENSATION_MARK)
    s, r = C.num_or_zero("settlement"), C.num_or_zero("receivable")
    agg = f.agg(F.sum(s).alias("sum_settlement"), F.sum(r).alias("sum_receivable"),
                F.sum(F.when(comp, s).otherwise(F.lit(0))).alias("sum_comp_settlement"),
                F.sum(C.num_or_zero("net_sales")).alias("sum_net_sales"),
                F.sum(C.num_or_zero("service_fee")).alias("sum_service_fee"))
    return agg.select("*",
                      (F.col("sum_settlement") - F.col("sum_receivable") - F.col("sum_comp_settlement"))
                      .alias("gap_receivable_identity"),
                      (F.col("sum_settlement") - F.col("sum_net_sales") - F.col("sum_service_fee")
                       - F.col("sum_comp_settlement")).alias("gap_component_identity"))


def rule_jd_fee_buckets(v) -> DataFrame:
    """JD fee lines summed per shop and business bucket (pivot)."""
    f = v.fin_line.where(F.col("platform") == "jd").select(
        "shop_id", _map_expr(C.clean_text("fee_type"), JD_FEE_BUCKETS, "unclassified").alias("bucket"),
        C.num_or_null("amount").alias("amount"))
    buckets = sorted(set(JD_FEE_BUCKETS.values())) + ["unclassified"]
    return f.groupBy("shop_id").pivot("bucket", buckets).agg(F.sum("amount"))


def waterfall_items(v) -> DataFrame:
    """(platform, shop_id, item, level1, amount): an ordinary or untyped MT / EL
    line by its columns, any other by its type (MT receivable, EL settlement),
    JD lines by fee type.  Top-ups and the like are left out; an item that the
    tables above don't know has level ``unclassified``."""
    kind = C.clean_text("order_type")
    level = F.col("level1")
    parts = []
    for p, amount in (("mt", "receivable"), ("el", "settlement")):
        columns = F.array(*[F.struct(F.lit(c).alias("item"), F.lit(lv).alias("level1"), C.num_or_null(c).alias("amount"))
                            for c, lv in WATERFALL_COLUMNS[p].items()])
        typed = F.array(F.struct(kind.alias("item"), _map_expr(kind, WATERFALL_TYPES[p]).alias("level1"),
                                 C.num_or_null(amount).alias("amount")))
        ordinary = kind.isNull() | kind.isin(WATERFALL_ORDINARY)
        parts.append(v.fin_bill.where((F.col("platform") == p)
                                      & ~F.coalesce(kind.isin(WATERFALL_EXCLUDED), F.lit(False)))
                     .select("platform", "shop_id", F.inline(F.when(ordinary, columns).otherwise(typed))))
    fee = C.clean_text("fee_type")
    parts.append(v.fin_line.where(F.col("platform") == "jd")
                 .select("platform", "shop_id", fee.alias("item"),
                         _map_expr(fee, WATERFALL_TYPES["jd"]).alias("level1"), C.num_or_null("amount").alias("amount")))
    return reduce(DataFrame.unionByName, parts).withColumn("level1", F.coalesce(level, F.lit("unclassified")))


def rule_waterfall(v) -> DataFrame:
    """P&L waterfall per platform × shop: level-1 sums, payable (list price to
    packaging) and realised (payable, compensation, penalty, other).  What is
    unclassified enters neither: it has a column of its own, as an alert."""
    levels = PAYABLE_LEVELS + REALISED_LEVELS
    wide = waterfall_items(v).groupBy("platform", "shop_id").pivot("level1", levels + ["unclassified"]) \
        .agg(F.sum("amount"))

    def line(names):
        return R.total([F.coalesce(F.col(c), F.lit(0)) for c in names])

    return wide.withColumn("payable", line(PAYABLE_LEVELS)).withColumn("realised", line(levels))


def rule_city_rebate(v) -> DataFrame:
    """MT enterprise rebate per city: valid orders × the city's per-order rate;
    cancelled or fully refunded orders earn nothing."""
    rates = v.dim_store.groupBy("city").agg(F.max("meituan_enterprise_rebate").alias("rate"))
    stores = v.dim_store.select("store_short_name", "city")
    o = (v.order_export.where(F.col("platform") == "mt")
         .select(C.paren_extract(C.clean_text("shop_name")).alias("store_short_name"),
                 F.coalesce((C.clean_text("status") == C.CANCELLED)
                            | (C.clean_text("refund_status") == C.FULL_REFUND), F.lit(False)).alias("void")))
    j = o.join(stores, "store_short_name", "inner").join(rates, "city", "left")
    return j.groupBy("city").agg(F.count_if(~F.col("void")).alias("valid_orders"),
                                 F.sum(F.when(~F.col("void"), F.coalesce("rate", F.lit(0)))
                                       .otherwise(F.lit(0))).alias("rebate"))
