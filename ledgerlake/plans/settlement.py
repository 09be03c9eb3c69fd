"""Daily store sheet: settlement matching, pending orders, store rollup, allocation.

For a business window ``[d, d_end)`` (the reference uses one day):

* anchors  = the platform's orders placed in the window (first row per order);
* finance  = the platform's finance lines of a ``lookback``-day window with no
  upper bound, one value per order (MT: latest bill row; EL/JD: sum of rows);
* matched  = anchors with finance, pending = anchors without (counted, worth 0).

Store rollups aggregate per platform shop key first (a map-side partial
aggregate, so a hot store ships one row per partition), then resolve the
shop key to a store label through the alias dimension, then roll labels up.
Sums and counts are linear, so aggregating before the alias fan-out equals
fanning out rows first.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions import predicates as P
from ..operators.joins import match_split, prefix_join, resolve_alias
from ..operators.windows import distinct_on, latest_by
from ..session import materialize

# Finance lookback in days (no upper bound); alias-dimension
# platform names per platform.
LOOKBACK_DAYS = 120
ALIAS_PLATFORMS = {
    "mt": ["美团买药"],
    "el": ["饿了么", "淘宝闪购"],
    "jd": ["京东买药", "京东小时达", "京东"],
}
MONEY = "decimal(18,2)"


@dataclass(frozen=True)
class Window:
    d: str          # first business day, 'YYYY-MM-DD'
    d_end: str      # exclusive end day

    @property
    def start(self) -> Column:
        return F.lit(self.d).cast("date")

    @property
    def end(self) -> Column:
        return F.lit(self.d_end).cast("date")

    @property
    def fin_from(self) -> Column:
        return F.date_sub(self.start, LOOKBACK_DAYS)

    @staticmethod
    def one_day(d: str) -> "Window":
        nxt = _dt.date.fromisoformat(d) + _dt.timedelta(days=1)
        return Window(d, nxt.isoformat())


def _in_window(day: Column, w: Window) -> Column:
    return (day >= w.start) & (day < w.end)


# ---------------------------------------------------------------------------
# finance per order
# ---------------------------------------------------------------------------
def mt_finance(fin_bill: DataFrame, w: Window, platform: str = "mt") -> DataFrame:
    """Latest bill row per order (bill date desc, nulls last; ties by payload)."""
    f = (fin_bill.where((F.col("platform") == platform) & (F.col("dt") >= w.fin_from))
         .where(~C.clean_text("fin_status").eqNullSafe(C.FIN_CANCELLED))
         .select(C.clean_text("order_no").alias("order_no"),
                 C.clean_text("bill_date").alias("bill_date"),
                 C.num_strict(C.clean_text("receivable")).alias("settlement_amt")))
    return latest_by(f, ["order_no"], ["bill_date"], ["settlement_amt"]).drop("bill_date")


def el_finance(fin_bill: DataFrame, w: Window, platform: str = "el") -> DataFrame:
    """Σ order receivable (regex-gated, junk → 0) per order over the window."""
    f = (fin_bill.where((F.col("platform") == platform) & (F.col("dt") >= w.fin_from))
         .select(C.clean_text("order_no").alias("order_no"),
                 C.num_or_zero("receivable", strip_tabs=True).alias("amt"))
         .where(F.col("order_no").isNotNull()))
    return f.groupBy("order_no").agg(F.sum("amt").alias("settlement_amt"))


def jd_finance(fin_line: DataFrame, w: Window, platform: str = "jd") -> DataFrame:
    """Σ settlement amount (strict) per order over the window."""
    f = (fin_line.where((F.col("platform") == platform) & (F.col("dt") >= w.fin_from))
         .select(C.clean_text("order_no").alias("order_no"),
                 C.num_strict(C.clean_text("amount")).alias("amt"))
         .where(F.col("order_no").isNotNull()))
    return f.groupBy("order_no").agg(F.sum("amt").alias("settlement_amt"))


# ---------------------------------------------------------------------------
# anchors: orders of the business window, one row per order
# ---------------------------------------------------------------------------
def _shop() -> list[Column]:
    return [C.clean_text("shop_id").alias("platform_shop_id"),
            C.clean_text("shop_name").alias("platform_shop_name")]


def mt_anchor(product_lines: DataFrame, w: Window, platform: str = "mt") -> DataFrame:
    """Product lines placed in the window (text range on the placed time);
    per order the line with the latest completion time."""
    placed = F.trim(F.replace(F.col("placed_at"), F.lit("\t"), F.lit("")))
    a = (product_lines.where(F.col("platform") == platform)
         .where(~C.clean_text("status").eqNullSafe(C.CANCELLED)
                & C.clean_text("placed_at").isNotNull()
                & (placed >= F.lit(w.d)) & (placed < F.lit(w.d_end)))
         .select(C.clean_text("order_no").alias("order_no"),
                 C.clean_text("done_at").alias("done_at"), *_shop()))
    return latest_by(a, ["order_no"], ["done_at"],
                     ["platform_shop_id", "platform_shop_name"]).drop("done_at")


def el_anchor(order_export: DataFrame, w: Window, platform: str = "el") -> DataFrame:
    """Orders of the window partitions, not cancelled and not fully refunded
    (three-valued: a null refund status drops the row), placed time in the
    window in either text format; first row per order by order sequence."""
    a = (order_export.where((F.col("platform") == platform) & _in_window(F.col("dt"), w))
         .where(P.not_cancelled_or_refunded("status", "refund_status"))
         .where(C.clean_text("placed_at").isNotNull()
                & _in_window(P.dual_format_day(C.clean_text("placed_at")), w))
         .select(C.clean_text("order_no").alias("order_no"), F.col("order_seq"), *_shop()))
    return distinct_on(a, ["order_no"],
                       [F.asc_nulls_last(c) for c in ("order_seq", "platform_shop_id",
                                                      "platform_shop_name")]).drop("order_seq")


def jd_anchor(order_export: DataFrame, w: Window, platform: str = "jd") -> DataFrame:
    """Orders of the window partitions; place time = deal time, else accept
    time; not cancelled; place time (``yyyy-MM-dd HH:mm:ss``) in the window."""
    o = (order_export.where((F.col("platform") == platform) & _in_window(F.col("dt"), w))
         .select(C.clean_text("order_no").alias("order_no"), *_shop(),
                 C.clean_text("status").alias("order_status"),
                 F.coalesce(C.clean_text("placed_at"), C.clean_text("accepted_at")).alias("place_raw")))
    b = distinct_on(o, ["order_no"], [F.asc_nulls_last(c) for c in (
        "platform_shop_id", "platform_shop_name", "order_status", "place_raw")])
    ts = F.try_to_timestamp(F.col("place_raw"), F.lit("yyyy-MM-dd HH:mm:ss"))
    return (b.where(F.col("place_raw").isNotNull()
                    & ~F.col("order_status").eqNullSafe(C.CANCELLED)
                    & (ts >= w.start.cast("timestamp_ntz")) & (ts < w.end.cast("timestamp_ntz")))
            .select("order_no", "platform_shop_id", "platform_shop_name"))


def match(v, w: Window, platform: str) -> DataFrame:
    """Anchors with ``settlement_amt`` and a ``matched`` flag."""
    if platform == "mt":
        return match_split(mt_anchor(v.product_lines, w), mt_finance(v.fin_bill, w))
    if platform == "el":
        return match_split(el_anchor(v.order_export, w), el_finance(v.fin_bill, w))
    return match_split(jd_anchor(v.order_export, w), jd_finance(v.fin_line, w))


# ---------------------------------------------------------------------------
# store rollup
# ---------------------------------------------------------------------------
def _labelled(shop_agg: DataFrame, alias: DataFrame, dim_store: DataFrame,
              platform: str) -> DataFrame:
    """Shop-key aggregates → alias rows (fan-out) → dim attributes and label."""
    r = resolve_alias(shop_agg, alias, ALIAS_PLATFORMS[platform])
    ds = dim_store.select(F.col("store_short_name").alias("_ds_name"),
                          F.col("province").alias("_ds_province"),
                          F.col("city").alias("_ds_city"),
                          F.col("store_nature").alias("_ds_nature"),
                          F.col("meituan_enterprise_rebate").alias("_ds_rebate"))
    j = r.join(ds, r["store_short_name"] == ds["_ds_name"], "left")
    return j.select(
        "*",
        F.coalesce("_ds_name", "platform_shop_name").alias("store_label"),
        F.coalesce("_ds_province", F.lit("")).alias("province"),
        F.coalesce("_ds_city", F.lit("")).alias("city"),
        F.coalesce("_ds_nature", F.lit(C.UNMATCHED)).alias("store_type"))


def shop_rollup(matched: DataFrame) -> DataFrame:
    """Anchor rows → one row per (shop id, shop name, matched) with the order
    count and settlement sum.  Partial aggregation happens map-side, so a hot
    shop sends one row per partition through the shuffle."""
    return (matched.groupBy("platform_shop_id", "platform_shop_name", "matched")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("settlement_amt").alias("amt")))


def settle_from_shops(shop: DataFrame, alias: DataFrame, dim_store: DataFrame,
                      platform: str) -> DataFrame:
    """Store-label rollup of a shop rollup (see ``settle_by_store``)."""
    lab = _labelled(shop, alias, dim_store, platform)
    g1 = ["store_label", "province", "city", "store_type", "matched"]
    # level 1: (label, province, city, type) separately for settled / pending
    l1 = lab.groupBy(*g1).agg(F.sum("n").alias("cnt"), F.sum("amt").alias("amt"),
                              F.coalesce(F.max("_ds_rebate"), F.lit(0)).alias("rate"))
    l1 = l1.withColumn("rebate", F.col("cnt") * F.col("rate"))
    m = F.col("matched")

    def s_(c):
        return F.when(m, F.col(c))

    def p_(c):
        return F.when(~m, F.col(c))

    # level 2: one row per label; settled and pending sides side by side (the
    # full outer join of the reference).  Null labels never meet across sides.
    side = F.when(F.col("store_label").isNull(), m)
    l2 = l1.groupBy("store_label", side.alias("_null_side")).agg(
        F.max(s_("province")).alias("s_province"), F.max(s_("city")).alias("s_city"),
        F.max(s_("store_type")).alias("s_type"), F.sum(s_("cnt")).alias("order_cnt"),
        F.sum(s_("amt")).alias("amt_raw"),
        F.sum(s_("rebate")).alias("rebate_amt"), F.max(s_("rate")).alias("rebate_per_order"),
        F.max(p_("province")).alias("p_province"), F.max(p_("city")).alias("p_city"),
        F.max(p_("store_type")).alias("p_type"), F.sum(p_("cnt")).alias("pending_cnt"))
    z = F.lit(0)
    settle = F.coalesce(F.col("amt_raw"), z)
    return l2.select(
        "store_label",
        F.coalesce(F.nullif("s_province", F.lit("")), "p_province", F.lit("")).alias("province"),
        F.coalesce(F.nullif("s_city", F.lit("")), "p_city", F.lit("")).alias("city"),
        F.coalesce("s_type", "p_type", F.lit(C.UNMATCHED)).alias("store_type"),
        F.coalesce("order_cnt", z).cast("bigint").alias("order_cnt"),
        settle.alias("settlement_amt"),
        F.coalesce("rebate_amt", z).alias("rebate_amt"),
        (settle + F.coalesce("rebate_amt", z)).alias("receipt_amt"),
        F.coalesce("rebate_per_order", z).alias("rebate_per_order"),
        F.coalesce("pending_cnt", z).cast("bigint").alias("pending_cnt"))


def settle_by_store(matched: DataFrame, alias: DataFrame, dim_store: DataFrame,
                    platform: str) -> DataFrame:
    """Settled and pending orders per store label, full-outer merged.

    Columns: store_label, province, city, store_type, order_cnt, settlement_amt,
    pending_cnt and, for MT, rebate_amt / receipt_amt / rebate_per_order
    (orders × per-order enterprise rebate of the store).
    """
    return settle_from_shops(shop_rollup(matched), alias, dim_store, platform)


def pending_totals(matches: dict[str, DataFrame]) -> DataFrame:
    """Pending anchor count per platform, one row (conditional aggregate)."""
    tagged = None
    for plat, m in matches.items():
        t = m.select(F.lit(plat).alias("platform"), "matched")
        tagged = t if tagged is None else tagged.unionByName(t)
    aggs = [F.count_if((F.col("platform") == p) & ~F.col("matched")).alias(f"{p}_pending_total")
            for p in matches]
    return tagged.agg(*aggs)


def pending_totals_from_shops(shops: dict[str, DataFrame]) -> DataFrame:
    """Same counts from shop rollups (Σ n of pending shop rows)."""
    tagged = None
    for plat, sh in shops.items():
        t = sh.select(F.lit(plat).alias("platform"), "matched", "n")
        tagged = t if tagged is None else tagged.unionByName(t)
    return tagged.agg(*[F.coalesce(F.sum(F.when((F.col("platform") == p) & ~F.col("matched"),
                                                 F.col("n"))), F.lit(0)).cast("bigint")
                        .alias(f"{p}_pending_total") for p in shops])


def orders_by_store(by_store: dict[str, DataFrame]) -> DataFrame:
    """Cross-platform store spine; order_cnt = matched + pending of all platforms;
    settlement = MT receipt (receivable + rebate) + EL + JD settlement.

    The spine-and-left-joins of the reference is one tagged union grouped by
    label (each platform frame has one row per label); a null label gets the
    reference's values for an unmatched spine row (zeros, '' attributes).
    """
    plats = list(by_store)
    cols = ["store_label", "province", "city", "store_type", "order_cnt", "pending_cnt",
            "settlement_amt", "rebate_amt", "receipt_amt", "rebate_per_order"]
    tagged = None
    for p, df in by_store.items():
        t = df.select(F.lit(p).alias("_plat"), *cols)
        tagged = t if tagged is None else tagged.unionByName(t)

    def pick(p, c, agg=F.max):
        return agg(F.when(F.col("_plat") == p, F.col(c)))

    aggs = []
    for p in plats:
        for c in ("province", "city", "store_type"):
            aggs.append(pick(p, c).alias(f"{p}_{c}"))
        for c in ("order_cnt", "pending_cnt", "settlement_amt", "rebate_amt", "receipt_amt",
                  "rebate_per_order"):
            aggs.append(pick(p, c, F.sum if c != "rebate_per_order" else F.max).alias(f"{p}_{c}"))
    g = tagged.groupBy("store_label").agg(*aggs)
    z = F.lit(0)
    known = F.col("store_label").isNotNull()

    def v_(p, c):
        return F.when(known, F.coalesce(F.col(f"{p}_{c}"), z)).otherwise(z)

    order_cnt = z
    settle = z
    for p in plats:
        order_cnt = order_cnt + v_(p, "order_cnt") + v_(p, "pending_cnt")
        settle = settle + v_(p, "receipt_amt" if p == "mt" else "settlement_amt")

    def attr(c, default):
        return F.when(known, F.coalesce(*[F.col(f"{p}_{c}") for p in plats], F.lit(default))) \
            .otherwise(F.lit(default))

    out = [F.col("store_label"), attr("province", "").alias("province"),
           attr("city", "").alias("city"), attr("store_type", C.UNMATCHED).alias("store_type"),
           order_cnt.cast("bigint").alias("order_cnt"), settle.alias("settlement_amt")]
    for p in plats:
        out += [v_(p, "order_cnt").cast("bigint").alias(f"{p}_order_cnt"),
                v_(p, "pending_cnt").cast("bigint").alias(f"{p}_pending_fin_cnt")]
        if p == "mt":
            out += [v_(p, "settlement_amt").alias("mt_receivable_amt"),
                    v_(p, "rebate_amt").alias("mt_qike_rebate_amt"),
                    v_(p, "receipt_amt").alias("mt_receipt_amt"),
                    v_(p, "rebate_per_order").alias("mt_qike_rebate_per_order")]
        else:
            out.append(v_(p, "settlement_amt").alias(f"{p}_settlement_amt"))
    return g.select(*out)


# ---------------------------------------------------------------------------
# courier freight, promotion, fixed cost
# ---------------------------------------------------------------------------
def freight_day(courier: DataFrame, w: Window) -> DataFrame:
    """One row: total courier freight, mean distance and order count of the
    window; duplicate legs of an order are collapsed by MAX first."""
    m = (courier.where(_in_window(F.col("dt"), w))
         .where(C.trim_null("placed_on").isNotNull() & _in_window(C.date_fmt("placed_on"), w))
         .select(C.trim_null("order_no").alias("order_no"),
                 C.num_strict("fee").alias("freight_amt"),
                 C.num_strict("dist_km").alias("dist_km")))
    per_order = m.groupBy("order_no").agg(F.max("freight_amt").alias("freight_amt"),
                                          F.max("dist_km").alias("dist_km"))
    return per_order.agg(
        F.coalesce(F.sum("freight_amt"), F.lit(0)).alias("total_freight"),
        F.coalesce(F.avg("dist_km"), F.lit(0)).alias("avg_dist_km"),
        F.count("order_no").alias("myt_order_cnt"))


def freight_allocate(orders_store: DataFrame, freight: DataFrame) -> DataFrame:
    """Window courier total allocated to stores ∝ their order count (0 when the
    window has no orders); also freight per order (null for stores without
    orders).  Totals attach as scalar subqueries — no join."""
    total_orders = orders_store.agg(F.coalesce(F.sum("order_cnt"), F.lit(0)).alias("t"))
    tf = freight.select("total_freight")
    o = orders_store.select("store_label", "order_cnt") \
        .withColumn("_tot", total_orders.scalar()).withColumn("_tf", tf.scalar())
    # cents × count is exact at (28,2); ÷ (18,0) keeps 12 decimals, enough for
    # a single rounding to cents up to some 10^9 orders
    share = (F.col("_tf").cast("decimal(18,2)") * F.col("order_cnt")).cast("decimal(28,2)")
    alloc = F.when((F.col("_tot") > 0) & F.col("_tf").isNotNull(),
                   share / F.col("_tot").cast("decimal(18,0)")).otherwise(F.lit(0))
    # alloc / order_cnt = total / total orders (same value, computed exactly)
    per_order = F.when(F.col("order_cnt") > 0,
                       F.col("_tf").cast("decimal(28,2)") / F.col("_tot").cast("decimal(18,0)"))
    return (o.withColumn("freight_alloc", alloc)
            .withColumn("freight_per_order", per_order)
            .select("store_label", "order_cnt", "freight_alloc", "freight_per_order"))


def promo_by_store(promo_text: DataFrame, alias: DataFrame, dim_store: DataFrame,
                   w: Window, platform: str = "el") -> DataFrame:
    """Cash promotion spend of the window per resolved store label."""
    p = (promo_text.where(_in_window(F.col("dt"), w))
         .where(_in_window(C.date_fmt("day"), w))
         .select(C.trim_null("shop_id").alias("platform_shop_id"),
                 C.trim_null("store").alias("platform_shop_name"),
                 C.num_strict("cash_spend").alias("promo_line")))
    shop = p.groupBy("platform_shop_id", "platform_shop_name").agg(F.sum("promo_line").alias("amt"))
    lab = _labelled(shop, alias, dim_store, platform)
    return (lab.where(F.col("store_label").isNotNull())
            .groupBy("store_label").agg(F.sum("amt").alias("promo_spend")))


def fixed_cost_enrich(fixed_cost: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Fixed cost labels with store attributes; a label matches a store whose
    short name equals it or starts with it (several matches fan out)."""
    ds = dim_store.select(F.col("store_short_name").alias("_ds_name"),
                          F.col("province").alias("_ds_province"), F.col("city").alias("_ds_city"),
                          F.col("store_nature").alias("_ds_nature"))
    j = prefix_join(fixed_cost, ds, "store_label", "_ds_name", "left")
    return j.select("store_label",
                    F.coalesce("_ds_province", C.trim_null("province")).alias("province"),
                    F.coalesce("_ds_city", C.trim_null("city")).alias("city"),
                    F.coalesce("_ds_nature", F.lit(C.UNMATCHED)).alias("store_type"),
                    F.col("daily_fixed_cost").alias("rent_util_labor_fixed"))


# ---------------------------------------------------------------------------
# the store sheet
# ---------------------------------------------------------------------------
PLATFORMS = ("mt", "el", "jd")


def store_rollups(v, w: Window) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Per platform: the shop rollup of matched / pending anchors (the only
    stage that touches order and finance rows), and its store-label rollup.
    The three shop rollups run as one job and are materialised together."""
    every = materialize(reduce(DataFrame.unionByName, [shop_rollup(match(v, w, p)).withColumn("_of", F.lit(p)) for p in PLATFORMS]))
    shops = {p: every.where(F.col("_of") == p).drop("_of") for p in PLATFORMS}
    by_store = {p: settle_from_shops(shops[p], v.store_alias, v.dim_store, p) for p in PLATFORMS}
    return shops, by_store


def orders_store(v, w: Window) -> DataFrame:
    """Materialised cross-platform store spine of the window."""
    return materialize(orders_by_store(store_rollups(v, w)[1]))


def daily_store_aggregate(v, w: Window) -> DataFrame:
    """Final store sheet of the window: one row per store label (28 columns)."""
    shops, by_store = store_rollups(v, w)
    ob = materialize(orders_by_store(by_store))
    fd = materialize(freight_day(v.courier, w))
    fa = freight_allocate(ob, fd)
    pm = promo_by_store(v.promo_text, v.store_alias, v.dim_store, w)
    fe = fixed_cost_enrich(v.fixed_cost, v.dim_store)     # dimension-only plan, cheap to repeat
    pgt = pending_totals_from_shops(shops)
    labels = (fe.select("store_label").union(ob.select("store_label"))
              .union(pm.select("store_label")).distinct()).alias("s")
    j = (labels.join(fe.alias("fe"), F.col("s.store_label") == F.col("fe.store_label"), "left")
         .join(ob.alias("ob"), F.col("s.store_label") == F.col("ob.store_label"), "left")
         .join(fa.alias("fa"), F.col("s.store_label") == F.col("fa.store_label"), "left")
         .join(pm.alias("pm"), F.col("s.store_label") == F.col("pm.store_label"), "left"))
    z = F.lit(0)

    def m(c):
        return F.coalesce(F.col(f"ob.{c}"), z).cast(MONEY).alias(c)

    def n(c):
        return F.coalesce(F.col(f"ob.{c}"), z).cast("bigint").alias(c)

    out = j.select(
        F.lit(w.d).cast("date").alias("report_date"),
        F.coalesce("fe.province", "ob.province", F.lit("")).alias("province"),
        F.coalesce("fe.city", "ob.city", F.lit("")).alias("city"),
        F.coalesce("fe.store_type", "ob.store_type", F.lit(C.UNMATCHED)).alias("store_type"),
        F.col("s.store_label").alias("store_label"),
        m("settlement_amt"), n("mt_order_cnt"), n("mt_pending_fin_cnt"), m("mt_receivable_amt"),
        m("mt_qike_rebate_amt"), m("mt_receipt_amt"), m("mt_qike_rebate_per_order"),
        n("el_order_cnt").alias("ele_order_cnt"), n("el_pending_fin_cnt").alias("ele_pending_fin_cnt"),
        m("el_settlement_amt").alias("ele_settlement_amt"),
        n("jd_order_cnt"), n("jd_pending_fin_cnt"), m("jd_settlement_amt"),
        F.lit(0).cast(MONEY).alias("zh_cost_total"),
        F.coalesce(F.col("fa.freight_alloc"), z).cast(MONEY).alias("freight_total_alloc"),
        F.col("fa.freight_per_order").cast(MONEY).alias("freight_per_order"),
        F.coalesce(F.col("ob.order_cnt"), z).cast("bigint").alias("order_cnt"),
        F.coalesce(F.col("fe.rent_util_labor_fixed"), z).cast(MONEY).alias("rent_util_labor_fixed"),
        F.coalesce(F.col("pm.promo_spend"), z).cast(MONEY).alias("promo_spend"))
    # one-row globals as scalar subqueries (no join)
    out = (out.withColumn("mt_pending_fin_match_total", pgt.select("mt_pending_total").scalar())
              .withColumn("ele_pending_fin_match_total", pgt.select("el_pending_total").scalar())
              .withColumn("jd_pending_fin_match_total", pgt.select("jd_pending_total").scalar())
              .withColumn("avg_order_distance_km_global",
                          fd.select(F.col("avg_dist_km").cast(MONEY)).scalar()))
    return out
