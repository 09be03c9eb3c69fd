"""Ingestion, sink and schema queries (§2.1).

File-based keys first export the raw views as files (``export_fixtures``),
then run the loader on them; results name export folders relative to the
export root (Spark's part-file names are random).
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import money_all, query
from ..functions import cleaning as C
from ..oracle_sql import ORACLES, clean, gate, reg, tnull
from ..session import materialize, scratch_path, shuffles_removed, stored
from ..sources import export_fixtures as X
from ..sources import files as FL
from ..sources import schema as SC
from ..sources import sinks as SK
from ..sources import slices as SL
from ..sources import split_files as SF

M2 = "DECIMAL(18,2)"
ROUTING_RULES = [
    ("mt_orders", "*/csv/platform=mt/*.csv", "ods_mt_order"),
    ("el_orders", "*/csv/platform=el/*.csv", "ods_el_order"),
    ("any_csv", "*.csv", "ods_jd_order"),          # first match wins: mt/el never reach it
    ("courier_html", "*/html/*.txt", "ods_courier"),
    ("bill_xml", "*/xml/*.txt", "ods_el_fin"),
]
SKIP = ["*/_SUCCESS", "*.crc"]
ALIAS_BUCKETS = 16          # of the alias dimension, a row per store and platform


def _rel(root, path="path"):
    """Export-relative directory of a file (part-file names are random), down
    to its shop."""
    rel = F.regexp_replace(F.col(path), r"^.*?" + root.split("/")[-1] + "/", "")
    return F.regexp_replace(rel, r"(/part=[0-9]+)?/[^/]+$", "")


def _export_all(v):
    root = X.new_root(v.spark)
    X.export_csv(v, root, compression="gzip")
    X.export_html(v, root)
    X.export_spreadsheetml(v, root)
    return root


@query("src_route_files")
def src_route_files(v):
    """Route the exported files to target tables; first matching glob wins."""
    root = _export_all(v)
    r = FL.route_files(FL.list_files(v.spark, root), ROUTING_RULES, SKIP)
    return r.select(_rel(root).alias("folder"), "rule", "target", "status")


@query("src_completeness_guard")
def src_completeness_guard(v):
    """Files per target vs the required minimum (the load fails when short)."""
    root = _export_all(v)
    r = FL.route_files(FL.list_files(v.spark, root), ROUTING_RULES, SKIP)
    return FL.completeness_guard(r, {t: 1 for _, _, t in ROUTING_RULES})


@query("src_filename_tag")
def src_filename_tag(v):
    """Store tag from the export path (group 1 of a pattern), else a default."""
    root = X.new_root(v.spark)
    X.export_csv(v, root)
    f = FL.list_files(v.spark, root, "*.csv")
    return f.select(_rel(root).alias("folder"),
                    FL.filename_tag(F.col("path"), r"shop_id=([0-9]+)/", "未知门店").alias("_store_tag"),
                    FL.filename_tag(F.col("path"), r"platform=(zz)/", "default").alias("_account_type"))


def _csv_rows(v, **kw):
    root = X.new_root(v.spark)
    X.export_csv(v, root, **kw)
    return root, SF.read_csv(v.spark, f"{root}/csv/*/*/*.csv", declared="GBK")


@query("src_csv_text")
def src_csv_text(v):
    """CSV exports read as all-text with a per-file encoding (UTF-8 or GBK)."""
    _, rows = _csv_rows(v)
    return rows.drop("_source_file", "_path")


@query("src_union_by_name")
def src_union_by_name(v):
    """Files of one table stacked with an outer union of their columns: two
    platforms' files lack one."""
    _, rows = _csv_rows(v, narrow=("el", "jd"))
    return rows.drop("_source_file", "_path")


@query("src_stamp_meta")
def src_stamp_meta(v):
    """Loaded rows stamped with partition day, source file and load time; the
    file is shown by its folder (Spark names the files), the load time by
    whether it lies in the last hour."""
    root, rows = _csv_rows(v)
    out = FL.stamp(rows, "2026-03-25", {"_store_type": "直营"}, source_col="_source_file")
    recent = F.col("_load_time").between(F.current_timestamp() - F.expr("INTERVAL 1 HOUR"), F.current_timestamp())
    named = F.col("_path").endswith(F.concat(F.lit("/"), F.col("_source_file")))
    return (out.withColumn("_folder", _rel(root, "_path")).withColumn("_loaded_now", recent).withColumn("_named", named)
            .drop("_path", "_source_file", "_load_time"))


@query("src_html_table")
def src_html_table(v):
    """Courier HTML pages (first table) → rows; text 'nan' → null."""
    root = X.new_root(v.spark)
    path = X.export_html(v, root)
    cells = SF.html_cells(v.spark, f"{path}/*/*/*.txt.gz", by_row=True)
    return FL.cells_to_rows(cells, FL.header_names(cells, 0), 1, drop_blank=False).drop("file", "sheet", "row")


@query("src_spreadsheetml")
def src_spreadsheetml(v):
    """SpreadsheetML bill workbooks → rows (sparse indexes filled, entities cleaned)."""
    root = X.new_root(v.spark)
    path = X.export_spreadsheetml(v, root)
    cells = SF.spreadsheetml_cells(v.spark, f"{path}/*/*/*.txt.gz", by_row=True)
    return FL.cells_to_rows(cells, FL.header_names(cells, 0, numbered=True), 1).drop("file", "sheet", "row")


def _daily(prefix: str, tail: str = ".xlsx"):
    """Name of a shop's file of one day."""
    return F.concat(F.lit(prefix), F.col("shop_id"), F.lit("-"), F.col("dt").cast("string"), F.lit(tail))


def _promo_sheet(v, **kw):
    p = v.promo_text
    cols = {"day": "日期", "shop_id": "门店ID", "store": "门店名称", "spend": "推广消费（元）",
            "cash_spend": "推广现金消费/元"}
    return X.sheet_cells(p, _daily("推广-"), cols, ["day", "spend", "cash_spend", "store"], **kw)


@query("src_sheet_single")
def src_sheet_single(v):
    """Workbooks, one worksheet per file, header in row 0, decoded as all text."""
    cells = materialize(FL.workbook_cells(X.workbooks(_promo_sheet(v)), header_rows=1))
    return FL.cells_to_rows(cells, FL.header_names(cells, 0), 1, drop_blank=False).drop("sheet", "row")


def _book(prefix: str):
    """Name of one of a shop's workbooks: the first has no number."""
    number = F.when(F.col("part") > 0, F.concat(F.lit("-"), F.col("part").cast("string"))).otherwise(F.lit(""))
    return F.concat(F.lit(prefix), F.col("shop_id"), number, F.lit(".xlsx"))


@query("src_sheet_multi")
def src_sheet_multi(v):
    """Workbooks with several worksheets → several tables; rows above the
    header skipped; a requested sheet that is missing is ignored."""
    lines = X.in_parts(v.fin_bill.where(F.col("platform") == "mt"), ["shop_id"], ["order_no", "line_no"])
    detail = X.sheet_cells(lines, _book("账单-"), {"order_no": "订单号", "settlement": "商家应收款", "bill_date": "账单日期"},
                           ["order_no", "line_no", "dt", "settlement"], sheet="订单明细", title_rows=2)
    days = lines.groupBy("shop_id", "dt").agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit(0))
    summary = X.sheet_cells(days, _book("账单-"), {"dt": "日期", "n": "笔数"}, ["dt"], sheet="账单明细")
    wanted = (("订单明细", 2), ("账单明细", 0), ("处罚&赔付", 0))
    cells = stored(FL.workbook_cells(X.workbooks(detail.unionByName(summary)), [s for s, _ in wanted], header_rows=0))
    out = None
    for sheet, header_row in wanted:
        s = cells.where(F.col("sheet") == sheet)
        h = FL.header_names(s, header_row)
        if h.limit(1).count() == 0:      # missing sheet: nothing emitted
            continue
        t = FL.cells_to_rows(s, h, header_row + 1)
        long = t.select("file", "sheet", "row", F.explode(F.map_from_arrays(
            F.array(*[F.lit(c) for c in t.columns if c not in ("file", "sheet", "row")]),
            F.array(*[F.col(f"`{c}`") for c in t.columns if c not in ("file", "sheet", "row")]))))
        out = long if out is None else out.unionByName(long)
    return out.select("sheet", "key", "value")


@query("src_header_flatten")
def src_header_flatten(v):
    """Workbooks whose two header rows hold merged cells, flattened to
    ``group_sub`` names."""
    b = X.in_parts(v.fin_bill.where(F.col("platform") == "el"), ["shop_id"], ["order_no", "line_no"])
    cols = {"order_no": "订单号", "goods": "商品金额", "delivery_income": "物流净营业额", "subsidy": None,
            "commission": "实收佣金", "delivery_fee": "履约技术服务费", "settlement": "结算金额"}
    groups = {"order_no": "订单号", "goods": "商家收入", "commission": "商家支出", "settlement": "合计"}
    cells = X.sheet_cells(b, _book("销售明细-"), cols, ["order_no", "line_no", "dt", "settlement"], group_row=groups, by_row=True)
    books = X.workbooks(cells, {"Sheet1": ["A1:A2", "B1:D1", "E1:F1"]})
    with shuffles_removed(v.spark):
        cells = FL.workbook_cells(books, header_rows=2, by_row=True)
    return FL.cells_to_rows(cells, FL.merged_header_names(cells, 0), 2).drop("sheet", "row")


@query("src_sanitize_columns")
def src_sanitize_columns(v):
    """Header cells → sanitised, de-duplicated column names per file."""
    cells = _promo_sheet(v)
    dup = cells.where(F.col("row") == 0).withColumn("col", F.col("col") + 10)   # repeated header block
    return FL.header_names(cells.unionByName(dup), 0).select("file", "col", "name")


@query("src_align_columns")
def src_align_columns(v):
    """Files with an extra leading unnamed column: aligned to the narrowest
    layout between named anchors, then stacked."""
    p = v.promo_text
    even = (F.col("shop_id").cast("int") % 2) == 0
    narrow = X.sheet_cells(p.where(even), _daily("a-"),
                           {"day": "日期", "shop_id": "", "store": "门店名称", "spend": ""}, ["day", "store", "spend"])
    wide = X.sheet_cells(p.where(~even).withColumn("pad", F.lit("x")), _daily("b-"),
                         {"day": "日期", "pad": "", "shop_id": "", "store": "门店名称", "spend": ""},
                         ["day", "store", "spend"])
    frames = {}
    for name, cells in (("a.xlsx", narrow), ("b.xlsx", wide)):
        h = cells.where(F.col("row") == 0).select("file", "sheet", "col", F.when(
            F.trim("value") == "", F.concat(F.lit("col_"), F.col("col").cast("string")))
            .otherwise(F.trim("value")).alias("name"))
        frames[name] = (FL.cells_to_rows(cells, h, 1, drop_blank=False),
                        [r[0] for r in h.select("col", "name").distinct().orderBy("col").select("name").collect()])   # header names only
    plans = FL.align_plans({k: cols for k, (_, cols) in frames.items()})
    aligned = [FL.apply_plan(df.select(*cols), plans[k]) for k, (df, cols) in frames.items()]
    return FL.union_by_name(aligned)


@query("src_drop_blank_rows")
def src_drop_blank_rows(v):
    """Rows whose business cells are all blank are dropped (sheet readers)."""
    cells = _promo_sheet(v, blank_every=5)
    return FL.cells_to_rows(cells, FL.header_names(cells, 0), 1, drop_blank=True).drop("sheet", "row")


@query("src_scan_table")
def src_scan_table(v):
    """Read a source table (column-pruned parquet scan)."""
    return v.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")


reg("src_scan_table", [], "SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders")


WHITELIST = ["order_no", "shop_id", "shop_name", "status", "receivable", "not_in_export"]


@query("src_whitelist_project")
def src_whitelist_project(v):
    """Keep only whitelisted columns by exact name (missing ones reported)."""
    df, missing = FL.whitelist(v.order_export, WHITELIST)
    return df


reg("src_whitelist_project", ["order_export"], "SELECT order_no, shop_id, shop_name, status, receivable FROM order_export")


# ---------------------------------------------------------------------------
# sinks
# ---------------------------------------------------------------------------
@query("sink_replace_partition")
def sink_replace_partition(v):
    """Daily loads replace only their own ``dt`` partitions (idempotent)."""
    path = scratch_path(v.spark, f"ods_fin_line/{X.new_root(v.spark).split('/')[-1]}")
    f = v.fin_line.select("order_no", "line_no", "fee_type", "amount", "dt")
    SL.replace(f, path, "dt")
    # reload two days: same rows again plus a marker, then reload them clean
    days = f.where(F.col("dt").isin(F.lit("1996-01-02").cast("date"), F.lit("1996-01-03").cast("date")))
    SL.replace(days.withColumn("fee_type", F.lit("stale")), path, "dt")
    SL.replace(days, path, "dt")
    return SL.read(v.spark, path)


@query("sink_upsert_last_wins")
def sink_upsert_last_wins(v):
    """Alias dimension upserted by key; the later source row wins."""
    tgt = v.store_alias
    n = v.nation.where(F.col("n_nationkey") >= 20)
    src = n.select(F.col("n_nationkey").cast("string").alias("platform_store_id"),
                   F.concat(F.lit("New-"), F.col("n_name")).alias("store_name"),
                   F.lit("淘宝闪购").alias("platform"), F.col("n_name").alias("store_short_name"),
                   F.lit(1).alias("_pos")).unionByName(
        n.select(F.col("n_nationkey").cast("string").alias("platform_store_id"),
                 F.concat(F.lit("Newer-"), F.col("n_name")).alias("store_name"),
                 F.lit("淘宝闪购").alias("platform"), F.col("n_name").alias("store_short_name"),
                 F.lit(2).alias("_pos")))
    path = scratch_path(v.spark, f"dim_alias/{X.new_root(v.spark).split('/')[-1]}")
    keys = ["platform_store_id", "platform"]
    SL.create_keyed(tgt, path, keys, ALIAS_BUCKETS)
    SL.upsert(src, path, keys, "_pos", ALIAS_BUCKETS)
    return SL.read_keyed(v.spark, path)


reg("sink_upsert_last_wins", ["store_alias"], """
WITH src AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS platform_store_id, 'Newer-' || n_name AS store_name,
         '淘宝闪购' AS platform, n_name AS store_short_name FROM nation WHERE n_nationkey >= 20)
SELECT t.* FROM store_alias t
WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.platform_store_id = t.platform_store_id AND s.platform = t.platform)
UNION ALL SELECT * FROM src""")


@query("dim_alias_seed")
def dim_alias_seed(v):
    """Seed aliases for the stores that have none (two platforms, three stores)."""
    n = v.nation.where(F.col("n_nationkey") >= 22)
    seeds = None
    for plat in ("美团买药", "淘宝闪购"):
        s = n.select((F.lit(9000) + F.col("n_nationkey")).cast("string").alias("platform_store_id"),
                     F.concat(F.lit("Brand（"), F.col("n_name"), F.lit("）")).alias("store_name"),
                     F.lit(plat).alias("platform"), F.col("n_name").alias("store_short_name"), F.lit(0).alias("_pos"))
        seeds = s if seeds is None else seeds.unionByName(s)
    return SK.upsert_last_wins(v.store_alias, seeds, ["platform_store_id", "platform"], "_pos")


reg("dim_alias_seed", ["store_alias"], """
WITH src AS (
  SELECT CAST(9000 + n_nationkey AS VARCHAR) AS platform_store_id, 'Brand（' || n_name || '）' AS store_name,
         p.platform, n_name AS store_short_name
  FROM nation CROSS JOIN (SELECT '美团买药' AS platform UNION ALL SELECT '淘宝闪购') p
  WHERE n_nationkey >= 22)
SELECT t.* FROM store_alias t
WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.platform_store_id = t.platform_store_id AND s.platform = t.platform)
UNION ALL SELECT * FROM src""")


@query("sink_truncate_reload")
def sink_truncate_reload(v):
    """A dimension replaced as a whole."""
    path = scratch_path(v.spark, f"dim_store/{X.new_root(v.spark).split('/')[-1]}")
    # yesterday's (empty) dimension, then the whole reload replaces it
    SK.truncate_reload(v.spark.createDataFrame([], v.dim_store.schema), path)
    SK.truncate_reload(v.dim_store, path)
    return v.spark.read.parquet(path)


@query("sink_update_from")
def sink_update_from(v):
    """Store reference: daily rent updated from a keyed list (positive values
    rounded to cents); keys of the list not found are reported separately."""
    src = v.fixed_cost.select(F.col("store_label").alias("store_short_name"),
                              (F.col("daily_fixed_cost") * F.lit(1.5).cast("decimal(3,2)")).alias("daily_rent_labor"))
    updated, _missing = SK.update_from(v.store_ref, src, "store_short_name", "daily_rent_labor")
    return updated


reg("sink_update_from", ["store_ref", "fixed_cost"], """
SELECT r.store_short_name, r.province, r.city,
       COALESCE(CAST(ROUND(s.v, 2) AS DECIMAL(10,4)), r.daily_rent_labor) AS daily_rent_labor
FROM store_ref r LEFT JOIN (SELECT store_label, daily_fixed_cost * CAST(1.5 AS DECIMAL(3,2)) AS v
                            FROM fixed_cost WHERE daily_fixed_cost * CAST(1.5 AS DECIMAL(3,2)) > 0) s
  ON s.store_label = r.store_short_name""")


@query("sink_materialize")
def sink_materialize(v):
    """The mart written as a table and read back (models stay views)."""
    from ..plans.models import build_mart
    path = scratch_path(v.spark, f"ads_daily_report/{X.new_root(v.spark).split('/')[-1]}")
    return SK.materialize_table(build_mart(v), path=path, view="ads_o2o_daily_report")


@query("sink_temp_result")
def sink_temp_result(v):
    """One computed set, materialised once, feeding two results: failures and summary."""
    from ..plans import recon as R
    from ..plans import settlement as S
    checked = materialize(R.jd_subsidies(v, S.Window("1900-01-01", "2100-01-01")))
    fails = checked.where(F.col("reason").isNotNull()).select(
        F.lit("fail").alias("part"), F.col("order_no").alias("k"), F.col("settled").cast(M2).alias("amount"))
    summ = R.jd_subsidy_summary(checked).select(
        F.lit("summary").alias("part"), F.col("dt").cast("string").alias("k"),
        F.col("settled_total").cast(M2).alias("amount"))
    return fails.unionByName(summ)


# ---------------------------------------------------------------------------
# schema
# ---------------------------------------------------------------------------
DECLARED_ORDER_COLUMNS = ["order_no", "shop_id", "shop_name", "status", "refund_status", "placed_at",
                          "receivable", "store_type_tag"]


@query("schema_conform")
def schema_conform(v):
    """Conform the order export to its declared schema (missing → typed null)."""
    schema = SC.text_schema(DECLARED_ORDER_COLUMNS)
    return SC.conform(v.order_export.drop("receivable_fmt"), schema).drop("_load_time")


@query("schema_evolve")
def schema_evolve(v):
    """Finance lines landed in two loads: days before 1996 without the amount
    column and with an int width, later ones with the amount and a wider
    number.  Both are read together under the newest columns."""
    path = scratch_path(v.spark, f"ods_evolving/{X.new_root(v.spark).split('/')[-1]}")
    f = v.fin_line.select("order_no", F.length("order_no").alias("width"), "fee_type", "amount", "dt")
    early = F.col("dt") < F.lit("1996-01-01").cast("date")
    SL.replace(f.where(early).drop("amount"), path, "dt")
    SL.replace(f.where(~early).withColumn("width", F.col("width").cast("bigint")), path, "dt")
    return SL.read(v.spark, path)


reg("schema_evolve", ["fin_line"], """
SELECT order_no, CAST(LENGTH(order_no) AS BIGINT) AS width, fee_type,
       CASE WHEN dt >= DATE '1996-01-01' THEN amount END AS amount, dt
FROM fin_line WHERE dt IS NOT NULL""")


@query("schema_drift_report")
def schema_drift_report(v):
    """Declared vs existing columns of the order export: new / extra / ok, with
    the rows that fill each existing column."""
    return SC.drift_report(v.order_export, DECLARED_ORDER_COLUMNS)


@query("schema_discover")
def schema_discover(v):
    """Observed business columns of each raw export view and the rows that fill them."""
    out = None
    for name in ("order_export", "fin_bill", "fin_line", "courier"):
        d = SC.discover(getattr(v, name)).select(F.lit(name).alias("table_name"), "*")
        out = d if out is None else out.unionByName(d)
    return out


# ---------------------------------------------------------------------------
# dimension importers
# ---------------------------------------------------------------------------
@query("src_dim_store_ref")
def src_dim_store_ref(v):
    """Store reference sheet: data from row 3, name required, blanks → null,
    missing daily cost → 0.0."""
    s = v.store_ref.withColumn("daily_rent_labor", F.when(F.col("store_short_name").endswith("3"), F.lit(None))
                               .otherwise(F.col("daily_rent_labor")))
    cells = X.sheet_cells(s, F.lit("门店信息.xlsx"), {"store_short_name": "门店简称", "province": "省份",
                                                   "city": "城市", "daily_rent_labor": "每日房租人工"},
                          ["store_short_name"], title_rows=1)
    rows = FL.cells_to_rows(cells, FL.header_names(cells, 1), 2, drop_blank=False)
    return rows.where(C.trim_null("门店简称").isNotNull()).select(
        C.trim_null("门店简称").alias("store_short_name"), C.trim_null("省份").alias("province"),
        C.trim_null("城市").alias("city"),
        F.coalesce(C.num_or_null("每日房租人工"), F.lit(0)).cast("decimal(10,4)").alias("daily_rent_labor"))


@query("src_dim_sku_map")
def src_dim_sku_map(v):
    """SKU map sheet: codes normalised, rows lacking a code or a number
    dropped, the last duplicate of a code pair wins."""
    s = v.sku_sheet.select(
        "row_pos", C.norm_code("mini_code_raw").alias("mini_code"), C.norm_code("kingdee_code_raw").alias("kingdee_code"),
        C.num_grouped_null("kingdee_qty_raw").alias("kingdee_qty"), C.num_grouped_null("mini_qty_raw").alias("mini_qty"),
        C.num_grouped_null("price_raw").alias("headquarters_price"))
    s = s.where((F.col("mini_code") != "") & (F.col("kingdee_code") != "")
                & F.col("kingdee_qty").isNotNull() & F.col("mini_qty").isNotNull())
    return SK.last_wins(s, ["mini_code", "kingdee_code"], "row_pos").drop("row_pos")


def _norm_code_sql(x):
    t = f"TRIM(REPLACE({x}, chr(9), ''))"
    d = f"TRY_CAST({t} AS DOUBLE)"
    return (f"(CASE WHEN {x} IS NULL OR {t} IN ('', '-') THEN '' WHEN {d} IS NOT NULL AND {d} = floor({d}) "
            f"AND abs({d}) < 1e18 THEN CAST(CAST({d} AS DECIMAL(38,0)) AS VARCHAR) ELSE {t} END)")


def _grouped_null_sql(x):
    t = f"TRIM(REPLACE({x}, ',', ''))"
    return f"(CASE WHEN {t} IN ('', '-', '--') THEN NULL ELSE TRY_CAST({t} AS DOUBLE) END)"


reg("src_dim_sku_map", ["sku_sheet"], f"""
SELECT mini_code, kingdee_code, kingdee_qty, mini_qty, headquarters_price FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY mini_code, kingdee_code ORDER BY row_pos DESC) AS rn FROM (
    SELECT row_pos, {_norm_code_sql('mini_code_raw')} AS mini_code, {_norm_code_sql('kingdee_code_raw')} AS kingdee_code,
           {_grouped_null_sql('kingdee_qty_raw')} AS kingdee_qty, {_grouped_null_sql('mini_qty_raw')} AS mini_qty,
           {_grouped_null_sql('price_raw')} AS headquarters_price FROM sku_sheet) t
  WHERE mini_code <> '' AND kingdee_code <> '' AND kingdee_qty IS NOT NULL AND mini_qty IS NOT NULL) u
WHERE rn = 1""")


@query("src_promo_sheet")
def src_promo_sheet(v):
    """Promotion flow sheet + store-id sheet: short name looked up by id (else
    '未匹配'), lenient date, |amount| (blank → 0); rows lacking id or date skipped."""
    ids = (v.store_alias.where(F.col("platform") == "美团买药")
           .groupBy(F.col("platform_store_id").alias("sid")).agg(F.min("store_short_name").alias("short")))
    p = v.promo_text.select(C.trim_null("shop_id").alias("sid"), C.date_lenient("day_loose").alias("dt"),
                            C.num_or_null("cash_spend").alias("amt"))
    p = p.where(F.col("sid").isNotNull() & F.col("dt").isNotNull())
    j = p.join(ids, "sid", "left")
    return money_all(j.select("dt", F.col("sid").cast("bigint").alias("store_id"),
                              F.coalesce("short", F.lit(C.UNMATCHED)).alias("store_name"),
                              F.abs(F.coalesce("amt", F.lit(0))).alias("amount")))


reg("src_promo_sheet", ["promo_text", "store_alias"], f"""
WITH ids AS (SELECT platform_store_id AS sid, MIN(store_short_name) AS short FROM store_alias
             WHERE platform = '美团买药' GROUP BY 1),
p AS (SELECT {tnull('shop_id')} AS sid, TRY_CAST({tnull('day_loose')} AS DATE) AS dt, {gate('cash_spend')} AS amt
      FROM promo_text)
SELECT p.dt, CAST(p.sid AS BIGINT) AS store_id, COALESCE(ids.short, '未匹配') AS store_name,
       CAST(ABS(COALESCE(p.amt, 0)) AS {M2}) AS amount
FROM p LEFT JOIN ids ON ids.sid = p.sid WHERE p.sid IS NOT NULL AND p.dt IS NOT NULL""")


@query("rule_penalty_offset")
def rule_penalty_offset(v):
    """One account type's bill sheets carry an extra unnamed column before the
    penalty section; alignment between named anchors removes the offset."""
    b = v.fin_bill.where(F.col("platform") == "el")
    shifted = (F.col("shop_id").cast("int") % 2) == 1
    cols = {"order_no": "订单号", "refund": "", "compensation": "", "settlement": "结算金额"}
    normal = X.sheet_cells(b.where(~shifted), _daily("normal-", ""), cols,
                           ["order_no", "line_no", "dt", "settlement"])
    offset = X.sheet_cells(b.where(shifted).withColumn("pad", F.lit("")),
                           _daily("offset-", ""),
                           {"order_no": "订单号", "pad": "", "refund": "", "compensation": "", "settlement": "结算金额"},
                           ["order_no", "line_no", "dt", "settlement"])
    frames = {}
    for name, cells in (("normal", normal), ("offset", offset)):
        h = (FL._all_columns(cells).join(cells.where(F.col("row") == 0), ["file", "sheet", "col"], "left")
             .select("file", "sheet", "col", F.when(F.coalesce(F.trim("value"), F.lit("")) == "",
                                                    F.concat(F.lit("col_"), F.col("col").cast("string")))
                     .otherwise(F.trim("value")).alias("name")))
        names = [r[0] for r in h.select("col", "name").distinct().orderBy("col").select("name").collect()]
        frames[name] = (FL.cells_to_rows(cells, h, 1, drop_blank=False).select(*names), names)
    plans = FL.align_plans({k: cols for k, (_, cols) in frames.items()})
    return FL.union_by_name([FL.apply_plan(df, plans[k]) for k, (df, _) in frames.items()])


# ---------------------------------------------------------------------------
# oracles for file-based keys whose content is fixed by the views
# ---------------------------------------------------------------------------
def _q(name: str) -> str:
    return '"' + name + '"'


reg("src_csv_text", ["order_export"], "SELECT " + ", ".join(
    f"NULLIF({c}, '') AS {_q(h)}" for c, h in X.ORDER_HEADERS.items()) + " FROM order_export")

reg("src_stamp_meta", ["order_export"], "SELECT " + ", ".join(f"NULLIF({c}, '') AS {_q(h)}" for c, h in X.ORDER_HEADERS.items())
    + """, DATE '2026-03-25' AS dt, '直营' AS _store_type, TRUE AS _loaded_now, TRUE AS _named,
  'csv/platform=' || platform || '/shop_id=' || shop_id AS _folder FROM order_export""")

reg("src_sheet_single", ["promo_text"], """
SELECT '推广-' || shop_id || '-' || CAST(dt AS VARCHAR) || '.xlsx' AS file, day AS "日期", shop_id AS "门店ID", store AS "门店名称",
       spend AS "推广消费_元", cash_spend AS "推广现金消费_元" FROM promo_text""")

reg("src_html_table", ["courier"], "SELECT " + ", ".join(
    f"{c} AS {_q(h)}" for c, h in X.COURIER_HEADERS.items()) + " FROM courier")

reg("src_drop_blank_rows", ["promo_text"], """
SELECT '推广-' || shop_id || '-' || CAST(dt AS VARCHAR) || '.xlsx' AS file, day AS "日期", shop_id AS "门店ID", store AS "门店名称",
       spend AS "推广消费_元", cash_spend AS "推广现金消费_元" FROM promo_text""")

reg("src_union_by_name", ["order_export"], "SELECT " + ", ".join(
    (f"CASE WHEN platform = 'mt' THEN NULLIF({c}, '') END AS {_q(h)}" if c == "receivable_fmt"
     else f"NULLIF({c}, '') AS {_q(h)}") for c, h in X.ORDER_HEADERS.items()) + " FROM order_export")

reg("src_header_flatten", ["fin_bill"], """
SELECT '销售明细-' || shop_id || '.xlsx' AS file, order_no AS "订单号", goods AS "商家收入_商品金额",
       delivery_income AS "商家收入_物流净营业额", subsidy AS "商家收入_col_3", commission AS "商家支出_实收佣金",
       delivery_fee AS "商家支出_履约技术服务费", settlement AS "合计_结算金额"
FROM fin_bill WHERE platform = 'el'""")

reg("src_align_columns", ["promo_text"], """
SELECT day AS "日期", shop_id AS col_1, store AS "门店名称", spend AS col_3 FROM promo_text""")

reg("rule_penalty_offset", ["fin_bill"], """
SELECT order_no AS "订单号", refund AS col_1, compensation AS col_2, settlement AS "结算金额"
FROM fin_bill WHERE platform = 'el'""")

reg("src_dim_store_ref", ["store_ref"], """
SELECT store_short_name, NULLIF(TRIM(province), '') AS province, NULLIF(TRIM(city), '') AS city,
       CAST(COALESCE(CASE WHEN ends_with(store_short_name, '3') THEN NULL ELSE daily_rent_labor END, 0)
            AS DECIMAL(10,4)) AS daily_rent_labor
FROM store_ref WHERE NULLIF(TRIM(store_short_name), '') IS NOT NULL""")

reg("src_sheet_multi", ["fin_bill"], """
WITH d AS (SELECT * FROM fin_bill WHERE platform = 'mt')
SELECT '订单明细' AS sheet, '订单号' AS key, order_no AS value FROM d
UNION ALL SELECT '订单明细', '商家应收款', settlement FROM d
UNION ALL SELECT '订单明细', '账单日期', bill_date FROM d
UNION ALL SELECT '账单明细', '日期', CAST(dt AS VARCHAR) FROM (SELECT DISTINCT shop_id, dt FROM d) s
UNION ALL SELECT '账单明细', '笔数', CAST(COUNT(*) AS VARCHAR) FROM d GROUP BY shop_id, dt""")

reg("schema_conform", ["order_export"], """
SELECT order_no, shop_id, shop_name, status, refund_status, placed_at, receivable,
       CAST(NULL AS VARCHAR) AS store_type_tag, dt, CAST(NULL AS VARCHAR) AS _source_file,
       order_seq, platform, accepted_at, order_source
FROM order_export""")

reg("sink_truncate_reload", ["dim_store"], "SELECT * FROM dim_store")

reg("sink_replace_partition", ["fin_line"], "SELECT order_no, line_no, fee_type, amount, dt FROM fin_line")

reg("src_completeness_guard", ["order_export", "courier", "fin_bill"], """
SELECT target, CAST(files AS BIGINT) AS files, 1 AS min_files, files >= 1 AS ok FROM (
  SELECT 'ods_mt_order' AS target, COUNT(DISTINCT shop_id) AS files FROM order_export WHERE platform = 'mt'
  UNION ALL SELECT 'ods_el_order', COUNT(DISTINCT shop_id) FROM order_export WHERE platform = 'el'
  UNION ALL SELECT 'ods_jd_order', COUNT(DISTINCT shop_id) FROM order_export WHERE platform = 'jd'
  UNION ALL SELECT 'ods_courier', COUNT(DISTINCT regexp_replace(store, '[^A-Za-z0-9_]', '_', 'g')) FROM courier
  UNION ALL SELECT 'ods_el_fin', COUNT(DISTINCT shop_id) FROM fin_bill WHERE platform = 'el') t""")

reg("src_spreadsheetml", ["fin_bill"], "SELECT " + ", ".join(
    f"NULLIF({c}, '') AS {_q(h)}" for c, h in X.BILL_HEADERS.items()) + " FROM fin_bill WHERE platform = 'el'")

reg("sink_materialize", [], ORACLES["ads_daily_report"])

from .recon import subsidies_cte  # noqa: E402
reg("sink_temp_result", ["order_export", "fin_line"], f"""WITH {subsidies_cte("1900-01-01", "2100-01-01")}
SELECT 'fail' AS part, order_no AS k, CAST(settled AS {M2}) AS amount FROM subsidies WHERE reason <> ''
UNION ALL
SELECT 'summary', CAST(dt AS VARCHAR), CAST(SUM(COALESCE(settled, 0)) AS {M2}) FROM subsidies GROUP BY dt""")

# expected names: 5 sanitised headers, 5 blank columns, then the repeated block
_SANITIZED = (["日期", "门店ID", "门店名称", "推广消费_元", "推广现金消费_元"]
              + ["unnamed"] + [f"unnamed_{i}" for i in range(1, 5)]
              + [f"{n}_1" for n in ["日期", "门店ID", "门店名称", "推广消费_元", "推广现金消费_元"]])
reg("src_sanitize_columns", ["promo_text"], f"""
SELECT f.file, n.col, n.name
FROM (SELECT DISTINCT '推广-' || shop_id || '-' || CAST(dt AS VARCHAR) || '.xlsx' AS file FROM promo_text) f
CROSS JOIN (VALUES {", ".join(f"({i}, '{n}')" for i, n in enumerate(_SANITIZED))}) n(col, name)""")

def _observed(t: str) -> str:
    """Columns of a view: position, name, type, rows that are not null."""
    return f"""(SELECT CAST(d.pos AS INTEGER) AS position, d.column_name, d.column_type,
         CAST(COALESCE(c.n, 0) AS BIGINT) AS filled_rows
  FROM (SELECT ROW_NUMBER() OVER () - 1 AS pos, column_name, column_type FROM (DESCRIBE SELECT * FROM {t})) d
  LEFT JOIN (SELECT column_name, COUNT(*) AS n
             FROM (UNPIVOT (SELECT COLUMNS(*)::VARCHAR FROM {t}) ON COLUMNS(*) INTO NAME column_name VALUE x)
             GROUP BY 1) c USING (column_name))"""


reg("schema_drift_report", ["order_export"], f"""
SELECT column_name, CAST(list_position(declared, column_name) - 1 AS INTEGER) AS declared_pos,
       position AS existing_pos, filled_rows,
       CASE WHEN position IS NULL THEN 'new' WHEN list_contains(declared, column_name) THEN 'ok' ELSE 'extra' END AS status
FROM (SELECT {DECLARED_ORDER_COLUMNS} AS declared) l,
     (SELECT column_name, MAX(position) AS position, MAX(filled_rows) AS filled_rows
      FROM (SELECT column_name, position, filled_rows FROM {_observed("order_export")}
            UNION ALL SELECT unnest({DECLARED_ORDER_COLUMNS}), NULL, NULL) GROUP BY 1) c""")

reg("schema_discover", ["order_export", "fin_bill", "fin_line", "courier"], " UNION ALL ".join(f"""
SELECT '{t}' AS table_name, position, column_name,
       CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date' WHEN 'INTEGER' THEN 'int'
                        ELSE lower(column_type) END AS data_type, filled_rows
FROM {_observed(t)} x
WHERE NOT starts_with(column_name, '_') AND column_name <> 'dt'""" for t in ("order_export", "fin_bill", "fin_line", "courier")))

_DIRS = """
SELECT 'csv/platform=' || platform || '/shop_id=' || shop_id AS folder, platform, shop_id
FROM (SELECT DISTINCT platform, shop_id FROM order_export) o"""
reg("src_route_files", ["order_export", "courier", "fin_bill"], f"""
SELECT folder, rule, target, 'routed' AS status FROM (
  SELECT folder, CASE platform WHEN 'mt' THEN 'mt_orders' WHEN 'el' THEN 'el_orders' ELSE 'any_csv' END AS rule,
         CASE platform WHEN 'mt' THEN 'ods_mt_order' WHEN 'el' THEN 'ods_el_order' ELSE 'ods_jd_order' END AS target
  FROM ({_DIRS}) d
  UNION ALL
  SELECT DISTINCT 'html/key=' || regexp_replace(store, '[^A-Za-z0-9_]', '_', 'g'), 'courier_html', 'ods_courier'
  FROM courier
  UNION ALL
  SELECT DISTINCT 'xml/key=' || shop_id, 'bill_xml', 'ods_el_fin' FROM fin_bill WHERE platform = 'el') t""")

reg("src_filename_tag", ["order_export"], f"""
SELECT folder, shop_id AS _store_tag, 'default' AS _account_type FROM ({_DIRS}) d""")
