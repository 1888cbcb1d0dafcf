"""Standardized sources, KPI tables and the master table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartmetrics.operators import kpi
from cartmetrics.operators import std
from cartmetrics.plans.registry import query, rounded
from cartmetrics.sources.roles import OWN_BRANDS, Tables



SELL_OUT_KPI_SQL = """
    SELECT fecha_month, marca_std, canal_std, cadena_std,
           ROUND(SUM(revenue_sell_out), 2) AS so_revenue_mxn, ROUND(SUM(vol_sell_out), 2) AS so_vol_units,
           ROUND(SUM(pcs_sell_out), 2) AS so_pcs, ROUND(SUM(vol_inv), 2) AS so_inventory_units,
           ROUND(SUM(pcs_inv), 2) AS so_pcs_inv, COUNT(DISTINCT store_id) AS so_store_count,
           COUNT(DISTINCT sku_ean_cod) AS so_sku_count, COUNT(*) AS so_fact_rows,
           ROUND(SUM(revenue_sell_out) / NULLIF(SUM(vol_sell_out), 0), 4) AS so_avg_price_mxn,
           ROUND(SUM(vol_inv) * 30 / NULLIF(SUM(vol_sell_out), 0), 4) AS so_inventory_days,
           CASE WHEN COUNT(DISTINCT store_id) >= 50 THEN 'HIGH' WHEN COUNT(DISTINCT store_id) >= 20 THEN 'MEDIUM'
                ELSE 'LOW' END AS coverage_level
    FROM sell_out WHERE marca_std IS NOT NULL
    GROUP BY fecha_month, marca_std, canal_std, cadena_std"""

SI_KPI_COLUMNS = """
    ROUND(SUM(revenue_mxn), 2) AS si_revenue_mxn, ROUND(SUM(volume_liter), 2) AS si_vol_litros,
    ROUND(SUM(volume_kgr), 2) AS si_vol_kg, COUNT(DISTINCT sku_ean_cod) AS si_sku_count,
    COUNT(*) AS si_transaction_count,
    ROUND(SUM(revenue_mxn) / NULLIF(SUM(volume_liter), 0), 4) AS si_avg_price_mxn_per_litre,
    ROUND(SUM(revenue_mxn) / NULLIF(SUM(volume_kgr), 0), 4) AS si_avg_price_mxn_per_kg"""

SI_MASTER_SQL = f"""
    SELECT fecha_month, marca_std, canal_std, {SI_KPI_COLUMNS},
           COUNT(DISTINCT CASE WHEN sku_ean_cod IS NOT NULL THEN cbu || '|' || sku_ean_cod END) AS si_sku_count_by_cbu
    FROM sell_in WHERE marca_std IS NOT NULL GROUP BY fecha_month, marca_std, canal_std"""

SPEND_KPI_SQL = f"""
    SELECT fecha_month, marca_std, canal_std,
           CASE WHEN marca_std IN ({', '.join(f"'{b}'" for b in OWN_BRANDS)}) THEN 'OWN' ELSE 'COMPETITOR' END
             AS brand_owner_type,
           ROUND(SUM(CASE WHEN investment_source = 'MKT_ON' THEN inversion_real ELSE 0 END), 2) AS inv_mkt_on_mxn,
           ROUND(SUM(CASE WHEN investment_source = 'MKT_OFF' THEN inversion_real ELSE 0 END), 2) AS inv_mkt_off_mxn,
           ROUND(SUM(inversion_real), 2) AS inv_total_mxn, COUNT(DISTINCT campana) AS inv_campaign_count,
           COUNT(DISTINCT soporte_plataforma) AS inv_platform_count, COUNT(DISTINCT medio) AS inv_media_type_count,
           ROUND(SUM(CASE WHEN investment_source = 'MKT_ON' THEN inversion_real ELSE 0 END)
                 / NULLIF(SUM(inversion_real), 0), 4) AS inv_on_pct
    FROM spend WHERE marca_std IS NOT NULL GROUP BY ALL"""

KPI_NAMES = list(dict.fromkeys(kpi.METRIC_NAMES.values()))


def _metric_sql(raw: tuple[str, ...]) -> str:
    parts = [f"SUM(CASE WHEN metric_name = '{r}' THEN metric_value END)" for r in raw]
    return f"COALESCE({', '.join(parts)})" if len(parts) > 1 else parts[0]


PIVOT_COLUMNS = ", ".join(
    f"{_metric_sql(tuple(r for r, k in kpi.METRIC_NAMES.items() if k == name))} AS {name}" for name in KPI_NAMES
)
PIVOT_SQL = f"SELECT fecha_month, mrkt_dsc_shrt, canal_std, {PIVOT_COLUMNS} FROM market_rows GROUP BY ALL"


def _market_master_sql(source: str) -> str:
    cols = []
    for name in KPI_NAMES:
        if name in kpi.RATIO_PRICES:
            num, den = kpi.RATIO_PRICES[name]
            expr = f"COALESCE(SUM({num}) / NULLIF(SUM({den}), 0), AVG({name}))"
        elif name in kpi.WEIGHTED_SHARES:
            weight = f"CASE WHEN {name} IS NOT NULL THEN nls_dollar_sales END"
            expr = f"COALESCE(SUM({name} * ({weight})) / NULLIF(SUM({weight}), 0), AVG({name}))"
        elif name in kpi.MAX_METRICS:
            expr = f"MAX({name})"
        else:
            expr = f"SUM({name})"
        cols.append(f"ROUND({expr}, 4) AS {name}")
    return f"SELECT fecha_month, canal_std, {', '.join(cols)} FROM {source} GROUP BY ALL"


# --- standardized sources ----------------------------------------------------------------------


@query(
    roles=("shipments", "items", "dictionary", "clients"),
    extra={
        "item": """SELECT mat_idt, MIN(sku_ean_cod) AS sku_ean_cod, MIN(mat_lcl_dsc) AS mat_lcl_dsc,
                     MIN(UPPER(TRIM(brand))) AS marca_std, MIN(cbu) AS item_cbu
                   FROM items WHERE sku_ean_cod IS NOT NULL GROUP BY mat_idt""",
        "hop": "SELECT old_cus_idt, MIN(new_cus_idt) AS new_cus_idt FROM dictionary GROUP BY old_cus_idt",
    },
    sql="""
    SELECT s.mat_idt, i.sku_ean_cod, i.mat_lcl_dsc, i.marca_std, COALESCE(s.cbu, i.item_cbu) AS cbu, c.canal_raw,
           c.cus_grp_dsc, s.dis_chl_cod, STRFTIME(s.bill_date, '%Y%m') AS year_month,
           ROUND(SUM(s.revenue_mxn), 2) AS revenue_mxn, ROUND(SUM(s.volume_kgr), 2) AS volume_kgr,
           ROUND(SUM(s.volume_liter), 2) AS volume_liter, ROUND(SUM(s.cases), 2) AS cases,
           ROUND(SUM(s.sku_qty), 2) AS sku_qty, COUNT(*) AS fact_row_count, CAST(NULL AS VARCHAR) AS cadena_std,
           CASE UPPER(TRIM(c.canal_raw)) WHEN 'MODERNO' THEN 'MODERNO' WHEN 'NC MODERNO' THEN 'MODERNO'
                WHEN 'UTT' THEN 'MODERNO' WHEN 'DTT' THEN 'TRADICIONAL' WHEN 'TRADICIONAL' THEN 'TRADICIONAL'
                WHEN 'INTERNAL' THEN 'INTERNOS' WHEN 'INTERNOS' THEN 'INTERNOS' END AS canal_std,
           'SELL_IN' AS source_system
    FROM shipments s LEFT JOIN item i ON s.mat_idt = i.mat_idt
    LEFT JOIN hop h ON s.shp_cus_idt = h.old_cus_idt
    LEFT JOIN clients c ON COALESCE(h.new_cus_idt, s.shp_cus_idt) = c.cus_idt
    GROUP BY ALL""",
)
def sell_in_std(t: Tables) -> DataFrame:
    return rounded(kpi.sell_in_std(t.shipments, t.items, t.dictionary, t.clients), 2)


@query(
    roles=("sales", "stores"),
    sql="""
    SELECT s.upc, s.store_id, STRFTIME(s.sale_date, '%Y%m') AS year_month,
           ROUND(SUM(revenue_sell_out), 2) AS revenue_sell_out, ROUND(SUM(vol_sell_out), 2) AS vol_sell_out,
           ROUND(SUM(pcs_sell_out), 2) AS pcs_sell_out, ROUND(SUM(vol_inv), 2) AS vol_inv,
           ROUND(SUM(pcs_inv), 2) AS pcs_inv, COUNT(*) AS fact_row_count, t.chain, t.format, t.region
    FROM sales s LEFT JOIN stores t ON s.store_id = t.store_id GROUP BY ALL""",
)
def sell_out_std(t: Tables) -> DataFrame:
    return rounded(kpi.sell_out_std(t.sales, t.stores), 2)


CONSOLIDATED_SQL = """
    SELECT fecha_month, marca_std, cliente, '{prefix}' || cliente AS cliente_id, ROUND(SUM({volume}), {digits}) AS volumen,
           ROUND(SUM(revenue_mxn), 2) AS valor
    FROM (SELECT *, shp_cus_idt AS cliente FROM sell_in WHERE cbu = '{cbu}' AND {filter}) GROUP BY ALL"""


@query(
    roles=("sell_in",),
    sql=CONSOLIDATED_SQL.format(
        prefix="0068", volume="volume_liter", digits=4, cbu="WATERS", filter="dis_chl_cod NOT IN ('A') AND mat_idt NOT IN ('7','11')"
    )
    + " UNION ALL "
    + CONSOLIDATED_SQL.format(
        prefix="0049", volume="volume_kgr / 1000", digits=4, cbu="EDP", filter="dis_chl_cod NOT IN ('N') AND marca_std NOT IN ('BRAND#3')"
    ),
)
def sell_in_consolidated(t: Tables) -> DataFrame:
    rows = t.sell_in.withColumn("cliente", F.col("shp_cus_idt"))
    c = F.col
    water = (c("cbu") == "WATERS") & ~c("dis_chl_cod").isin("A") & ~c("mat_idt").isin("7", "11")
    dairy = (c("cbu") == "EDP") & ~c("dis_chl_cod").isin("N") & ~c("marca_std").isin("BRAND#3")
    branches = [(water, "0068", c("volume_liter")), (dairy, "0049", c("volume_kgr") / 1000)]
    out = kpi.sell_in_consolidated(rows, branches, ["fecha_month", "marca_std", "cliente", "cliente_id"])
    return rounded(out, 4, valor=2)


@query(
    roles=("media", "crosswalk"),
    extra={
        "best": """SELECT variant, ARG_MIN(canonical, priority) AS canonical FROM crosswalk GROUP BY variant"""
    },
    sql="""
    SELECT fecha, marca, COALESCE(b.canonical, UPPER(TRIM(marca))) AS marca_std, campana, medio, soporte_plataforma,
           ROUND(SUM(impresiones), 2) AS impresiones, ROUND(SUM(inversion_real), 2) AS inversion_real,
           COUNT(*) AS fact_row_count, 'MKT_ON' AS source_system, medio AS canal_std
    FROM media m LEFT JOIN best b ON UPPER(TRIM(marca)) = b.variant
    WHERE investment_source = 'MKT_ON' GROUP BY ALL""",
)
def media_std(t: Tables) -> DataFrame:
    online = t.media.filter("investment_source = 'MKT_ON'").drop("canal_std")
    keys = ["fecha", "campana", "medio", "soporte_plataforma"]
    out = std.media_std(online, t.crosswalk, keys, ["impresiones", "inversion_real"], "MKT_ON")
    return rounded(out, 2)


@query(
    roles=("panel", "markets", "periods", "metrics"),
    sql="""
    SELECT m.mrkt_dsc_shrt, m.hierarchy_level, d.period_label, d.period_end_date, p.fact_column AS metric_name,
           r.fact_description AS metric_description, r.fact_group AS metric_group,
           ROUND(SUM(p.fact_value), 2) AS metric_value, COUNT(*) AS row_count
    FROM panel p JOIN markets m ON p.market_id = m.market_id
    LEFT JOIN periods d ON p.period_id = d.period_id
    LEFT JOIN metrics r ON p.fact_column = REPLACE(r.fact_column, '.', '_')
    GROUP BY ALL""",
)
def market_facts_std(t: Tables) -> DataFrame:
    key = F.replace(F.col("fact_column"), F.lit("."), F.lit("_"))
    return rounded(kpi.market_facts_std(t.panel, t.markets, t.periods, t.metrics, key), 2)


# --- KPI tables --------------------------------------------------------------------------------


@query(
    roles=("sell_in",),
    sql=f"SELECT fecha_month, marca_std, canal_std, cbu, {SI_KPI_COLUMNS} FROM sell_in WHERE marca_std IS NOT NULL GROUP BY fecha_month, marca_std, canal_std, cbu",
)
def sell_in_kpi(t: Tables) -> DataFrame:
    return rounded(kpi.sell_in_kpi(t.sell_in), 4, si_revenue_mxn=2, si_vol_kg=2)


@query(roles=("sell_in",), sql=SI_MASTER_SQL)
def sell_in_kpi_master(t: Tables) -> DataFrame:
    return rounded(kpi.sell_in_kpi_master(t.sell_in), 4, si_revenue_mxn=2, si_vol_kg=2)


@query(roles=("sell_out",), sql=SELL_OUT_KPI_SQL)
def sell_out_kpi(t: Tables) -> DataFrame:
    return rounded(kpi.sell_out_kpi(t.sell_out), 4, so_revenue_mxn=2, so_inventory_units=2)


@query(roles=("spend",), sql=SPEND_KPI_SQL)
def investment_kpi(t: Tables) -> DataFrame:
    return rounded(kpi.investment_kpi(t.spend, OWN_BRANDS), 4)


#: All names but that of units, which then is a metric without a KPI.
SOME_NAMES = {raw: name for raw, name in kpi.METRIC_NAMES.items() if raw != "U"}


@query(
    roles=("market_rows",),
    extra={"wide": PIVOT_SQL},
    sql="SELECT fecha_month, mrkt_dsc_shrt, canal_std, ROUND(nls_units, 2)::DOUBLE AS U, "
    + ", ".join(f"ROUND({n}, 2)::DOUBLE AS {n}" for n in dict.fromkeys(SOME_NAMES.values()))
    + " FROM wide",
)
def metric_pivot(t: Tables) -> DataFrame:
    wide = kpi.metric_pivot(t.market_rows, ["fecha_month", "mrkt_dsc_shrt", "canal_std"], SOME_NAMES)
    return rounded(wide.withColumn("U", F.col("other_metrics")["U"]).drop("other_metrics"), 2)


@query(
    roles=("market_rows",),
    sql="""SELECT 'W3_unmapped_metric:' || metric_name AS check_id, 'market_facts' AS table_name, CAST(COUNT(*) AS DOUBLE) AS metric, 0.0::DOUBLE AS threshold, 'WARNING' AS status
           FROM market_rows WHERE metric_name = 'U' GROUP BY metric_name""",
)
def unmapped_metrics(t: Tables) -> DataFrame:
    return kpi.unmapped_metrics(t.market_rows, SOME_NAMES)


@query(roles=("market_rows",), extra={"wide": PIVOT_SQL}, sql=_market_master_sql("wide"))
def market_kpi_master(t: Tables) -> DataFrame:
    wide = kpi.metric_pivot(t.market_rows, ["fecha_month", "mrkt_dsc_shrt", "canal_std"])
    return rounded(kpi.market_kpi_master(wide), 4)


@query(
    roles=("market_rows",),
    extra={"wide": PIVOT_SQL},
    sql="SELECT fecha_month, canal_std, " + ", ".join(f"ROUND(SUM({n}), 2)::DOUBLE AS {n}" for n in KPI_NAMES) + " FROM wide GROUP BY ALL",
)
def market_kpi_sums(t: Tables) -> DataFrame:
    wide = kpi.metric_pivot(t.market_rows, ["fecha_month", "mrkt_dsc_shrt", "canal_std"])
    return rounded(kpi.market_kpi_sums(wide), 2)


LONG_SQL = """SELECT fecha_month, canal_std, marca_std, market_id, hierarchy_level, fact_column AS fact_tag,
                     'Metric ' || LOWER(fact_column) AS fact_short_dsc, fact_value FROM market_rows"""


def market_long(t: Tables) -> DataFrame:
    """Panel rows with a metric tag and a metric description."""
    return t.market_rows.select(
        "fecha_month", "canal_std", "marca_std", "market_id", "hierarchy_level",
        F.col("fact_column").alias("fact_tag"),
        F.concat(F.lit("Metric "), F.lower("fact_column")).alias("fact_short_dsc"),
        "fact_value",
    )


@query(
    roles=("market_rows",),
    extra={"long": LONG_SQL},
    sql="""
    SELECT fecha_month, canal_std,
           ROUND(SUM(CASE WHEN fact_tag = 'DOL' OR fact_short_dsc = 'Metric dol' THEN fact_value ELSE 0 END), 2) AS vtas_valor,
           ROUND(SUM(CASE WHEN fact_tag = 'U' OR fact_short_dsc = 'Metric value_share' THEN fact_value ELSE 0 END), 2) AS vtas_unds,
           MAX(CASE WHEN fact_tag = 'NUM_DIST' THEN fact_value ELSE 0 END) AS dist_num
    FROM long GROUP BY ALL""",
)
def conditional_metric_wide(t: Tables) -> DataFrame:
    sums = {"vtas_valor": ["DOL", "Metric dol"], "vtas_unds": ["U", "Metric value_share"]}
    out = kpi.conditional_metric_wide(market_long(t), ["fecha_month", "canal_std"], sums, {"dist_num": ["NUM_DIST"]})
    return rounded(out, 2)


@query(
    roles=("market_rows",),
    extra={"long": LONG_SQL},
    sql="""
    SELECT fecha_month, fact_tag,
           ROUND(SUM(CASE WHEN fact_tag IN ('DOL','U') THEN fact_value / 1000 ELSE fact_value END), 4) AS fact_value
    FROM long GROUP BY ALL""",
)
def unit_rescale_metric(t: Tables) -> DataFrame:
    scaled = kpi.unit_rescale_metric(market_long(t), ["DOL", "U"])
    return rounded(scaled.groupBy("fecha_month", "fact_tag").agg(F.sum("fact_value").alias("fact_value")), 4)


# --- master ------------------------------------------------------------------------------------

MASTER_ROLES = ("sell_out", "sell_in", "spend", "market_rows")
MASTER_EXTRA = {
    "so": SELL_OUT_KPI_SQL,
    "si": f"SELECT fecha_month, marca_std, canal_std, {SI_KPI_COLUMNS} FROM sell_in WHERE marca_std IS NOT NULL GROUP BY ALL",
    "inv": SPEND_KPI_SQL,
    "wide": PIVOT_SQL,
    "nls": _market_master_sql("wide"),
    "master": """
        SELECT so.fecha_month, so.marca_std, so.canal_std, so.cadena_std, si.si_revenue_mxn, si.si_vol_litros, si.si_vol_kg,
               si.si_avg_price_mxn_per_litre, si.si_avg_price_mxn_per_kg, si.si_sku_count, so.so_revenue_mxn,
               so.so_vol_units, so.so_avg_price_mxn, so.so_inventory_days, so.so_store_count, so.coverage_level,
               inv.inv_total_mxn, inv.inv_mkt_on_mxn, inv.inv_mkt_off_mxn, inv.inv_on_pct, nls.nls_value_share,
               nls.nls_volume_share, nls.nls_numeric_dist, nls.nls_category_value_mxn::DOUBLE AS nls_category_value_mxn,
               ROUND(so.so_revenue_mxn / NULLIF(inv.inv_total_mxn, 0), 4) AS roas_gross,
               si.si_revenue_mxn IS NOT NULL AS has_sell_in, so.so_revenue_mxn IS NOT NULL AS has_sell_out,
               inv.inv_total_mxn IS NOT NULL AS has_investment,
               (nls.nls_value_share IS NOT NULL OR nls.nls_volume_share IS NOT NULL) AS has_nielsen,
               'FULL' AS silver_input_mode
        FROM so LEFT JOIN si ON so.fecha_month = si.fecha_month AND so.marca_std = si.marca_std AND so.canal_std = si.canal_std
        LEFT JOIN inv ON so.fecha_month = inv.fecha_month AND so.marca_std = inv.marca_std
                     AND so.canal_std = inv.canal_std AND inv.brand_owner_type = 'OWN'
        LEFT JOIN nls ON so.fecha_month = nls.fecha_month AND so.canal_std = nls.canal_std""",
}


def master_table(t: Tables) -> DataFrame:
    wide = kpi.metric_pivot(t.market_rows, ["fecha_month", "mrkt_dsc_shrt", "canal_std"])
    return kpi.kpi_master_join(
        kpi.sell_out_kpi(t.sell_out),
        kpi.sell_in_kpi_master(t.sell_in),
        kpi.investment_kpi(t.spend, OWN_BRANDS),
        kpi.market_kpi_master(wide),
    )


@query(
    roles=MASTER_ROLES,
    extra=MASTER_EXTRA,
    sql="""SELECT *, CASE WHEN has_sell_in AND has_sell_out AND has_investment AND has_nielsen THEN 'HIGH'
                          WHEN has_sell_out THEN 'MEDIUM' ELSE 'LOW' END AS data_confidence FROM master""",
)
def kpi_master_join(t: Tables) -> DataFrame:
    """The run time column is left out, as it differs between runs."""
    two = dict.fromkeys(
        ("si_revenue_mxn", "si_vol_kg", "so_revenue_mxn", "inv_total_mxn", "inv_mkt_on_mxn", "inv_mkt_off_mxn"), 2
    )
    return rounded(master_table(t).drop("gold_run_ts"), 4, **two)


ALL_SOURCE_EXTRA = {
    "si": "SELECT fecha_month, marca_std, ROUND(SUM(volume_liter), 2) AS volumen, ROUND(SUM(revenue_mxn), 2) AS sell_in_valor FROM sell_in GROUP BY ALL",
    "so": "SELECT fecha_month, marca_std, ROUND(SUM(vol_sell_out), 2) AS vol_sell_out, ROUND(SUM(revenue_sell_out), 2) AS amount_sell_out FROM sell_out GROUP BY ALL",
    "onl": "SELECT fecha_month, marca_std, ROUND(SUM(inversion_real), 2) AS inversion_on, ROUND(SUM(impresiones), 2) AS impresiones_on FROM spend WHERE investment_source = 'MKT_ON' GROUP BY ALL",
    "offl": "SELECT fecha_month, marca_std, ROUND(SUM(inversion_real), 2) AS inversion_off FROM spend WHERE investment_source = 'MKT_OFF' GROUP BY ALL",
}


def _brand_months(t: Tables) -> dict[str, DataFrame]:
    return kpi.brand_month_all_source(
        {
            "sell_in": (t.sell_in, {"volumen": "volume_liter", "sell_in_valor": "revenue_mxn"}),
            "sell_out": (t.sell_out, {"vol_sell_out": "vol_sell_out", "amount_sell_out": "revenue_sell_out"}),
            "online": (
                t.spend.filter("investment_source = 'MKT_ON'"),
                {"inversion_on": "inversion_real", "impresiones_on": "impresiones"},
            ),
            "offline": (t.spend.filter("investment_source = 'MKT_OFF'"), {"inversion_off": "inversion_real"}),
        }
    )


@query(
    roles=("sell_in", "sell_out", "spend"),
    extra=ALL_SOURCE_EXTRA,
    sql="""
    SELECT COALESCE(si.fecha_month, so.fecha_month) AS fecha_month, COALESCE(si.marca_std, so.marca_std) AS marca_std,
           volumen, sell_in_valor, vol_sell_out, amount_sell_out, inversion_on, impresiones_on, inversion_off
    FROM si FULL OUTER JOIN so ON si.fecha_month = so.fecha_month AND si.marca_std = so.marca_std
    LEFT JOIN onl ON COALESCE(si.fecha_month, so.fecha_month) = onl.fecha_month
                 AND COALESCE(si.marca_std, so.marca_std) = onl.marca_std
    LEFT JOIN offl ON COALESCE(si.fecha_month, so.fecha_month) = offl.fecha_month
                  AND COALESCE(si.marca_std, so.marca_std) = offl.marca_std""",
)
def all_source_full_join(t: Tables) -> DataFrame:
    parts = _brand_months(t)
    out = kpi.all_source_full_join(parts["sell_in"], parts["sell_out"], parts["online"], parts["offline"])
    return rounded(out, 2)


@query(
    roles=("sell_in", "sell_out", "spend"),
    extra=ALL_SOURCE_EXTRA,
    sql="""
    SELECT 'sell_in' AS source, fecha_month, marca_std, sell_in_valor AS amount FROM si
    UNION ALL SELECT 'sell_out', fecha_month, marca_std, amount_sell_out FROM so
    UNION ALL SELECT 'online', fecha_month, marca_std, inversion_on FROM onl
    UNION ALL SELECT 'offline', fecha_month, marca_std, inversion_off FROM offl""",
)
def brand_month_all_source(t: Tables) -> DataFrame:
    amounts = {
        "sell_in": "sell_in_valor",
        "sell_out": "amount_sell_out",
        "online": "inversion_on",
        "offline": "inversion_off",
    }
    parts = [
        df.select(F.lit(name).alias("source"), "fecha_month", "marca_std", F.col(amounts[name]).alias("amount"))
        for name, df in _brand_months(t).items()
    ]
    return rounded(std.union_by_name_missing(parts), 2)


@query(
    roles=("sell_out",),
    sql="""
    SELECT fecha_month, ROUND(SUM(revenue_sell_out), 2) AS direct_total, COUNT(*) AS direct_rows,
           ROUND(SUM(revenue_sell_out), 2) AS rolled_total, COUNT(*) AS rolled_rows, 'MATCH' AS status
    FROM sell_out GROUP BY fecha_month""",
)
def old_new_grain_reconcile(t: Tables) -> DataFrame:
    out = kpi.old_new_grain_reconcile(t.sell_out, ["fecha_month"], ["store_id", "upc"], "revenue_sell_out")
    return rounded(out, 2)
