"""The roles of ``cartmetrics.sources.roles`` as SQL common table expressions for the oracle."""

from __future__ import annotations

SEGMENT = "(['AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY'])[CAST({0} % 5 + 1 AS INT)]"

# name -> (roles it reads, SQL)
ROLES: dict[str, tuple[tuple[str, ...], str]] = {
    "items": ((), """
        SELECT CAST(p_partkey AS VARCHAR) AS mat_idt,
               CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 10 = 1 THEN ' '
                    ELSE 'E' || CAST(p_partkey - p_partkey % 3 AS VARCHAR) END AS sku_ean_cod,
               p_name AS mat_lcl_dsc, p_brand AS brand,
               CASE WHEN p_type IN ('ECONOMY','SMALL','MEDIUM') THEN 'WATERS' ELSE 'EDP' END AS cbu,
               p_size > 25 AS is_active, p_type AS category, p_size AS size
        FROM part"""),
    "store_products": ((), """
        SELECT CASE WHEN p_partkey % 2 = 0 THEN 'E' ELSE 'X' END || CAST(p_partkey AS VARCHAR) AS int_id,
               'E' || CAST(p_partkey - p_partkey % 3 AS VARCHAR) AS import_id,
               p_name AS so_name, p_brand AS so_brand, p_type AS so_category
        FROM part"""),
    "dictionary": ((), """
        SELECT CAST(s_suppkey AS VARCHAR) AS old_cus_idt,
               CASE WHEN s_suppkey % 4 = 0 THEN CAST(s_suppkey AS VARCHAR)
                    WHEN s_suppkey % 4 <> 3 THEN CAST(s_suppkey + 1 AS VARCHAR) END AS new_cus_idt,
               CASE WHEN s_nationkey % 2 = 0 THEN '0049' ELSE '0068' END AS sal_org_cod
        FROM supplier
        UNION ALL
        SELECT CAST(s_suppkey AS VARCHAR), CAST(s_suppkey + 2 AS VARCHAR),
               CASE WHEN s_nationkey % 2 = 0 THEN '0049' ELSE '0068' END
        FROM supplier WHERE s_nationkey < 5"""),
    "clients": ((), """
        SELECT CAST(s_suppkey AS VARCHAR) AS cus_idt,
               ([' moderno ','DTT','INTERNAL','NC Moderno','OTHER'])[s_nationkey % 5 + 1] AS canal_raw,
               n_name AS cus_grp_dsc,
               CASE WHEN s_nationkey % 2 = 0 THEN '0049' ELSE '0068' END AS sal_org_cod
        FROM supplier JOIN nation ON s_nationkey = n_nationkey"""),
    "stores": ((), """
        SELECT CAST(c_custkey AS VARCHAR) AS store_id, n_name AS chain, c_mktsegment AS format, r_name AS region
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "crosswalk": ((), """
        SELECT REPLACE(UPPER(p_brand), '#', ' ') AS variant, UPPER(p_brand) AS canonical,
               CASE WHEN CAST(SPLIT_PART(p_brand, '#', 2) AS INT) <= 12 THEN 'OWN' ELSE 'COMPETITOR' END AS owner,
               CAST(SPLIT_PART(p_brand, '#', 2) AS INT) AS priority
        FROM (SELECT DISTINCT p_brand FROM part)
        UNION ALL
        SELECT REPLACE(UPPER(p_brand), '#', ' '), 'OVERLAP', 'COMPETITOR', 99
        FROM (SELECT DISTINCT p_brand FROM part) WHERE CAST(SPLIT_PART(p_brand, '#', 2) AS INT) <= 5"""),
    "shipments": ((), """
        SELECT CAST(l_partkey AS VARCHAR) AS mat_idt, CAST(l_suppkey AS VARCHAR) AS shp_cus_idt,
               CASE WHEN l_linestatus = 'O' THEN 'WATERS' END AS cbu, l_returnflag AS dis_chl_cod,
               CAST(l_shipdate AS DATE) AS bill_date, l_extendedprice AS revenue_mxn,
               l_quantity AS volume_liter, l_quantity * (1 - l_discount) AS volume_kgr,
               CAST(l_linenumber AS DOUBLE) AS cases, 1.0::DOUBLE AS sku_qty
        FROM lineitem"""),
    "sell_in": (("shipments", "items"), f"""
        SELECT s.mat_idt, s.shp_cus_idt, COALESCE(s.cbu, i.cbu) AS cbu, s.dis_chl_cod, s.bill_date,
               s.revenue_mxn, s.volume_liter, s.volume_kgr, s.cases, s.sku_qty, i.sku_ean_cod,
               CASE WHEN i.size <> 50 THEN UPPER(i.brand) END AS marca_std,
               {SEGMENT.format('s_nationkey')} AS canal_std,
               CAST(DATE_TRUNC('month', s.bill_date) AS DATE) AS fecha_month
        FROM shipments s JOIN items i ON s.mat_idt = i.mat_idt
        JOIN supplier ON s.shp_cus_idt = CAST(s_suppkey AS VARCHAR)"""),
    "sales": ((), """
        SELECT CAST(l_partkey AS VARCHAR) AS upc, l_extendedprice AS revenue_sell_out,
               l_quantity AS vol_sell_out, CAST(l_linenumber AS DOUBLE) AS pcs_sell_out,
               l_quantity * l_tax AS vol_inv, 1.0::DOUBLE AS pcs_inv,
               CAST(o_custkey AS VARCHAR) AS store_id, CAST(o_orderdate AS DATE) AS sale_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "sell_out": (("sales", "stores", "items"), """
        SELECT s.*, t.chain, t.format, t.region, i.sku_ean_cod, i.category,
               CASE WHEN i.size <> 50 THEN UPPER(i.brand) END AS marca_std,
               CAST(DATE_TRUNC('month', s.sale_date) AS DATE) AS fecha_month,
               t.format AS canal_std, t.chain AS cadena_std
        FROM sales s JOIN stores t ON s.store_id = t.store_id JOIN items i ON s.upc = i.mat_idt"""),
    "media": ((), f"""
        SELECT CAST(DATE '1997-01-01' + TO_MONTHS(CAST(event_id % 48 AS INT)) AS DATE)
                 + CAST(event_id % 28 AS INT) AS fecha,
               CASE user_id % 3 WHEN 0 THEN ' brand#' || (user_id % 25 + 1) || ' '
                                WHEN 1 THEN 'Brand ' || (user_id % 25 + 1)
                                ELSE 'BRAND#' || (user_id % 25 + 1) END AS marca,
               'C' || (user_id % 40) AS campana, event_type AS medio,
               regexp_extract(props, '([0-9]+)', 1) AS soporte_plataforma,
               {SEGMENT.format('event_id')} AS canal_std,
               CASE WHEN event_type IN ('click','view','purchase') THEN 'MKT_ON' ELSE 'MKT_OFF' END
                 AS investment_source,
               CAST(event_id % 100 AS DOUBLE) AS impresiones, value AS inversion_real
        FROM events"""),
    "spend": (("media",), """
        SELECT media.*, 'BRAND#' || regexp_extract(marca, '([0-9]+)', 1) AS marca_std,
               CAST(DATE_TRUNC('month', fecha) AS DATE) AS fecha_month
        FROM media"""),
    "waste": (("clients",), """
        SELECT CAST(l_shipdate AS DATE) AS fecha, CAST(l_partkey AS VARCHAR) AS sku, cus_grp_dsc AS cadena,
               l_linestatus AS formato, canal_raw AS canal,
               CASE WHEN l_tax > 0.06 THEN 'OTHER' ELSE ' topline' END AS fuente,
               CASE WHEN l_quantity > 1 THEN l_extendedprice END AS waste_amount, l_quantity AS waste_kg
        FROM lineitem JOIN clients ON CAST(l_suppkey AS VARCHAR) = cus_idt
        WHERE l_returnflag = 'R'"""),
    "panel": ((), """
        SELECT user_id AS market_id, event_id % 50 AS product_id, CAST(event_id % 208 AS INT) AS period_id,
               CASE event_type WHEN 'click' THEN 'VALUE_SHARE' WHEN 'view' THEN 'VOLUME_SHARE'
                    WHEN 'purchase' THEN 'DOL' WHEN 'signup' THEN 'U' ELSE 'NUM_DIST' END AS fact_column,
               value AS fact_value
        FROM events"""),
    "markets": ((), f"""
        SELECT user_id AS market_id,
               (['TOTAL MEXICO AUTOSERVICIOS SCANNING','AUTOS SCANNING','CANAL TRADICIONAL',
                 'GRANDES CADENAS DE AUTOSERVICIO','TDC + FARMACIAS CAD + HARD DISCOUNTERS','C PROXIMIDAD',
                 'MODERNO','SURTIDO COMPLETO'])[CAST(user_id % 8 + 1 AS INT)] ||
               (['_AREA 1',' AREA 10',' AREA 2.1',' VDM ZONA II',' GUADALAJARA.',' AREA 6_MT',
                 ' AREAS 3 + 4 + 5 + 6'])[CAST(user_id % 7 + 1 AS INT)] AS mrkt_dsc_shrt,
               ([9, 11, 7])[CAST(user_id % 3 + 1 AS INT)] AS hierarchy_level,
               {SEGMENT.format('user_id')} AS canal_std, 'BRAND#' || (user_id % 25 + 1) AS marca_std
        FROM (SELECT DISTINCT user_id FROM events)"""),
    "periods": ((), """
        SELECT period_id, 'W' || period_id AS period_label, DATE '1997-01-05' + 7 * period_id AS period_end_date
        FROM (SELECT DISTINCT CAST(event_id % 208 AS INT) AS period_id FROM events)"""),
    "metrics": (("panel",), """
        SELECT REPLACE(fact_column, '_', '.') AS fact_column, 'Metric ' || LOWER(fact_column) AS fact_description,
               CASE WHEN fact_column LIKE '%SHARE%' THEN 'SHARE' ELSE 'VOLUME' END AS fact_group
        FROM (SELECT DISTINCT fact_column FROM panel)"""),
    "market_rows": (("panel", "markets", "periods"), """
        SELECT p.*, m.mrkt_dsc_shrt, m.hierarchy_level, m.canal_std, m.marca_std, d.period_label,
               d.period_end_date, CAST(DATE_TRUNC('month', d.period_end_date) AS DATE) AS fecha_month,
               p.fact_column AS metric_name, p.fact_value AS metric_value
        FROM panel p JOIN markets m ON p.market_id = m.market_id JOIN periods d ON p.period_id = d.period_id"""),
    "panel_base": ((), f"""
        SELECT 'BRAND#' || (user_id % 25 + 1) AS brand_key, {SEGMENT.format('user_id')} AS channel_key,
               DATE '1997-01-05' + 7 * CAST(event_id % 208 AS INT) AS week_end, ROUND(SUM(value), 2) AS sales, COUNT(*) AS packs,
               COUNT(DISTINCT user_id) AS markets
        FROM events WHERE NOT (event_id % 208 = 60 AND user_id % 25 = 3) GROUP BY ALL"""),
    "weekly_panel": (("panel_base",), """
        SELECT brand_key, channel_key, week_end, COUNT(*) OVER c AS n_brands, ROUND(sales * 100 / ROUND(SUM(sales) OVER c, 2), 4) AS value_share,
               CAST(markets AS DOUBLE) AS numeric_distribution, ROUND(packs * 10 / markets, 4) AS weighted_distribution,
               ROUND((sales / packs) / (ROUND(SUM(sales) OVER c, 2) / SUM(packs) OVER c), 4) AS price_index_vs_category
        FROM panel_base WINDOW c AS (PARTITION BY channel_key, week_end)"""),
    "weekly": (("sell_out",), """
        SELECT marca_std AS brand_key, canal_std AS channel_key,
               CAST(DATE_TRUNC('week', sale_date) AS DATE) AS week_start,
               SUM(vol_sell_out) AS units, ROUND(SUM(revenue_sell_out), 2) AS revenue
        FROM sell_out WHERE marca_std IS NOT NULL GROUP BY ALL"""),
    "weekly_spend": (("spend",), """
        SELECT marca_std AS brand_key, canal_std AS channel_key,
               CAST(DATE_TRUNC('week', fecha) AS DATE) AS week_start, ROUND(SUM(inversion_real), 2) AS spend
        FROM spend GROUP BY ALL"""),
    "history_base": (("sell_out",), """
        SELECT marca_std AS brand_key, canal_std AS channel_key,
               CAST((YEAR(fecha_month) - 1995) * 12 + MONTH(fecha_month) AS INT) AS period_key, fecha_month,
               ROUND(SUM(revenue_sell_out), 2) AS revenue, SUM(vol_sell_out) AS units,
               COUNT(DISTINCT store_id) AS stores
        FROM sell_out WHERE marca_std IS NOT NULL GROUP BY ALL"""),
    "history": (("history_base",), """
        SELECT b.brand_key, b.channel_key, b.period_key, b.fecha_month, b.revenue, b.units, t.n_brands,
               ROUND(b.revenue * 100 / t.revenue, 4) AS value_share,
               ROUND(b.units * 100 / t.units, 4) AS volume_share,
               CAST(b.stores AS DOUBLE) AS numeric_distribution,
               ROUND(b.units / b.stores, 4) AS weighted_distribution,
               ROUND((b.revenue / b.units) / (t.revenue / t.units), 4) AS price_index_vs_category
        FROM history_base b
        JOIN (SELECT channel_key, period_key, ROUND(SUM(revenue), 2) AS revenue, SUM(units) AS units,
                     COUNT(*) AS n_brands
              FROM history_base GROUP BY ALL) t
          ON b.channel_key = t.channel_key AND b.period_key = t.period_key"""),
    "forecast": (("history",), """
        SELECT brand_key, channel_key, period_key, fecha_month,
               CASE WHEN channel_key IN ('AUTOMOBILE','FURNITURE') THEN 'MODERN' ELSE 'TRADITIONAL' END
                 AS channel_type,
               ROUND(units * (0.7::DOUBLE + 0.1::DOUBLE * (period_key % 7)), 2) AS forecasted_units,
               CASE WHEN MONTH(fecha_month) = 2 THEN 0.0::DOUBLE ELSE units END AS actual_units,
               MONTH(fecha_month) <> 6 AS is_official_version, channel_key <> 'MACHINERY' AS is_reportable
        FROM history"""),
}


def break_ties(sql: str) -> str:
    """Nudge the argument of every ROUND to up to six digits: engines round exact halves in
    different directions."""
    out, i = [], 0
    while (start := sql.find("ROUND(", i)) >= 0:
        depth, j, comma = 1, start + 6, -1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[j], 0)
            if sql[j] == "," and depth == 1:
                comma = j
            j += 1
        inner, digits = break_ties(sql[start + 6 : comma]), sql[comma + 1 : j - 1].strip()
        nudge = " + 1e-7" if int(digits) <= 6 else ""
        out += [sql[i:start], f"ROUND(({inner}){nudge}, {digits})"]
        i = j
    return "".join([*out, sql[i:]])


def with_roles(names: tuple[str, ...], body: str, extra: dict[str, str] | None = None) -> str:
    """A statement that defines the named roles, what they read, and extra CTEs before the body."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for dep in ROLES[name][0]:
                visit(dep)
            order.append(name)

    for name in names:
        visit(name)
    ctes = [f"{n} AS ({ROLES[n][1]})" for n in order]
    ctes += [f"{n} AS ({sql})" for n, sql in (extra or {}).items()]
    return break_ties((f"WITH {', '.join(ctes)} " if ctes else "") + body)
