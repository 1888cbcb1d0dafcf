"""Lookups, bridges, customer harmonization and matching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartmetrics.functions import scalars as S
from cartmetrics.operators import joins
from cartmetrics.plans.registry import query, rounded
from cartmetrics.sources.roles import Tables

BRIDGE = """SELECT sku_ean_cod, MIN(mat_idt) AS mat_idt, MIN(mat_lcl_dsc) AS mat_lcl_dsc FROM items
            WHERE sku_ean_cod IS NOT NULL AND TRIM(sku_ean_cod) <> '' GROUP BY sku_ean_cod"""
# Sales carry the store's product code; the bar code of a product is the code of its group of three.
CODES = """SELECT 'E' || CAST(l_partkey - l_partkey % 3 AS VARCHAR) AS upc, l_extendedprice AS revenue FROM lineitem"""


def coded_sales(t: Tables) -> DataFrame:
    key = F.col("l_partkey")
    return t.lineitem.select(
        F.concat(F.lit("E"), (key - key % 3).cast("string")).alias("upc"), F.col("l_extendedprice").alias("revenue")
    )


@query(
    roles=("sales", "crosswalk", "items"),
    sql="""SELECT i.brand, b.canonical, b.owner, COUNT(*) AS n_rows, ROUND(SUM(s.revenue_sell_out), 2) AS revenue
           FROM sales s JOIN items i ON s.upc = i.mat_idt LEFT JOIN (SELECT variant, MIN(canonical) AS canonical,
             ARG_MIN(owner, canonical) AS owner FROM crosswalk GROUP BY variant) b ON REPLACE(UPPER(TRIM(i.brand)), '#', ' ') = b.variant GROUP BY ALL""",
)
def mapping_left_join(t: Tables) -> DataFrame:
    """Five labels have two canonical names in the mapping; the first is asked for, and no row is multiplied."""
    per_product = t.sales.groupBy("upc").agg(F.count("*").alias("n"), F.sum("revenue_sell_out").alias("r"))
    rows = per_product.join(t.items.select("mat_idt", "brand"), F.col("upc") == F.col("mat_idt"))
    rows = rows.withColumn("label", F.replace("brand", F.lit("#"), F.lit(" ")))
    out = joins.mapping_left_join(rows, t.crosswalk, "label", "variant", ["canonical", "owner"], on_conflict="first")
    return rounded(out.groupBy("brand", "canonical", "owner").agg(F.sum("n").alias("n_rows"), F.sum("r").alias("revenue")), 2)


@query(
    roles=("crosswalk",),
    sql="""SELECT variant, MIN(canonical) AS first_canonical, MAX(canonical) AS last_canonical, COUNT(*) AS n_rows FROM crosswalk
           GROUP BY variant HAVING MIN(canonical) <> MAX(canonical)""",
)
def mapping_conflicts(t: Tables) -> DataFrame:
    """The labels that stop a mapping join unless the first row is asked for."""
    found = joins.key_conflicts(t.crosswalk.select("variant", "canonical"), ["variant"])
    return found.select("variant", F.col("first_row.canonical").alias("first_canonical"), F.col("last_row.canonical").alias("last_canonical"), "n_rows")


@query(
    roles=("items",),
    extra={
        "d": "SELECT brand, MIN(mat_lcl_dsc) AS name_min, MIN(category) AS category_min FROM items WHERE brand IS NOT NULL GROUP BY brand",
        "f": "SELECT 'Brand#' || (user_id % 30 + 1) AS brand_code, value FROM events",
    },
    sql="""SELECT f.brand_code, d.name_min, d.category_min, COUNT(*) AS n_rows, ROUND(SUM(f.value), 2) AS value
           FROM f LEFT JOIN d ON f.brand_code = d.brand GROUP BY ALL""",
)
def product_dedup_join(t: Tables) -> DataFrame:
    fact = t.events.select(F.concat(F.lit("Brand#"), (F.col("user_id") % 30 + 1).cast("string")).alias("brand_code"), "value")
    fact = fact.groupBy("brand_code").agg(F.count("*").alias("n_rows"), F.sum("value").alias("value"))
    dim = t.items.select("brand", F.col("mat_lcl_dsc").alias("name_min"), F.col("category").alias("category_min"))
    return rounded(joins.product_dedup_join(fact, dim, "brand_code", "brand", ["name_min", "category_min"]), 2)


@query(
    roles=("items",),
    extra={"bridge": BRIDGE, "f": CODES},
    sql="""SELECT f.upc, b.sku_ean_cod, b.mat_idt, b.mat_lcl_dsc AS si_description, COUNT(*) AS n_rows, ROUND(SUM(f.revenue), 2) AS revenue
           FROM f LEFT JOIN bridge b ON f.upc = b.sku_ean_cod GROUP BY ALL""",
)
def ean_bridge_join(t: Tables) -> DataFrame:
    fact = coded_sales(t).groupBy("upc").agg(F.count("*").alias("n_rows"), F.sum("revenue").alias("revenue"))
    return rounded(joins.ean_bridge_join(fact, t.items, "upc"), 2)


@query(
    roles=("shipments", "clients", "dictionary"),
    extra={
        "d": "SELECT old_cus_idt, sal_org_cod, MIN(new_cus_idt) AS new_cus_idt FROM dictionary GROUP BY ALL",
        "f": """SELECT shp_cus_idt, sal_org_cod, COUNT(*) AS n_rows, ROUND(SUM(revenue_mxn), 2) AS revenue
                FROM shipments JOIN clients ON shp_cus_idt = cus_idt GROUP BY ALL""",
        "h": """SELECT f.*, CASE WHEN d.old_cus_idt IS NOT NULL THEN d.new_cus_idt ELSE f.shp_cus_idt END AS hop1
                FROM f LEFT JOIN d ON f.shp_cus_idt = d.old_cus_idt AND f.sal_org_cod = d.sal_org_cod""",
    },
    sql="""SELECT h.shp_cus_idt, h.sal_org_cod, h.n_rows, h.revenue, COALESCE(d.new_cus_idt, h.hop1) AS cliente, '0068' || COALESCE(d.new_cus_idt, h.hop1) AS cliente_id
           FROM h LEFT JOIN d ON h.hop1 = d.old_cus_idt AND h.sal_org_cod = d.sal_org_cod""",
)
def two_hop_customer_harmonization(t: Tables) -> DataFrame:
    """Shipments are added up by customer before the two hops."""
    fact = t.shipments.groupBy("shp_cus_idt").agg(F.count("*").alias("n_rows"), F.sum("revenue_mxn").alias("revenue"))
    fact = fact.join(t.clients.select("cus_idt", "sal_org_cod"), F.col("shp_cus_idt") == F.col("cus_idt")).drop("cus_idt")
    return rounded(joins.two_hop_customer_harmonization(fact, t.dictionary, "shp_cus_idt", prefix="0068"), 2)


@query(
    roles=("shipments", "dictionary"),
    extra={
        "d": "SELECT old_cus_idt, MIN(new_cus_idt) AS new_cus_idt FROM dictionary GROUP BY ALL",
        "f": "SELECT shp_cus_idt, COUNT(*) AS n_rows FROM shipments GROUP BY ALL",
    },
    sql="""SELECT f.shp_cus_idt, f.n_rows, COALESCE(d.new_cus_idt, f.shp_cus_idt) AS harmonized_cus_idt
           FROM f LEFT JOIN d ON f.shp_cus_idt = d.old_cus_idt""",
)
def one_hop_customer_harmonization(t: Tables) -> DataFrame:
    fact = t.shipments.groupBy("shp_cus_idt").agg(F.count("*").alias("n_rows"))
    return joins.one_hop_customer_harmonization(fact, t.dictionary, "shp_cus_idt")


@query(
    """SELECT o.o_orderpriority, o.o_orderstatus, d.segment_key, COUNT(*) AS n_rows FROM orders o
       LEFT JOIN (SELECT status, priority, MIN(k) AS segment_key FROM
                    (SELECT o_orderstatus AS status, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority, o_custkey AS k FROM orders) GROUP BY ALL) d
         ON o.o_orderstatus = d.status AND o.o_orderpriority = d.priority GROUP BY ALL"""
)
def composite_dim_lookup(t: Tables) -> DataFrame:
    """Lookup on two natural keys; a NULL key of the dimension matches nothing."""
    dim = t.orders.groupBy(
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
    ).agg(F.min("o_custkey").alias("segment_key"))
    fact = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n_rows"))
    return joins.lookup_on(fact, dim, {"o_orderstatus": "status", "o_orderpriority": "priority"}, ["segment_key"])


@query(
    """SELECT n_name, p_type, s_nationkey % 2 AS unit, COUNT(*) AS n_rows, ROUND(SUM(l_extendedprice), 2) AS revenue
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
       WHERE p_size % 2 = s_nationkey % 2 GROUP BY ALL"""
)
def star_inner_join(t: Tables) -> DataFrame:
    """Store and product dimensions; the business unit is part of the product key."""
    stores = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("store"), "n_name", (F.col("s_nationkey") % 2).alias("unit")
    )
    products = t.part.select(F.col("p_partkey").alias("product"), (F.col("p_size") % 2).alias("product_unit"), "p_type")
    fact = t.lineitem.select("l_suppkey", "l_partkey", "l_extendedprice")
    out = joins.star_inner_join(
        fact, [(stores, {"l_suppkey": "store"}), (products, {"l_partkey": "product", "unit": "product_unit"})]
    )
    return rounded(
        out.groupBy("n_name", "p_type", "unit").agg(F.count("*").alias("n_rows"), F.sum("l_extendedprice").alias("revenue")), 2
    )


@query(
    roles=("panel", "markets", "periods", "metrics"),
    sql="""SELECT m.mrkt_dsc_shrt, d.period_end_date, r.fact_description, COUNT(*) AS n_rows, ROUND(SUM(p.fact_value), 2) AS fact_value
           FROM panel p JOIN markets m ON p.market_id = m.market_id JOIN periods d ON p.period_id = d.period_id
           JOIN metrics r ON p.fact_column = REPLACE(r.fact_column, '.', '_') GROUP BY ALL""",
)
def market_star_join(t: Tables) -> DataFrame:
    metrics = t.metrics.withColumn("fact_column", F.replace(F.col("fact_column"), F.lit("."), F.lit("_")))
    out = joins.star_inner_join(
        t.panel,
        [(t.markets, {"market_id": "market_id"}), (t.periods, {"period_id": "period_id"}), (metrics, {"fact_column": "fact_column"})],
    )
    keys = ["mrkt_dsc_shrt", "period_end_date", "fact_description"]
    return rounded(out.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.sum("fact_value").alias("fact_value")), 2)


@query(
    roles=("panel", "metrics"),
    sql="""SELECT p.fact_column, r.fact_description, r.fact_group, COUNT(*) AS n_rows FROM panel p
           LEFT JOIN metrics r ON p.fact_column = REPLACE(r.fact_column, '.', '_') GROUP BY ALL""",
)
def computed_key_join(t: Tables) -> DataFrame:
    key = F.replace(F.col("fact_column"), F.lit("."), F.lit("_"))
    fact = t.panel.groupBy("fact_column").agg(F.count("*").alias("n_rows"))
    return joins.computed_key_join(fact, t.metrics, F.col("fact_column"), key, ["fact_description", "fact_group"])


@query(
    roles=("market_rows",),
    extra={
        "bridge": """SELECT period_end_date AS fecha_fin, CAST(DATE_TRUNC('month', period_end_date - 3) AS DATE) AS fecha
                     FROM (SELECT DISTINCT period_end_date FROM market_rows)"""
    },
    sql="""SELECT b.fecha, COUNT(*) AS n_rows, ROUND(SUM(fact_value), 2) AS fact_value FROM market_rows JOIN bridge b ON period_end_date = b.fecha_fin GROUP BY ALL""",
)
def period_bridge_join(t: Tables) -> DataFrame:
    """A week belongs to the month of its middle day."""
    end = F.col("period_end_date")
    bridge = t.periods.select(end.alias("fecha_fin"), S.month_trunc(F.date_sub(end, 3)).alias("fecha"))
    out = joins.period_bridge_join(t.market_rows, bridge, "period_end_date")
    return rounded(out.groupBy("fecha").agg(F.count("*").alias("n_rows"), F.sum("fact_value").alias("fact_value")), 2)


CASCADE = {
    "bridge": BRIDGE,
    "c": """SELECT p.*, COALESCE(b1.sku_ean_cod, b2.sku_ean_cod) AS sku_ean_cod, COALESCE(b1.mat_idt, b2.mat_idt) AS mat_idt,
                   COALESCE(b1.mat_lcl_dsc, b2.mat_lcl_dsc) AS si_description,
                   CASE WHEN b1.sku_ean_cod IS NOT NULL THEN 1 WHEN b2.sku_ean_cod IS NOT NULL THEN 2 ELSE 3 END AS match_priority
            FROM store_products p LEFT JOIN bridge b1 ON p.int_id = b1.sku_ean_cod
            LEFT JOIN bridge b2 ON b1.sku_ean_cod IS NULL AND p.import_id = b2.sku_ean_cod""",
}


@query(
    roles=("items", "store_products"),
    extra=CASCADE,
    sql="""SELECT *, CASE match_priority WHEN 1 THEN 'EXACT_INT_ID' WHEN 2 THEN 'EXACT_IMPORT_ID' ELSE 'UNMATCHED' END AS match_method,
                  CASE match_priority WHEN 1 THEN 1.0::DOUBLE WHEN 2 THEN 0.9::DOUBLE ELSE 0.0::DOUBLE END AS match_confidence,
                  CASE match_priority WHEN 3 THEN 'NEEDS_REVIEW' ELSE 'CONFIRMED' END AS review_status FROM c""",
)
def cascade_match(t: Tables) -> DataFrame:
    return joins.cascade_match(t.store_products, t.items)


@query(
    roles=("items", "store_products"),
    extra=CASCADE
    | {"n": "SELECT UPPER(TRIM(mat_lcl_dsc)) AS nm, UPPER(TRIM(brand)) AS br, MIN(mat_idt) AS proposed_mat_idt FROM items WHERE sku_ean_cod IS NOT NULL AND TRIM(sku_ean_cod) <> '' GROUP BY ALL"},
    sql="""SELECT c.int_id, c.so_name, c.so_brand, n.proposed_mat_idt, 'NAME_BRAND' AS match_method, 'NEEDS_REVIEW' AS review_status
           FROM c JOIN n ON UPPER(TRIM(c.so_name)) = n.nm AND UPPER(TRIM(c.so_brand)) = n.br WHERE match_priority = 3""",
)
def name_brand_match(t: Tables) -> DataFrame:
    left = joins.cascade_match(t.store_products, t.items).filter("match_priority = 3").select("int_id", "so_name", "so_brand")
    coded = t.items.filter(F.trim("sku_ean_cod") != "")
    return joins.name_brand_match(left, coded)


@query(
    roles=("items",),
    extra={"f": CODES},
    sql="""SELECT DISTINCT upc FROM f WHERE upc NOT IN (SELECT sku_ean_cod FROM items WHERE sku_ean_cod IS NOT NULL)""",
)
def unmatched_anti_join(t: Tables) -> DataFrame:
    return joins.unmatched_anti_join(coded_sales(t), t.items, "upc", "sku_ean_cod")


@query(
    roles=("items", "store_products"),
    sql="""SELECT so_brand, COUNT(*) AS total_rows, CAST(SUM(CASE WHEN e.k IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS matched_rows,
                  ROUND(SUM(CASE WHEN e.k IS NOT NULL THEN 1 ELSE 0 END) * 100.0::DOUBLE / COUNT(*), 6) AS match_pct
           FROM store_products LEFT JOIN (SELECT DISTINCT sku_ean_cod AS k FROM items) e ON int_id = e.k GROUP BY so_brand""",
)
def bridge_match_rate(t: Tables) -> DataFrame:
    return rounded(joins.bridge_match_rate(t.store_products, t.items, "int_id", "sku_ean_cod", ["so_brand"]), 6)


@query(
    """SELECT * FROM (SELECT CAST(MAX(o_orderdate) AS DATE) AS max_order_date, COUNT(*) AS n_orders FROM orders),
                     (SELECT CAST(MAX(l_shipdate) AS DATE) AS max_ship_date, COUNT(*) AS n_lines FROM lineitem)"""
)
def single_row_cross_join(t: Tables) -> DataFrame:
    a = t.orders.agg(F.max("o_orderdate").cast("date").alias("max_order_date"), F.count("*").alias("n_orders"))
    b = t.lineitem.agg(F.max("l_shipdate").cast("date").alias("max_ship_date"), F.count("*").alias("n_lines"))
    return joins.single_row_cross_join(a, b)


WAPE_ROWS = """SELECT * FROM forecast WHERE is_official_version AND is_reportable AND actual_units > 0"""


def wape_rows(t: Tables, keep_unjudged: bool = False) -> DataFrame:
    keys = ["brand_key", "channel_key", "period_key"]
    forecast = t.forecast.select(*keys, "channel_type", "forecasted_units", "is_official_version")
    actuals = t.forecast.select(*keys, "actual_units", "is_reportable")
    return joins.wape_actuals_join(forecast, actuals, keys, keep_unjudged)


@query(
    roles=("forecast",),
    sql=f"SELECT brand_key, channel_key, period_key, channel_type, forecasted_units, actual_units FROM ({WAPE_ROWS})",
)
def wape_actuals_join(t: Tables) -> DataFrame:
    return wape_rows(t).select("brand_key", "channel_key", "period_key", "channel_type", "forecasted_units", "actual_units")


@query(
    """SELECT o_custkey, MIN(o_orderdate)::DATE AS first_date,
              ARG_MIN(o_orderpriority, STRUCT_PACK(d := o_orderdate, k := o_orderkey)) AS first_priority,
              ARG_MIN(o_orderkey, STRUCT_PACK(d := o_orderdate, k := o_orderkey)) AS first_order
       FROM orders GROUP BY o_custkey"""
)
def first_row_dedup(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    one = joins.first_row_dedup(rows, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return one.select(
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("first_date"),
        F.col("o_orderpriority").alias("first_priority"),
        F.col("o_orderkey").alias("first_order"),
    )
