"""Master catalogs, dimensions, worklists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartmetrics.functions import scalars as S
from cartmetrics.operators import catalogs, std
from cartmetrics.plans.registry import query, rounded
from cartmetrics.plans.std_plans import DIM_CHANNEL_SQL, MARKET_EXTRA, SEED_SQL, channel_seed, classified_markets
from cartmetrics.sources.roles import Tables

UNIT = "(['EDP','WATER_RT','PB','WATER_ST'])[CAST(market_id % 4 + 1 AS INT)]"


def live_markets(t: Tables, *more: str) -> DataFrame:
    """Market labels per unit as they appear in the panel."""
    unit = F.element_at(F.array(*[F.lit(u) for u in ("EDP", "WATER_RT", "PB", "WATER_ST")]), (F.col("market_id") % 4 + 1).cast("int"))
    return t.markets.select(unit.alias("source_cbu"), "mrkt_dsc_shrt", *more)


CATALOG = {
    **MARKET_EXTRA,
    "live": f"SELECT {UNIT} AS source_cbu, UPPER(TRIM(mrkt_dsc_shrt)) AS mrkt_norm, MIN(mrkt_dsc_shrt) AS mrkt_dsc_shrt FROM markets GROUP BY ALL",
    "seed": f"""SELECT DISTINCT {UNIT} AS source_cbu, UPPER(TRIM(mrkt_dsc_shrt)) AS mrkt_norm, canal_lvl1, canal_lvl2, canal_lvl2 AS canal_std, agg_level, region_type, region_std, region_detail
                FROM classified WHERE canal_lvl2 NOT IN ('PROXIMIDAD', 'SIN_CLASIFICAR')""",
    "ref": "SELECT 'IBP' AS source_cbu, UPPER(TRIM(region)) AS mrkt_norm, MIN(region) AS mrkt_dsc_shrt FROM stores GROUP BY ALL",
    "cat": """
        SELECT live.*, canal_std, canal_lvl1, canal_lvl2, agg_level, region_type, region_std, region_detail, 'panel' AS nielsen_source_table,
               CASE WHEN seed.mrkt_norm IS NOT NULL THEN 'YES' ELSE 'PENDING' END AS promoted
        FROM live LEFT JOIN seed USING (source_cbu, mrkt_norm)
        UNION ALL SELECT ref.*, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'REFERENCE' FROM ref""",
}


def market_seed(t: Tables, *more: str) -> DataFrame:
    known = std.market_label_columns(live_markets(t, *more), "mrkt_dsc_shrt")
    known = known.filter(~F.col("canal_lvl2").isin("PROXIMIDAD", "SIN_CLASIFICAR"))
    return known.withColumns({"canal_std": F.col("canal_lvl2"), "review_status": F.lit("CONFIRMED")})


def catalog_rows(t: Tables) -> DataFrame:
    """Several markets share a label, so the seed has equal copies of most rows."""
    live = live_markets(t).withColumn("nielsen_source_table", F.lit("panel"))
    reference = t.stores.select(F.lit("IBP").alias("source_cbu"), F.col("region").alias("mrkt_dsc_shrt"))
    return catalogs.market_catalog(live, market_seed(t), reference, "2024-05-01", "v2")


@query(
    roles=("markets", "stores"),
    extra=CATALOG,
    sql="""SELECT SUBSTR(MD5(source_cbu || '|' || mrkt_norm), 1, 16) AS market_key, mrkt_dsc_shrt, mrkt_norm AS mrkt_dsc_shrt_norm, canal_std, canal_lvl1, canal_lvl2, agg_level, region_type, region_std,
                  region_detail, CASE WHEN region_std = 'TOTAL_MEXICO' THEN 'YES' ELSE 'NO' END AS is_total_mexico, CASE WHEN canal_std LIKE '%SCANNING%' THEN 'YES' ELSE 'NO' END AS is_scanning,
                  source_cbu, CAST(NULL AS VARCHAR) AS source_table, nielsen_source_table, promoted, CASE promoted WHEN 'YES' THEN 'CONFIRMED' ELSE promoted END AS confirmation_status,
                  DATE '2024-05-01' AS catalog_date, 'v2' AS catalog_version, CASE WHEN promoted = 'PENDING' THEN 'No match in seed' END AS notes FROM cat""",
)
def market_catalog(t: Tables) -> DataFrame:
    return catalog_rows(t)


@query(
    roles=("markets",),
    extra={k: CATALOG[k] for k in MARKET_EXTRA}
    | {
        "s": f"""SELECT {UNIT} AS source_cbu, UPPER(TRIM(mrkt_dsc_shrt)) AS mrkt_norm, canal_lvl2 AS canal_std FROM classified WHERE canal_lvl2 NOT IN ('PROXIMIDAD', 'SIN_CLASIFICAR')
                UNION ALL SELECT {UNIT}, UPPER(TRIM(mrkt_dsc_shrt)), 'OTHER' FROM classified WHERE canal_lvl2 NOT IN ('PROXIMIDAD', 'SIN_CLASIFICAR') AND market_id % 56 = 3""",
        "k": "SELECT COUNT(*) AS n, COUNT(DISTINCT canal_std) AS v FROM s GROUP BY source_cbu, mrkt_norm",
        "m": "SELECT COUNT(CASE WHEN v > 1 THEN 1 END) AS conflicts, COUNT(CASE WHEN v = 1 AND n > 1 THEN 1 END) AS copies FROM k",
    },
    sql="""SELECT 'M12' AS check_id, 'market_seed' AS table_name, CAST(conflicts AS DOUBLE) AS metric, 0.0::DOUBLE AS threshold, CASE WHEN conflicts > 0 THEN 'BLOCKER' ELSE 'PASS' END AS status FROM m
           UNION ALL SELECT 'M12W', 'market_seed', CAST(copies AS DOUBLE), 0.0::DOUBLE, CASE WHEN copies > 0 THEN 'WARNING' ELSE 'PASS' END FROM m""",
)
def market_key_audit(t: Tables) -> DataFrame:
    """A seed with equal copies of labels, and some labels under a second channel."""
    seed = market_seed(t, "market_id")
    second = F.when(F.col("market_id") % 56 == 3, F.array("canal_std", F.lit("OTHER"))).otherwise(F.array("canal_std"))
    return catalogs.market_key_audit(seed.withColumn("canal_std", F.explode(second)))


@query(
    roles=("markets", "stores"),
    extra=CATALOG,
    sql="SELECT promoted AS part, COUNT(*) AS n_rows FROM cat WHERE promoted <> 'REFERENCE' GROUP BY promoted UNION ALL SELECT 'ALL', COUNT(*) FROM cat",
)
def market_catalog_split(t: Tables) -> DataFrame:
    parts = catalogs.catalog_split(catalog_rows(t))
    names = {"promoted": "YES", "pending": "PENDING", "reference": "ALL"}
    return std.union_by_name_missing(
        [df.agg(F.lit(names[n]).alias("part"), F.count("*").alias("n_rows")) for n, df in parts.items()]
    )


@query(
    """SELECT l_orderkey, l_linenumber, CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) AS n_versions, CASE WHEN COUNT(*) > 1 THEN 'CONFLICTING' ELSE 'IDENTICAL' END AS duplicate_kind
       FROM (SELECT l_orderkey, l_linenumber, l_returnflag, COUNT(*) AS n FROM lineitem GROUP BY ALL) GROUP BY ALL HAVING SUM(n) > 1"""
)
def duplicate_key_audit(t: Tables) -> DataFrame:
    keyed = t.lineitem.withColumn("key", F.struct("l_orderkey", "l_linenumber"))
    out = catalogs.duplicate_key_audit(keyed, "key", ["l_returnflag"])
    return out.select("key.*", "n_rows", "n_versions", "duplicate_kind")


@query(roles=("markets",), extra=MARKET_EXTRA, sql="SELECT region_type, COUNT(*) AS n_rows FROM classified GROUP BY region_type")
def region_level_distribution(t: Tables) -> DataFrame:
    return catalogs.region_level_distribution(classified_markets(t))


@query(
    extra={"seed": SEED_SQL, "d": DIM_CHANNEL_SQL.format("seed")},
    sql="SELECT *, DATE '2024-05-01' AS catalog_date, 'v2' AS catalog_version FROM d",
)
def channel_catalog(t: Tables) -> DataFrame:
    return catalogs.channel_catalog(channel_seed(t), "2024-05-01", "v2")


BRAND_CATALOG = {
    "v": """SELECT UPPER(TRIM(marca)) AS raw_variant, marca AS brand_original, 'MEDIA' AS source_system, 'marca' AS source_column, COUNT(*) AS grain_count FROM media GROUP BY marca
            UNION ALL SELECT UPPER(TRIM(brand)), brand, 'ITEMS', 'brand', COUNT(*) FROM items GROUP BY brand""",
    "best": "SELECT variant, ARG_MIN(canonical, (priority, canonical)) AS canonical, ARG_MIN(owner, (priority, canonical)) AS owner FROM crosswalk GROUP BY variant",
    "c": """SELECT best.canonical AS marca_std, v.*, COALESCE(best.owner, 'UNKNOWN') AS brand_owner,
                   CASE WHEN best.canonical IS NOT NULL THEN 'CONFIRMED' WHEN raw_variant LIKE '%BRAND#1%' OR raw_variant LIKE '%BRAND#2%' THEN 'UNMAPPED_LIKELY_OWN' ELSE 'UNMAPPED_COMPETITOR_OR_UNKNOWN' END AS coverage_status,
                   CASE WHEN best.canonical IS NOT NULL THEN 'YES' ELSE 'NO' END AS promoted FROM v LEFT JOIN best ON v.raw_variant = best.variant""",
}


def brand_rows(t: Tables) -> DataFrame:
    variants = catalogs.brand_variants({("MEDIA", "marca"): t.media, ("ITEMS", "brand"): t.items})
    return catalogs.brand_catalog(variants, t.crosswalk, ["brand#1", "brand#2"])


@query(roles=("media", "items", "crosswalk"), extra=BRAND_CATALOG, sql="SELECT * FROM c")
def brand_catalog(t: Tables) -> DataFrame:
    return brand_rows(t)


@query(
    roles=("media", "items", "crosswalk"),
    extra=BRAND_CATALOG,
    sql="""SELECT source_system, source_column, COUNT(DISTINCT raw_variant) AS total_variants, COUNT(CASE WHEN coverage_status = 'CONFIRMED' THEN 1 END) AS confirmed,
                  COUNT(CASE WHEN coverage_status LIKE 'UNMAPPED%' THEN 1 END) AS unmapped, CAST(SUM(grain_count) AS BIGINT) AS total_grain_records,
                  ROUND(COUNT(CASE WHEN coverage_status = 'CONFIRMED' THEN 1 END) * 100.0::DOUBLE / COUNT(DISTINCT raw_variant), 6) AS coverage_pct,
                  CASE WHEN COUNT(CASE WHEN coverage_status = 'CONFIRMED' THEN 1 END) * 100.0::DOUBLE / COUNT(DISTINCT raw_variant) < 97.2 THEN 'WARN' ELSE 'PASS' END AS status FROM c GROUP BY ALL""",
)
def coverage_by_source(t: Tables) -> DataFrame:
    return rounded(catalogs.coverage_by_source(brand_rows(t)), 6)


@query(roles=("stores",), sql="SELECT DISTINCT chain AS raw_value, CAST(NULL AS VARCHAR) AS cadena_std, 'NEEDS_REVIEW' AS mapping_status FROM stores")
def catalog_scaffold(t: Tables) -> DataFrame:
    return catalogs.catalog_scaffold(t.stores, "chain", "cadena_std")


@query(
    roles=("media", "sell_in", "crosswalk"),
    extra={
        "s": """SELECT UPPER(TRIM(marca)) AS raw_value, COUNT(*) AS n_rows, ROUND(SUM(inversion_real), 2) AS volume, 'MEDIA' AS source_system FROM media GROUP BY 1
                UNION ALL SELECT UPPER(TRIM(marca_std)), COUNT(*), ROUND(SUM(revenue_mxn), 2), 'SELL_IN' FROM sell_in GROUP BY 1"""
    },
    sql="""SELECT *, CASE WHEN raw_value LIKE '%BRAND#1%' THEN 'ADD_VARIANT' ELSE 'MAP_OR_CONFIRM_UNKNOWN' END AS suggested_action FROM s
           WHERE raw_value IS NOT NULL AND raw_value NOT IN (SELECT variant FROM crosswalk)""",
)
def unmapped_worklist(t: Tables) -> DataFrame:
    sources = {"MEDIA": (t.media, "marca", "inversion_real"), "SELL_IN": (t.sell_in, "marca_std", "revenue_mxn")}
    return rounded(catalogs.unmapped_worklist(sources, t.crosswalk, "variant", {"brand#1": "ADD_VARIANT"}), 2)


@query(
    roles=("media", "crosswalk"),
    sql="""SELECT 'MEDIA' AS source_table, 'marca' AS field_name, UPPER(TRIM(marca)) AS raw_value, COUNT(*) AS row_count_affected, 'PENDING' AS resolution_status FROM media
           WHERE UPPER(TRIM(marca)) NOT IN (SELECT variant FROM crosswalk) GROUP BY 3""",
)
def homologation_exceptions(t: Tables) -> DataFrame:
    return catalogs.homologation_exceptions(t.media, "MEDIA", "marca", t.crosswalk, "variant")


# --- dimensions --------------------------------------------------------------------------------


@query(
    """SELECT CAST(STRFTIME(d, '%Y%m%d') AS INT) AS date_key, d AS full_date, CAST(ISODOW(d) AS INT) AS day_of_week, DAYNAME(d) AS day_name, CAST(DAY(d) AS INT) AS day_of_month,
              CAST(DAYOFYEAR(d) AS INT) AS day_of_year, CAST(WEEKOFYEAR(d) AS INT) AS week_number, CAST(DATE_TRUNC('week', d) AS DATE) AS week_start_date,
              CAST(DATE_TRUNC('week', d) AS DATE) + 6 AS week_end_date, CAST(MONTH(d) AS INT) AS month_number, MONTHNAME(d) AS month_name, CAST(QUARTER(d) AS INT) AS quarter_number, CAST(YEAR(d) AS INT) AS year_number,
              CAST(MONTH(f) AS INT) AS fiscal_month, CAST(QUARTER(f) AS INT) AS fiscal_quarter, CAST(YEAR(f) AS INT) AS fiscal_year, 'FY' || YEAR(f) || '-P' || LPAD(CAST(MONTH(f) AS VARCHAR), 2, '0') AS fiscal_period_name,
              d = LAST_DAY(d) AS is_last_day_of_month, d = LAST_DAY(d) AND MONTH(d) % 3 = 0 AS is_last_day_of_quarter
       FROM (SELECT d, CAST(d + INTERVAL 9 MONTH AS DATE) AS f FROM (SELECT CAST(UNNEST(GENERATE_SERIES(a, b, INTERVAL 1 DAY)) AS DATE) AS d
             FROM (SELECT CAST(MIN(o_orderdate) AS DATE) AS a, CAST(MAX(o_orderdate) AS DATE) + 364 AS b FROM orders)))"""
)
def dim_date(t: Tables) -> DataFrame:
    """Days from the first to the last order and a year beyond; the fiscal year starts in April."""
    span = t.orders.agg(
        F.min("o_orderdate").cast("date").alias("first_day"), F.max("o_orderdate").cast("date").alias("last_day")
    )
    return catalogs.dim_date(span, "first_day", "last_day", 52, 4)


SCD = {
    "d": """SELECT p_brand AS brand_id, MIN(p_name) AS brand_name, MIN(p_type) AS category, DATE '2020-01-01' AS effective_date, CAST(NULL AS DATE) AS expiry_date, TRUE AS is_current FROM part WHERE p_brand <> 'Brand#9' GROUP BY p_brand
            UNION ALL SELECT p_brand, MIN(p_name), 'OLD', DATE '2015-01-01', DATE '2019-12-31', FALSE FROM part WHERE p_brand = 'Brand#4' GROUP BY p_brand""",
    "u": "SELECT p_brand AS brand_id, MAX(p_name) AS n_name, CASE WHEN MAX(p_size) = 50 THEN 'NEWCAT' ELSE MIN(p_type) END AS n_cat FROM part WHERE p_brand <> 'Brand#5' GROUP BY p_brand",
    "j": """SELECT COALESCE(d.brand_id, u.brand_id) AS brand_id, d.brand_name, d.category, d.effective_date, d.expiry_date, d.brand_id IS NULL AS is_new, u.brand_id IS NOT NULL AS hit, u.n_name, u.n_cat,
                   d.brand_id IS NOT NULL AND u.brand_id IS NOT NULL AND d.category IS DISTINCT FROM u.n_cat AS changed
            FROM (SELECT * FROM d WHERE is_current) d FULL JOIN u ON d.brand_id = u.brand_id""",
}


@query(
    extra=SCD,
    sql="""SELECT brand_id, brand_name, category, effective_date, expiry_date, is_current FROM d WHERE NOT is_current
           UNION ALL SELECT brand_id, CASE WHEN hit AND NOT changed THEN n_name ELSE brand_name END, category, effective_date, CASE WHEN changed THEN DATE '2024-02-29' ELSE expiry_date END, NOT changed FROM j WHERE NOT is_new
           UNION ALL SELECT brand_id, n_name, n_cat, DATE '2024-03-01', NULL, TRUE FROM j WHERE is_new OR changed""",
)
def dim_brand_scd(t: Tables) -> DataFrame:
    """Brands of the product master; an update moves those with the largest size to a new category."""
    day = lambda d: F.lit(d).cast("date")
    by_brand = t.part.groupBy(F.col("p_brand").alias("brand_id"))
    current = by_brand.agg(F.min("p_name").alias("brand_name"), F.min("p_type").alias("category")).filter("brand_id <> 'Brand#9'")
    current = current.select("*", day("2020-01-01").alias("effective_date"), S.null_column("date").alias("expiry_date"), F.lit(True).alias("is_current"))
    closed = current.filter("brand_id = 'Brand#4'").withColumns(
        {"category": F.lit("OLD"), "effective_date": day("2015-01-01"), "expiry_date": day("2019-12-31"), "is_current": F.lit(False)}
    )
    category = F.when(F.max("p_size") == 50, "NEWCAT").otherwise(F.min("p_type"))
    updates = by_brand.agg(F.max("p_name").alias("brand_name"), category.alias("category")).filter("brand_id <> 'Brand#5'")
    return catalogs.dim_brand_scd(current.unionByName(closed), updates, day("2024-03-01"))
