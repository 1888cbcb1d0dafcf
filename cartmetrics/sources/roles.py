"""The generic test tables in the role of commercial sources.

Every role is a lazy projection of the given tables, so its size grows with them. ``cartmetrics.plans
.role_sql`` states the same roles in SQL for the oracle.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartmetrics.functions.scalars import month_trunc, stable_round
from cartmetrics.sources.readers import read_source

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
RAW_CHANNELS = (" moderno ", "DTT", "INTERNAL", "NC Moderno", "OTHER")
METRICS = {"click": "VALUE_SHARE", "view": "VOLUME_SHARE", "purchase": "DOL", "signup": "U", "error": "NUM_DIST"}
OWN_BRANDS = [f"BRAND#{i}" for i in range(1, 13)]
MARKET_PREFIXES = (
    "TOTAL MEXICO AUTOSERVICIOS SCANNING", "AUTOS SCANNING", "CANAL TRADICIONAL", "GRANDES CADENAS DE AUTOSERVICIO",
    "TDC + FARMACIAS CAD + HARD DISCOUNTERS", "C PROXIMIDAD", "MODERNO", "SURTIDO COMPLETO",
)
MARKET_SUFFIXES = (
    "_AREA 1", " AREA 10", " AREA 2.1", " VDM ZONA II", " GUADALAJARA.", " AREA 6_MT", " AREAS 3 + 4 + 5 + 6",
)


def pick(values: tuple[str, ...], index: Column) -> Column:
    """Element of a fixed list by position, modulo its length."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def text(col: Column) -> Column:
    return col.cast("string")


class Tables:
    """Base tables and roles of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return read_source(self.spark, f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)

    # --- master data ---------------------------------------------------------------------------

    @cached_property
    def items(self) -> DataFrame:
        """Product master: part with a bar code that is missing, blank or shared by up to three."""
        c = F.col
        ean = (
            F.when(c("p_size") % 10 == 0, F.lit(None))
            .when(c("p_size") % 10 == 1, " ")
            .otherwise(F.concat(F.lit("E"), text(c("p_partkey") - c("p_partkey") % 3)))
        )
        return self.part.select(
            text(c("p_partkey")).alias("mat_idt"),
            ean.alias("sku_ean_cod"),
            c("p_name").alias("mat_lcl_dsc"),
            c("p_brand").alias("brand"),
            F.when(c("p_type").isin("ECONOMY", "SMALL", "MEDIUM"), "WATERS").otherwise("EDP").alias("cbu"),
            (c("p_size") > 25).alias("is_active"),
            c("p_type").alias("category"),
            c("p_size").alias("size"),
        )

    @cached_property
    def store_products(self) -> DataFrame:
        """Products as the stores know them, with two candidate codes."""
        key = F.col("p_partkey")
        return self.part.select(
            F.when(key % 2 == 0, F.concat(F.lit("E"), text(key))).otherwise(F.concat(F.lit("X"), text(key))).alias("int_id"),
            F.concat(F.lit("E"), text(key - key % 3)).alias("import_id"),
            F.col("p_name").alias("so_name"),
            F.col("p_brand").alias("so_brand"),
            F.col("p_type").alias("so_category"),
        )

    @cached_property
    def dictionary(self) -> DataFrame:
        """Customer renumbering: chains, no-change rows, missing targets and repeated old ids."""
        key = F.col("s_suppkey")
        org = F.when(F.col("s_nationkey") % 2 == 0, "0049").otherwise("0068").alias("sal_org_cod")
        base = self.supplier.select(
            text(key).alias("old_cus_idt"),
            F.when(key % 4 == 0, text(key)).when(key % 4 != 3, text(key + 1)).alias("new_cus_idt"),
            org,
        )
        again = self.supplier.filter(F.col("s_nationkey") < 5).select(
            text(key).alias("old_cus_idt"), text(key + 2).alias("new_cus_idt"), org
        )
        return base.unionByName(again)

    @cached_property
    def clients(self) -> DataFrame:
        return self.supplier.join(self.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
            text(F.col("s_suppkey")).alias("cus_idt"),
            pick(RAW_CHANNELS, F.col("s_nationkey")).alias("canal_raw"),
            F.col("n_name").alias("cus_grp_dsc"),
            F.when(F.col("s_nationkey") % 2 == 0, "0049").otherwise("0068").alias("sal_org_cod"),
        )

    @cached_property
    def stores(self) -> DataFrame:
        return (
            self.customer.join(self.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                text(F.col("c_custkey")).alias("store_id"),
                F.col("n_name").alias("chain"),
                F.col("c_mktsegment").alias("format"),
                F.col("r_name").alias("region"),
            )
        )

    @cached_property
    def crosswalk(self) -> DataFrame:
        """Brand variants from the product master, one of them listed under two canonical names."""
        brands = self.part.select(F.upper("p_brand").alias("canonical")).distinct()
        number = F.split_part("canonical", F.lit("#"), F.lit(2)).cast("int")
        rows = brands.select(
            F.replace(F.col("canonical"), F.lit("#"), F.lit(" ")).alias("variant"),
            "canonical",
            F.when(number <= 12, "OWN").otherwise("COMPETITOR").alias("owner"),
            number.alias("priority"),
        )
        overlap = rows.filter("priority <= 5").select(
            "variant", F.lit("OVERLAP").alias("canonical"), F.lit("COMPETITOR").alias("owner"), F.lit(99).alias("priority")
        )
        return rows.unionByName(overlap)

    # --- facts ---------------------------------------------------------------------------------

    @cached_property
    def shipments(self) -> DataFrame:
        """Raw shipments: lineitem alone."""
        c = F.col
        return self.lineitem.select(
            text(c("l_partkey")).alias("mat_idt"),
            text(c("l_suppkey")).alias("shp_cus_idt"),
            F.when(c("l_linestatus") == "O", "WATERS").alias("cbu"),
            c("l_returnflag").alias("dis_chl_cod"),
            c("l_shipdate").cast("date").alias("bill_date"),
            c("l_extendedprice").alias("revenue_mxn"),
            c("l_quantity").alias("volume_liter"),
            (c("l_quantity") * (1 - c("l_discount"))).alias("volume_kgr"),
            c("l_linenumber").cast("double").alias("cases"),
            F.lit(1.0).alias("sku_qty"),
        )

    @cached_property
    def sell_in(self) -> DataFrame:
        """Shipment rows with brand, channel and business unit."""
        supplier = self.supplier.select(
            text(F.col("s_suppkey")).alias("shp_cus_idt"), pick(SEGMENTS, F.col("s_nationkey")).alias("canal_std")
        )
        product = self.items.select(
            "mat_idt",
            "sku_ean_cod",
            F.when(F.col("size") != 50, F.upper("brand")).alias("marca_std"),
            F.col("cbu").alias("item_cbu"),
        )
        rows = self.shipments.join(product, "mat_idt").join(supplier, "shp_cus_idt")
        return rows.withColumns(
            {"fecha_month": month_trunc(F.col("bill_date")), "cbu": F.coalesce("cbu", "item_cbu")}
        ).drop("item_cbu")

    @cached_property
    def sales(self) -> DataFrame:
        """Raw store sales: orders with their lines."""
        c = F.col
        lines = self.lineitem.select(
            "l_orderkey",
            text(c("l_partkey")).alias("upc"),
            c("l_extendedprice").alias("revenue_sell_out"),
            c("l_quantity").alias("vol_sell_out"),
            c("l_linenumber").cast("double").alias("pcs_sell_out"),
            (c("l_quantity") * c("l_tax")).alias("vol_inv"),
            F.lit(1.0).alias("pcs_inv"),
        )
        orders = self.orders.select(
            "o_orderkey", text(c("o_custkey")).alias("store_id"), c("o_orderdate").cast("date").alias("sale_date")
        )
        return lines.join(orders, c("l_orderkey") == c("o_orderkey")).drop("l_orderkey", "o_orderkey")

    @cached_property
    def sell_out(self) -> DataFrame:
        """Store sales with brand, channel, chain and bar code."""
        product = self.items.select(
            F.col("mat_idt").alias("upc"),
            "sku_ean_cod",
            F.when(F.col("size") != 50, F.upper("brand")).alias("marca_std"),
            "category",
        )
        c = F.col
        store = self.customer.select(
            text(c("c_custkey")).alias("store_id"), c("c_mktsegment").alias("format"), "c_nationkey"
        )
        # Dimensions join one by one: each is small by its own size, while a dimension joined from
        # several tables beforehand has an estimate too large to broadcast.
        rows = (
            self.sales.join(store, "store_id")
            .join(self.nation.select("n_nationkey", "n_regionkey", c("n_name").alias("chain")), c("c_nationkey") == c("n_nationkey"))
            .join(self.region.select("r_regionkey", c("r_name").alias("region")), c("n_regionkey") == c("r_regionkey"))
            .join(product, "upc")
            .drop("c_nationkey", "n_nationkey", "n_regionkey", "r_regionkey")
        )
        return rows.withColumns(
            {"fecha_month": month_trunc(c("sale_date")), "canal_std": c("format"), "cadena_std": c("chain")}
        )

    @cached_property
    def media(self) -> DataFrame:
        """Raw media spend: events with brand labels in three spellings."""
        c = F.col
        number = text(c("user_id") % 25 + 1)
        label = (
            F.when(c("user_id") % 3 == 0, F.concat(F.lit(" brand#"), number, F.lit(" ")))
            .when(c("user_id") % 3 == 1, F.concat(F.lit("Brand "), number))
            .otherwise(F.concat(F.lit("BRAND#"), number))
        )
        first = F.add_months(F.lit("1997-01-01").cast("date"), (c("event_id") % 48).cast("int"))
        return self.events.select(
            F.date_add(first, (c("event_id") % 28).cast("int")).alias("fecha"),
            label.alias("marca"),
            F.concat(F.lit("C"), text(c("user_id") % 40)).alias("campana"),
            c("event_type").alias("medio"),
            F.get_json_object("props", "$.k").alias("soporte_plataforma"),
            pick(SEGMENTS, c("event_id")).alias("canal_std"),
            F.when(c("event_type").isin("click", "view", "purchase"), "MKT_ON").otherwise("MKT_OFF").alias("investment_source"),
            (c("event_id") % 100).cast("double").alias("impresiones"),
            c("value").alias("inversion_real"),
        )

    @cached_property
    def spend(self) -> DataFrame:
        """Media spend with a plain brand and month."""
        brand = F.concat(F.lit("BRAND#"), F.regexp_extract("marca", r"(\d+)", 1))
        return self.media.withColumns({"marca_std": brand, "fecha_month": month_trunc(F.col("fecha"))})

    @cached_property
    def waste(self) -> DataFrame:
        """Returned lines as waste, most of them from the main reporting source."""
        c = F.col
        rows = self.lineitem.filter(c("l_returnflag") == "R").join(
            self.clients.withColumnRenamed("cus_idt", "_cus"), text(c("l_suppkey")) == c("_cus")
        )
        return rows.select(
            c("l_shipdate").cast("date").alias("fecha"),
            text(c("l_partkey")).alias("sku"),
            c("cus_grp_dsc").alias("cadena"),
            c("l_linestatus").alias("formato"),
            c("canal_raw").alias("canal"),
            F.when(c("l_tax") > 0.06, "OTHER").otherwise(" topline").alias("fuente"),
            F.when(c("l_quantity") > 1, c("l_extendedprice")).alias("waste_amount"),
            c("l_quantity").alias("waste_kg"),
        )

    # --- market panel --------------------------------------------------------------------------

    @cached_property
    def panel(self) -> DataFrame:
        """Long market facts by id: (market_id, product_id, period_id, fact_column, fact_value)."""
        c = F.col
        metric = F.when(c("event_type") == "error", "NUM_DIST")
        for raw, name in METRICS.items():
            metric = metric.when(c("event_type") == raw, name)
        return self.events.select(
            c("user_id").alias("market_id"),
            (c("event_id") % 50).alias("product_id"),
            (c("event_id") % 208).cast("int").alias("period_id"),
            metric.alias("fact_column"),
            c("value").alias("fact_value"),
        )

    @cached_property
    def markets(self) -> DataFrame:
        """Market dimension: one free-text label per market id."""
        c = F.col("user_id")
        return self.events.select("user_id").distinct().select(
            c.alias("market_id"),
            F.concat(pick(MARKET_PREFIXES, c), pick(MARKET_SUFFIXES, c)).alias("mrkt_dsc_shrt"),
            F.element_at(F.array(F.lit(9), F.lit(11), F.lit(7)), (c % 3 + 1).cast("int")).alias("hierarchy_level"),
            pick(SEGMENTS, c).alias("canal_std"),
            F.concat(F.lit("BRAND#"), text(c % 25 + 1)).alias("marca_std"),
        )

    @cached_property
    def periods(self) -> DataFrame:
        """Period dimension: weeks that end on Sundays from 1997 on."""
        ids = self.events.select((F.col("event_id") % 208).cast("int").alias("period_id")).distinct()
        return ids.select(
            "period_id",
            F.concat(F.lit("W"), text(F.col("period_id"))).alias("period_label"),
            F.date_add(F.lit("1997-01-05").cast("date"), 7 * F.col("period_id")).alias("period_end_date"),
        )

    @cached_property
    def metrics(self) -> DataFrame:
        """Metric reference; names are written with dots as some panels do."""
        names = self.panel.select("fact_column").distinct()
        return names.select(
            F.replace(F.col("fact_column"), F.lit("_"), F.lit(".")).alias("fact_column"),
            F.concat(F.lit("Metric "), F.lower("fact_column")).alias("fact_description"),
            F.when(F.col("fact_column").contains("SHARE"), "SHARE").otherwise("VOLUME").alias("fact_group"),
        )

    @cached_property
    def market_rows(self) -> DataFrame:
        """Panel facts with market, period and month."""
        rows = self.panel.join(self.markets, "market_id").join(self.periods, "period_id")
        return rows.withColumns(
            {
                "fecha_month": month_trunc(F.col("period_end_date")),
                "metric_name": F.col("fact_column"),
                "metric_value": F.col("fact_value"),
            }
        )

    @cached_property
    def weekly_panel(self) -> DataFrame:
        """Weekly market view per brand and channel; weeks end on Sundays, and one brand lacks a week."""
        c = F.col
        rows = self.events.filter(~((c("event_id") % 208 == 60) & (c("user_id") % 25 == 3)))
        base = rows.groupBy(
            F.concat(F.lit("BRAND#"), text(c("user_id") % 25 + 1)).alias("brand_key"),
            pick(SEGMENTS, c("user_id")).alias("channel_key"),
            F.date_add(F.lit("1997-01-05").cast("date"), (7 * (c("event_id") % 208)).cast("int")).alias("week_end"),
        ).agg(
            stable_round(F.sum("value"), 2).alias("sales"), F.count("*").alias("packs"), F.count_distinct("user_id").alias("markets")
        )
        # One row per brand is left in a channel and week, so a window over them holds few rows.
        cell = W.partitionBy("channel_key", "week_end")
        total, packs = stable_round(F.sum("sales").over(cell), 2), F.sum("packs").over(cell)
        return base.select(
            "brand_key", "channel_key", "week_end", F.count("*").over(cell).alias("n_brands"),
            stable_round(c("sales") * 100 / total, 4).alias("value_share"),
            c("markets").cast("double").alias("numeric_distribution"),
            stable_round(c("packs") * 10 / c("markets"), 4).alias("weighted_distribution"),
            stable_round((c("sales") / c("packs")) / (total / packs), 4).alias("price_index_vs_category"),
        )

    # --- series --------------------------------------------------------------------------------

    @cached_property
    def weekly(self) -> DataFrame:
        """Units and revenue per brand, channel and week."""
        rows = self.sell_out.filter(F.col("marca_std").isNotNull())
        keys = [
            F.col("marca_std").alias("brand_key"),
            F.col("canal_std").alias("channel_key"),
            F.trunc("sale_date", "week").alias("week_start"),
        ]
        return rows.groupBy(*keys).agg(
            F.sum("vol_sell_out").alias("units"), stable_round(F.sum("revenue_sell_out"), 2).alias("revenue")
        )

    @cached_property
    def weekly_spend(self) -> DataFrame:
        keys = [
            F.col("marca_std").alias("brand_key"),
            F.col("canal_std").alias("channel_key"),
            F.trunc("fecha", "week").alias("week_start"),
        ]
        return self.spend.groupBy(*keys).agg(stable_round(F.sum("inversion_real"), 2).alias("spend"))

    @cached_property
    def history(self) -> DataFrame:
        """Monthly market view per brand and channel: share, distribution and price index."""
        rows = self.sell_out.filter(F.col("marca_std").isNotNull())
        month = F.col("fecha_month")
        period = ((F.year(month) - 1995) * 12 + F.month(month)).alias("period_key")
        base = rows.groupBy(
            F.col("marca_std").alias("brand_key"), F.col("canal_std").alias("channel_key"), period, month
        ).agg(
            stable_round(F.sum("revenue_sell_out"), 2).alias("revenue"),
            F.sum("vol_sell_out").alias("units"),
            F.count_distinct("store_id").alias("stores"),
        )
        # One row per brand is left in a channel and month, so a window over them holds few rows.
        cell = W.partitionBy("channel_key", "period_key")
        out = base.withColumns(
            {
                "_revenue": stable_round(F.sum("revenue").over(cell), 2),
                "_units": F.sum("units").over(cell),
                "n_brands": F.count("*").over(cell),
            }
        )
        return out.select(
            "brand_key", "channel_key", "period_key", "fecha_month", "revenue", "units", "n_brands",
            stable_round(F.col("revenue") * 100 / F.col("_revenue"), 4).alias("value_share"),
            stable_round(F.col("units") * 100 / F.col("_units"), 4).alias("volume_share"),
            F.col("stores").cast("double").alias("numeric_distribution"),
            stable_round(F.col("units") / F.col("stores"), 4).alias("weighted_distribution"),
            stable_round((F.col("revenue") / F.col("units")) / (F.col("_revenue") / F.col("_units")), 4)
            .alias("price_index_vs_category"),
        )

    @property
    def forecast_units(self) -> Column:
        """Forecast of a history row."""
        return stable_round(F.col("units") * (0.7 + 0.1 * (F.col("period_key") % 7)), 2)

    @property
    def actual_units(self) -> Column:
        """Actual of a history row, zero in February."""
        return F.when(F.month("fecha_month") == 2, 0.0).otherwise(F.col("units"))

    @cached_property
    def forecast(self) -> DataFrame:
        """Monthly forecast beside the actual of each brand and channel."""
        kind = F.when(F.col("channel_key").isin("AUTOMOBILE", "FURNITURE"), "MODERN").otherwise("TRADITIONAL")
        return self.history.select(
            "brand_key", "channel_key", "period_key", "fecha_month",
            kind.alias("channel_type"),
            self.forecast_units.alias("forecasted_units"), self.actual_units.alias("actual_units"),
            (F.month("fecha_month") != 6).alias("is_official_version"),
            (F.col("channel_key") != "MACHINERY").alias("is_reportable"),
        )
