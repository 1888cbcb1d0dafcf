"""Master catalogs, dimensions and worklists of unmapped values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartmetrics.functions import labels
from cartmetrics.functions.scalars import norm_key, null_column, safe_divide, surrogate_key
from cartmetrics.operators.joins import first_row_dedup, mapping_left_join, unique_row
from cartmetrics.operators.std import dim_channel

# --- markets -----------------------------------------------------------------------------------


# The columns of the market catalog, in their order.
MARKET_COLUMNS = (
    "market_key", "mrkt_dsc_shrt", "mrkt_dsc_shrt_norm", "canal_std", "canal_lvl1", "canal_lvl2", "agg_level", "region_type",
    "region_std", "region_detail", "is_total_mexico", "is_scanning", "source_cbu", "source_table", "nielsen_source_table",
    "promoted", "confirmation_status", "catalog_date", "catalog_version", "notes",
)
SEED_PAYLOAD = ("canal_lvl1", "canal_lvl2", "canal_std", "agg_level", "region_type", "region_std", "region_detail", "review_status")


def _labels(df: DataFrame) -> DataFrame:
    """One row per unit and normalized label, with the first raw spelling and the tables it came from."""
    have = [F.min(c).alias(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in ("source_table", "nielsen_source_table")]
    named = df.withColumn("mrkt_dsc_shrt_norm", norm_key(F.col("mrkt_dsc_shrt"))).filter(F.col("mrkt_dsc_shrt_norm").isNotNull())
    return named.groupBy("source_cbu", "mrkt_dsc_shrt_norm").agg(F.min("mrkt_dsc_shrt").alias("mrkt_dsc_shrt"), *have)


def market_key_audit(seed: DataFrame, table: str = "market_seed") -> DataFrame:
    """The duplicate audit of a market seed, which stands before every deduplication, as check rows: labels of a unit
    whose rows differ in channel or review status block (M12), labels with equal copies warn (M12W)."""
    norm = norm_key(F.col("mrkt_dsc_shrt")).alias("mrkt_dsc_shrt_norm")
    per_label = seed.select("source_cbu", norm, F.struct("canal_std", "review_status").alias("_row")).filter(F.col("mrkt_dsc_shrt_norm").isNotNull())
    per_label = per_label.groupBy("source_cbu", "mrkt_dsc_shrt_norm").agg(F.count("*").alias("n"), F.min("_row").alias("a"), F.max("_row").alias("b"))
    differ = ~F.col("a").eqNullSafe(F.col("b"))
    counts = per_label.agg(F.count_if((F.col("n") > 1) & differ).alias("M12"), F.count_if((F.col("n") > 1) & ~differ).alias("M12W"))
    rows = [
        F.struct(
            F.lit(name).alias("check_id"), F.lit(table).alias("table_name"), F.col(name).cast("double").alias("metric"),
            F.lit(0.0).alias("threshold"), F.when(F.col(name) > 0, status).otherwise("PASS").alias("status"),
        )
        for name, status in (("M12", "BLOCKER"), ("M12W", "WARNING"))
    ]
    return counts.select(F.inline(F.array(*rows)))


def market_catalog(
    live: DataFrame, seed: DataFrame, reference: DataFrame | None = None, run_date: str | None = None, version: str = "v1",
    on_conflict: str = "error",
) -> DataFrame:
    """Live market labels (source_cbu, mrkt_dsc_shrt and, if known, source_table and nielsen_source_table) with the
    confirmed seed rows of their unit: the twenty columns of MARKET_COLUMNS, one row per unit and normalized label.

    The seed carries source_cbu, mrkt_dsc_shrt and SEED_PAYLOAD. A label without a seed row is PENDING; reference-only
    labels of other sources are REFERENCE. Equal copies of a seed row count once; rows of a label that differ fail the
    job, or give their first with ``on_conflict="first"`` (see market_key_audit). Labels are told apart by themselves:
    market_key, a shortened hash, identifies a row for readers and decides nothing here.
    """
    norm = norm_key(F.col("mrkt_dsc_shrt")).alias("mrkt_dsc_shrt_norm")
    rows = seed.select("source_cbu", norm, *SEED_PAYLOAD).filter(F.col("mrkt_dsc_shrt_norm").isNotNull())
    on = ["source_cbu", "mrkt_dsc_shrt_norm"]
    known = unique_row(rows, on) if on_conflict == "error" else first_row_dedup(rows, on)
    joined = _labels(live).join(known, on, "left")
    joined = joined.withColumn("promoted", F.when(F.col("review_status").isNotNull(), "YES").otherwise("PENDING"))
    if reference is not None:
        extra = _labels(reference).join(_labels(live).select(*on), on, "left_anti")
        joined = joined.unionByName(extra.withColumn("promoted", F.lit("REFERENCE")), allowMissingColumns=True)
    promoted = F.col("promoted")
    date = F.current_date() if run_date is None else F.lit(run_date).cast("date")
    return joined.withColumns(
        {
            "market_key": surrogate_key(F.col("source_cbu"), F.col("mrkt_dsc_shrt_norm")),
            "is_total_mexico": labels.is_total_mexico(F.col("region_std")),
            "is_scanning": labels.is_scanning(F.col("canal_std")),
            "confirmation_status": F.when(promoted == "YES", "CONFIRMED").otherwise(promoted),
            "catalog_date": date,
            "catalog_version": F.lit(version),
            "notes": F.when(promoted == "PENDING", "No match in seed"),
        }
    ).select(*MARKET_COLUMNS)


def catalog_split(catalog: DataFrame) -> dict[str, DataFrame]:
    """The catalog's promoted, pending and complete parts."""
    return {
        "promoted": catalog.filter(F.col("promoted") == "YES"),
        "pending": catalog.filter(F.col("promoted") == "PENDING"),
        "reference": catalog,
    }


def duplicate_key_audit(df: DataFrame, key: str, payload: Sequence[str]) -> DataFrame:
    """Keys with several rows: identical copies, or a conflict where the payload differs.

    Distinct payloads are counted before the key is, so many copies of one key collapse early.
    """
    versions = df.groupBy(key, *payload).agg(F.count("*").alias("_n"))
    per_key = versions.groupBy(key).agg(F.sum("_n").alias("n_rows"), F.count("*").alias("n_versions"))
    kind = F.when(F.col("n_versions") > 1, "CONFLICTING").otherwise("IDENTICAL")
    return per_key.filter(F.col("n_rows") > 1).withColumn("duplicate_kind", kind)


def region_level_distribution(df: DataFrame, level: str = "region_type") -> DataFrame:
    return df.groupBy(level).agg(F.count("*").alias("n_rows"))


# --- channels and brands -----------------------------------------------------------------------


def channel_catalog(seed: DataFrame, run_date: str | None = None, version: str = "v1") -> DataFrame:
    """The rows of dim_channel, normalized and with the same key over seven columns, as a dated catalog."""
    date = F.current_date() if run_date is None else F.lit(run_date).cast("date")
    return dim_channel(seed).withColumns({"catalog_date": date, "catalog_version": F.lit(version)})


def brand_variants(sources: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Raw brand labels of many sources with their row counts: {(system, column): rows}."""
    parts = [
        df.groupBy(F.col(column).alias("brand_original")).agg(F.count("*").alias("grain_count")).select(
            norm_key(F.col("brand_original")).alias("raw_variant"), "brand_original",
            F.lit(system).alias("source_system"), F.lit(column).alias("source_column"), "grain_count",
        )
        for (system, column), df in sources.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def brand_catalog(variants: DataFrame, crosswalk: DataFrame, own_keywords: Sequence[str]) -> DataFrame:
    """Each variant with its canonical brand, owner and status: in the crosswalk, likely own by a
    keyword it contains, or unknown. Of several canonical names the lowest priority wins, as in brand_std."""
    best = crosswalk.groupBy("variant").agg(F.min_by(F.struct("canonical", "owner"), F.struct("priority", "canonical", "owner")).alias("b"))
    best = best.select("variant", "b.canonical", "b.owner")
    out = mapping_left_join(variants, best, "raw_variant", "variant", ["canonical", "owner"], "_")
    likely = reduce(lambda a, b: a | b, [F.col("raw_variant").contains(k.upper()) for k in own_keywords], F.lit(False))
    status = (
        F.when(F.col("_canonical").isNotNull(), "CONFIRMED")
        .when(F.coalesce(likely, F.lit(False)), "UNMAPPED_LIKELY_OWN")
        .otherwise("UNMAPPED_COMPETITOR_OR_UNKNOWN")
    )
    return out.select(
        F.col("_canonical").alias("marca_std"),
        *variants.columns,
        F.coalesce("_owner", F.lit("UNKNOWN")).alias("brand_owner"),
        status.alias("coverage_status"),
        F.when(F.col("_canonical").isNotNull(), "YES").otherwise("NO").alias("promoted"),
    )


def coverage_by_source(classified: DataFrame, gate_pct: float = 97.2) -> DataFrame:
    """Confirmed share of the variants of each source against the coverage gate."""
    status = F.col("coverage_status")
    out = classified.groupBy("source_system", "source_column").agg(
        F.count_distinct("raw_variant").alias("total_variants"),
        F.count_if(status == "CONFIRMED").alias("confirmed"),
        F.count_if(status.startswith("UNMAPPED")).alias("unmapped"),
        F.sum("grain_count").alias("total_grain_records"),
    )
    pct = safe_divide(F.col("confirmed") * 100.0, F.col("total_variants"))
    return out.withColumns({"coverage_pct": pct, "status": F.when(pct < gate_pct, "WARN").otherwise("PASS")})


def catalog_scaffold(df: DataFrame, col: str, std: str) -> DataFrame:
    """Distinct raw values to be mapped by hand."""
    return (
        df.select(F.col(col).alias("raw_value"))
        .filter(F.col("raw_value").isNotNull())
        .distinct()
        .select("raw_value", null_column().alias(std), F.lit("NEEDS_REVIEW").alias("mapping_status"))
    )


def unmapped_worklist(
    sources: Mapping[str, tuple[DataFrame, str, str]], mapping: DataFrame, map_key: str, hints: Mapping[str, str] | None = None
) -> DataFrame:
    """Values of all sources that the confirmed map lacks, with their volume, largest first to do.

    sources: {name: (rows, value column, volume column)}. Volumes are added up per value before the
    anti join.
    """
    parts = [
        df.groupBy(norm_key(F.col(value)).alias("raw_value")).agg(
            F.count("*").alias("n_rows"), F.sum(volume).cast("double").alias("volume")
        ).withColumn("source_system", F.lit(name))
        for name, (df, value, volume) in sources.items()
    ]
    every = reduce(lambda a, b: a.unionByName(b), parts).filter(F.col("raw_value").isNotNull())
    known = mapping.select(norm_key(F.col(map_key)).alias("raw_value")).distinct()
    todo = every.join(known, "raw_value", "left_anti")
    action = F.lit("MAP_OR_CONFIRM_UNKNOWN")
    for text, advice in (hints or {}).items():
        action = F.when(F.col("raw_value").contains(text.upper()), advice).otherwise(action)
    return todo.withColumn("suggested_action", action)


def homologation_exceptions(
    df: DataFrame, source_table: str, field: str, mapping: DataFrame, map_key: str
) -> DataFrame:
    """Raw values without a mapping and the rows they affect, open for a data steward."""
    counts = df.filter(F.col(field).isNotNull()).groupBy(norm_key(F.col(field)).alias("raw_value")).agg(
        F.count("*").alias("row_count_affected")
    )
    known = mapping.select(norm_key(F.col(map_key)).alias("raw_value")).distinct()
    return counts.join(known, "raw_value", "left_anti").select(
        F.lit(source_table).alias("source_table"), F.lit(field).alias("field_name"), "raw_value",
        "row_count_affected", F.lit("PENDING").alias("resolution_status"),
    )


# --- dimensions --------------------------------------------------------------------------------


def dim_date(span: DataFrame, start: str, end: str, horizon_weeks: int = 52, fiscal_start_month: int = 1) -> DataFrame:
    """One row per day from the first to the last date of a one-row frame plus a horizon.

    ``start`` and ``end`` name its columns. The fiscal year starts in ``fiscal_start_month`` and is
    named after the calendar year it ends in.
    """
    days = span.select(
        F.explode(
            F.sequence(F.col(start), F.date_add(F.col(end), 7 * horizon_weeks), F.expr("interval 1 day"))
        ).alias("full_date")
    )
    d = F.col("full_date")
    fiscal = F.add_months(d, (13 - fiscal_start_month) % 12)
    week_start = F.trunc(d, "week")
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d,
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_number"),
        week_start.alias("week_start_date"),
        F.date_add(week_start, 6).alias("week_end_date"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter_number"),
        F.year(d).alias("year_number"),
        F.month(fiscal).alias("fiscal_month"),
        F.quarter(fiscal).alias("fiscal_quarter"),
        F.year(fiscal).alias("fiscal_year"),
        F.concat(F.lit("FY"), F.year(fiscal).cast("string"), F.lit("-P"), F.lpad(F.month(fiscal).cast("string"), 2, "0"))
        .alias("fiscal_period_name"),
        (d == F.last_day(d)).alias("is_last_day_of_month"),
        (d == F.last_day(F.add_months(F.trunc(d, "quarter"), 2))).alias("is_last_day_of_quarter"),
    )


def dim_brand_scd(
    dim: DataFrame, updates: DataFrame, as_of: Column, tracked: str = "category", display: Sequence[str] = ("brand_name",)
) -> DataFrame:
    """New state of a brand dimension after a batch of updates.

    A changed ``tracked`` value closes the current row and opens a new one (history kept); display
    columns are overwritten in the current row. Closed rows pass through; brands without an update
    stay as they are. Repeated equal updates of a brand count once, different ones fail the job; updates without
    brand_id are left out.
    """
    updates = unique_row(updates.select("brand_id", tracked, *display).filter(F.col("brand_id").isNotNull()), ["brand_id"])
    history = dim.filter(~F.col("is_current"))
    current = dim.filter(F.col("is_current"))
    new = updates.select("brand_id", *[F.col(c).alias(f"_new_{c}") for c in (tracked, *display)], F.lit(True).alias("_hit"))
    both = current.join(new, "brand_id", "full")
    is_new = F.col("is_current").isNull()
    changed = ~is_new & F.col("_hit") & ~F.col(tracked).eqNullSafe(F.col(f"_new_{tracked}"))
    changed = F.coalesce(changed, F.lit(False))
    kept = F.struct(
        *[F.when(F.col("_hit") & ~changed, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in display],
        F.col(tracked).alias(tracked),
        F.col("effective_date").alias("effective_date"),
        F.when(changed, F.date_sub(as_of, 1)).otherwise(F.col("expiry_date")).alias("expiry_date"),
        (~changed).alias("is_current"),
    )
    opened = F.struct(
        *[F.col(f"_new_{c}").alias(c) for c in display],
        F.col(f"_new_{tracked}").alias(tracked),
        as_of.alias("effective_date"),
        F.lit(None).cast("date").alias("expiry_date"),
        F.lit(True).alias("is_current"),
    )
    rows = F.array_compact(F.array(F.when(~is_new, kept), F.when(is_new | changed, opened)))
    fresh = both.select("brand_id", F.inline(rows))
    return history.select(*fresh.columns).unionByName(fresh)
