"""Projections, filters and standardization of source tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartmetrics.functions import labels
from cartmetrics.functions.scalars import norm_key, null_column, surrogate_key, zero_if_null
from cartmetrics.operators.joins import mapping_left_join


# --- filters -----------------------------------------------------------------------------------


def period_filter(df: DataFrame, col: str, start: object) -> DataFrame:
    """Rows from a start on, compared in the type of the column so the scan can skip row groups."""
    return df.filter(F.col(col) >= F.lit(start))


def active_catalog_filter(df: DataFrame, ean: str) -> DataFrame:
    """Active products have a bar code that is neither NULL nor blank."""
    return df.filter(F.col(ean).isNotNull() & (F.trim(F.col(ean).cast("string")) != ""))


def code_exclusion_filter(df: DataFrame, exclusions: Mapping[str, Sequence[object]]) -> DataFrame:
    """SQL ``NOT IN`` per column: a NULL code is neither in nor out, so the row goes too."""
    return reduce(lambda d, kv: d.filter(~F.col(kv[0]).isin(list(kv[1]))), exclusions.items(), df)


def source_flag_filter(df: DataFrame, col: str, flag: str) -> DataFrame:
    return df.filter(norm_key(F.col(col)) == flag.upper().strip())


def hierarchy_level_filter(df: DataFrame, level: int, col: str = "hierarchy_level") -> DataFrame:
    return df.filter(F.col(col) == level)


def scenario_guard(df: DataFrame, scenario: str, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Sum planning measures. Actual, plan and adjustment rows of one sale live in one table, so a
    sum without the scenario in its keys is refused."""
    if scenario not in keys:
        raise ValueError(f"group by '{scenario}' or filter it first: scenarios must not be added up")
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def sentinel_exclusion(df: DataFrame, col: str, labels_df: DataFrame, label_col: str) -> DataFrame:
    """Drop rows whose label is one of the collective labels (multi-brand, unknown and the like)."""
    names = labels_df.select(norm_key(F.col(label_col)).alias("_label")).distinct()
    return df.join(names, norm_key(df[col]) == names["_label"], "left_anti")


def valid_brand_filter(df: DataFrame, brand: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a brand, rows without). The second part goes to quarantine."""
    return df.filter(F.col(brand).isNotNull()), df.filter(F.col(brand).isNull())


def null_to_zero(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    return df.withColumns({m: F.coalesce(F.col(m), F.lit(0).cast(df.schema[m].dataType)) for m in measures})


# --- column contracts --------------------------------------------------------------------------


def select_contract_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*columns)


def align_schema(
    df: DataFrame, schema: Mapping[str, str], defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Exactly the columns of ``schema`` (name -> type): absent ones NULL, then defaults for NULLs."""
    defaults = defaults or {}

    def column(name: str, dtype: str) -> Column:
        col = F.col(name).cast(dtype) if name in df.columns else null_column(dtype)
        return F.coalesce(col, F.lit(defaults[name]).cast(dtype)) if name in defaults else col

    return df.select(*[column(n, t).alias(n) for n, t in schema.items()])


# --- quarantine --------------------------------------------------------------------------------


def quarantine(df: DataFrame, source: str, reason: str, run_at: str | None = None) -> DataFrame:
    """Rejected rows with source, reason and time."""
    at = F.current_timestamp() if run_at is None else F.lit(run_at).cast("timestamp")
    return df.select(
        "*",
        F.lit(source).alias("_quarantine_source"),
        F.lit(reason).alias("_quarantine_reason"),
        at.alias("_quarantine_ts"),
    )


def union_by_name_missing(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames with unlike columns; a column a frame lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_tagged_sources(frames: Mapping[str, DataFrame], columns: Sequence[str], tag: str) -> DataFrame:
    """Union of the common columns of several sources, each row tagged with its source."""
    parts = [
        df.select(*[c for c in columns if c in df.columns], F.lit(name).alias(tag)) for name, df in frames.items()
    ]
    return union_by_name_missing(parts).select(*columns, tag)


# --- labels ------------------------------------------------------------------------------------


def brand_std(df: DataFrame, col: str, crosswalk: DataFrame, out: str = "marca_std") -> DataFrame:
    """Canonical brand of a raw label, or the normalized label when the crosswalk lacks it.

    A variant listed under several canonical names goes to the one with the lowest priority.
    """
    best = (
        crosswalk.groupBy(norm_key(F.col("variant")).alias("_variant"))
        .agg(F.min_by("canonical", F.struct("priority", "canonical")).alias("_canonical"))
    )
    joined = df.join(best, norm_key(df[col]) == best["_variant"], "left")
    return joined.withColumn(out, F.coalesce("_canonical", norm_key(F.col(col)))).drop("_variant", "_canonical")


def channel_columns(df: DataFrame, raw: str) -> DataFrame:
    """Standard channel, its group and its business route from a raw channel."""
    channel = labels.channel_std(F.col(raw))
    return df.withColumns(
        {
            "channel_standard": channel,
            "gran_canal_grp": labels.channel_group(channel),
            "business_route": labels.business_route(channel),
        }
    )


def channel_hierarchy_apply(df: DataFrame, seed: DataFrame, source: str, col: str) -> DataFrame:
    """Join the confirmed rows that a channel seed holds for one source. Seed values repeat across
    sources, so the seed is cut to the source before it must be unique."""
    levels = ["gran_canal_grp", "channel_standard", "chain_standard", "format_standard"]
    chosen = seed.filter(
        (norm_key(F.col("source_system")) == source) & (norm_key(F.col("mapping_status")) == "CONFIRMED")
    ).select("source_value", *[norm_key(F.col(c)).alias(c) for c in levels])
    return mapping_left_join(df, chosen, col, "source_value", levels)


def market_label_columns(df: DataFrame, col: str) -> DataFrame:
    return df.withColumns(labels.market_label_classify(F.col(col)))


def ordered_case(
    df: DataFrame,
    rules: Sequence[tuple[Mapping[str, Sequence[str]] | str | Column, str | Column]],
    out: str,
    otherwise: Column | None = None,
) -> DataFrame:
    """First matching rule of a rule list gives the label.

    A rule is (condition, label). The condition is {column: allowed values}, which holds when every
    column has one of its values; or a SQL condition or column expression, with AND, OR, NOT, LIKE,
    BETWEEN and IS NULL as Spark reads them. The label is a text or a column. Segment definitions are
    configuration: a chain of layers is a chain of calls.
    """
    expr = None
    for condition, label in rules:
        if isinstance(condition, Mapping):
            hit = reduce(lambda a, b: a & b, [norm_key(F.col(c)).isin([v.upper() for v in vs]) for c, vs in condition.items()])
        else:
            hit = F.expr(condition) if isinstance(condition, str) else condition
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    if expr is None:
        raise ValueError("the rule list is empty")
    return df.withColumn(out, expr.otherwise(otherwise if otherwise is not None else null_column()))


def controlled_label_branch(
    long: DataFrame, level: int, label_level: int, label_filter: Column, fixed: Mapping[str, str]
) -> DataFrame:
    """Rows of one hierarchy level, plus private-label rows of another level under fixed labels."""
    normal = hierarchy_level_filter(long, level)
    special = hierarchy_level_filter(long, label_level).filter(label_filter)
    return normal.unionByName(special.withColumns({c: F.lit(v) for c, v in fixed.items()}))


# --- sources -----------------------------------------------------------------------------------


def waste_std(waste: DataFrame, flag: str = "TOPLINE") -> DataFrame:
    """Waste rows of one reporting source with standard channel columns. Zero rows stay, because
    averages count them."""
    text = {f"{c}_raw": norm_key(F.col(c)) for c in ("cadena", "formato", "canal")}
    kept = source_flag_filter(waste, "fuente", flag)
    kept = kept.withColumns({**text, "fuente": norm_key(F.col("fuente"))})
    kept = null_to_zero(kept, ["waste_amount", "waste_kg"])
    return channel_columns(kept, "canal_raw").withColumn("source_system", F.lit("WASTE"))


def fact_waste(waste: DataFrame, dim_channel: DataFrame) -> DataFrame:
    """Waste rows with the surrogate key of their channel; unmatched rows keep a NULL key.

    The dimension is unique on more columns than a waste row has; of several matches the smallest
    key is taken, so that a waste row stays one row."""
    keys = {
        "source_system": "source_system",
        "canal_raw": "source_value",
        "gran_canal_grp": "gran_canal_grp",
        "channel_standard": "channel_standard",
        "business_route": "business_route",
    }
    dim = dim_channel.groupBy(*[F.col(d).alias(f"_dim_{d}") for d in keys.values()]).agg(F.min("channel_key").alias("channel_key"))
    on = reduce(lambda a, b: a & b, [waste[w] == dim[f"_dim_{d}"] for w, d in keys.items()])
    return waste.join(dim, on, "left").drop(*[c for c in dim.columns if c != "channel_key"])


def dim_channel(seed: DataFrame) -> DataFrame:
    """Confirmed channel rows inside the closed vocabularies, keyed by md5 over seven columns."""
    keys = [
        "source_system", "source_column", "source_value", "gran_canal_grp", "channel_standard",
        "chain_standard", "format_standard",
    ]
    clean = seed.withColumns({c: norm_key(F.col(c)) for c in [*keys, "business_route", "mapping_status"]})
    return clean.filter(
        (F.col("mapping_status") == "CONFIRMED")
        & F.col("gran_canal_grp").isin(*labels.CHANNEL_GROUPS)
        & F.col("channel_standard").isin(*labels.CHANNELS)
    ).select(surrogate_key(*[F.col(k) for k in keys]).alias("channel_key"), *keys, "business_route", "notes")


CHANNEL_SEED_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "source_system", "source_column", "source_value", "gran_canal_grp", "channel_standard",
            "chain_standard", "format_standard", "business_route", "mapping_status", "notes",
        )
    ]
)


def sum_by(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str], rows: str = "fact_row_count") -> DataFrame:
    """Sums with NULL as zero plus a row count; the shape of every standardized source."""
    sums = [F.sum(zero_if_null(F.col(src))).alias(out) for out, src in measures.items()]
    return df.groupBy(*keys).agg(*sums, F.count("*").alias(rows))


def media_std(
    media: DataFrame, crosswalk: DataFrame, keys: Sequence[str], measures: Sequence[str], source: str
) -> DataFrame:
    """Media rows summed by day and campaign attributes, with canonical brand.

    The canonical brand depends on the raw label alone, so rows are summed by raw label first and
    the crosswalk sees the small result.
    """
    summed = sum_by(media, [*keys, "marca"], {m: m for m in measures})
    branded = brand_std(summed, "marca", crosswalk)
    return branded.withColumns({"source_system": F.lit(source), "canal_std": F.col("medio")})


def split_list(df: DataFrame, col: str, value: str, index: str = "index", sep: str = ",") -> DataFrame:
    """One row per element of a separated text, with its position; line breaks are dropped."""
    clean = F.translate(F.col(col), "\r\n", "")
    return df.select("*", F.posexplode(F.split(clean, sep)).alias(index, value))
