"""Column expressions for KPI rules. Everything stays a built-in Spark expression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_column(dtype: str = "string") -> Column:
    """A typed NULL, for columns a source does not carry by design."""
    return F.lit(None).cast(dtype)


# --- keys, text, dates -------------------------------------------------------------------------


def norm_key(col: Column) -> Column:
    """Join keys are compared upper-case and trimmed on both sides."""
    return F.upper(F.trim(col))


def surrogate_key(*cols: Column, null_text: str = "None", length: int = 16) -> Column:
    """First hex characters of md5 over the parts joined with '|'; a NULL part becomes a text."""
    parts = [F.coalesce(c.cast("string"), F.lit(null_text)) for c in cols]
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, length)


def month_trunc(col: Column) -> Column:
    return F.trunc(col, "MM").cast("date")


def date_from_int(col: Column) -> Column:
    """20250131 or 202501 as number or text -> date; anything else -> NULL."""
    text = col.cast("string")
    return (
        F.when(F.length(text) == 8, F.try_to_timestamp(text, F.lit("yyyyMMdd")))
        .when(F.length(text) == 6, F.try_to_timestamp(text, F.lit("yyyyMM")))
        .cast("date")
    )


def boundary_weeks(later: Column, earlier: Column) -> Column:
    """Number of Monday boundaries between two dates."""
    week = lambda c: F.trunc(c, "week")
    return F.floor(F.datediff(week(later), week(earlier)) / 7).cast("int")


# --- guarded arithmetic ------------------------------------------------------------------------


def safe_divide(num: Column, den: Column, zero_result: float | None = None) -> Column:
    """num / den, or ``zero_result`` when the denominator is NULL or 0."""
    return F.when(den.isNull() | (den == 0), F.lit(zero_result)).otherwise(num / den)


def clamp(col: Column, low: float, high: float) -> Column:
    """Keep a value in [low, high]; NULL stays NULL."""
    return F.when(col.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), col)))


def stable_round(col: Column, digits: int) -> Column:
    """Round for comparison with another engine: halves are nudged up, as engines differ on them."""
    return F.round(col + 1e-7, digits)


def round_score(col: Column, digits: int = 1) -> Column:
    """Round a score. Float noise goes first, so that it cannot tip a half."""
    return F.round(F.round(col, 9), digits)


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


# --- KPI rules ---------------------------------------------------------------------------------


def coverage_level(stores: Column, high: int = 50, medium: int = 20) -> Column:
    """Distribution coverage from a store count."""
    return F.when(stores >= high, "HIGH").when(stores >= medium, "MEDIUM").otherwise("LOW")


def coverage_level_ratio(ratio: Column, low: float = 0.70, medium: float = 0.85) -> Column:
    """Coverage from the share of expected stores that reported."""
    return F.when(ratio < low, "LOW").when(ratio < medium, "MEDIUM").otherwise("HIGH")


def inventory_days(inventory: Column, monthly_units: Column, days: int = 30) -> Column:
    return safe_divide(inventory * days, monthly_units)


def waste_rate(waste: Column, sell_in: Column) -> dict[str, Column]:
    """Waste over sell-in with the reason a value is missing or suspicious."""
    rate = safe_divide(waste, sell_in)
    anomaly = F.coalesce(rate > 1.0, F.lit(False))
    reason = (
        F.when(sell_in == 0, "SELL_IN_ZERO")
        .when(sell_in.isNull(), "SELL_IN_NULL")
        .when(waste.isNull(), "WASTE_NULL")
        .when(anomaly, "WASTE_EXCEEDS_SELL_IN")
    )
    return {"waste_rate": rate, "is_anomaly": anomaly, "anomaly_reason": reason}


def sell_ratio(sell_out: Column, sell_in: Column) -> dict[str, Column]:
    """Sell-out over sell-in; above 1 stock was drawn down, above 1.5 needs a look."""
    ratio = safe_divide(sell_out, sell_in)
    flag = (
        F.when(sell_in.isNull() | (sell_in == 0), "SELL_IN_ZERO")
        .when(sell_out.isNull(), "SELL_OUT_NULL")
        .when(ratio > 1.5, "RATIO_EXCEEDS_1_5")
        .when(ratio > 1.0, "RATIO_ABOVE_1_PRIOR_INVENTORY")
    )
    return {"ratio": ratio, "is_valid": ratio.isNotNull(), "flag": flag}


def waste_adjusted_roi(revenue: Column, waste_cost: Column, spend: Column) -> Column:
    return safe_divide(revenue - waste_cost, spend)


def roi_flag(revenue: Column, waste_cost: Column, spend: Column) -> Column:
    return (
        F.when(spend.isNull() | (spend == 0), "UNSPONSORED")
        .when(waste_cost > revenue, "CATASTROPHIC_LOSS")
        .otherwise("OK")
    )


def market_adjusted_growth(brand_growth: Column, category_growth: Column) -> Column:
    return brand_growth - category_growth


def waste_risk_bucket(score: Column, medium: float = 0.30, high: float = 0.70) -> Column:
    return (
        F.when(score.isNull(), null_column())
        .when(score < medium, "LOW")
        .when(score < high, "MEDIUM")
        .otherwise("HIGH")
    )


def hill_response(x: Column, half_saturation: Column, alpha: Column) -> Column:
    """x^a / (K^a + x^a): zero at zero, one half at K."""
    powered = F.pow(x, alpha)
    return safe_divide(powered, F.pow(half_saturation, alpha) + powered)


def scenario_label(tag: Column) -> Column:
    """Planning rows carry a tag that tells actuals, plan and rolling forecasts apart."""
    text = norm_key(tag)
    return (
        F.when(text == "REAL", "ACTUAL")
        .when(text == "IBP", "IBP_FORECAST")
        .when(text.startswith("M"), "ROLLING_FORECAST")
        .otherwise("OTHER")
    )


# Kilograms per reported volume unit, by business unit.
KG_PER_VOLUME_UNIT = {"WATERS": 1.0, "EDP": 1000.0}


def volume_to_kg(
    unit: Column, volume: Column, factors: Mapping[str, float] = KG_PER_VOLUME_UNIT
) -> Column:
    """Volume in kilograms; a unit without a factor gives NULL instead of a wrong number."""
    return lookup(norm_key(unit), factors) * volume


# Litres or kilograms per unit of size, by business unit.
SIZE_FACTORS = {"WATERS": 1.0, "EDP": 0.1}


def volume_by_unit_factor(
    unit: Column, pieces: Column, size: Column, factors: Mapping[str, float] = SIZE_FACTORS
) -> Column:
    """Pieces times size times the factor of the business unit; a unit without a factor gives NULL."""
    return pieces * size * lookup(norm_key(unit), factors)


def lookup(key: Column, table: Mapping[str, object]) -> Column:
    """Value of a small fixed mapping as an expression, NULL when the key is absent."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def chain_or_format(chain: Column, fmt: Column, by_format: str) -> Column:
    """Use the store format as chain for the one retailer that is reported by format."""
    return F.when(norm_key(chain) == by_format.upper().strip(), fmt).otherwise(chain)


def growth_band(growth: Column, amber_from: float = -5.0) -> Column:
    return F.when(growth > 0, "GREEN").when(growth >= amber_from, "AMBER").when(growth < amber_from, "RED")


def waste_band(rate: Column, threshold: float) -> Column:
    return (
        F.when(rate < threshold, "GREEN").when(rate <= 2 * threshold, "AMBER").when(rate > 2 * threshold, "RED")
    )


def data_confidence(sell_in: Column, sell_out: Column, spend: Column, market: Column) -> Column:
    """HIGH with all four sources, MEDIUM with sell-out, else LOW. Arguments are booleans."""
    return F.when(sell_in & sell_out & spend & market, "HIGH").when(sell_out, "MEDIUM").otherwise("LOW")


def owner_type(
    brand: Column, own_brands: Sequence[str], own: str = "OWN", other: str = "COMPETITOR"
) -> Column:
    """Own brand or competitor. An empty list would silently drop every row later, so it fails."""
    if not own_brands:
        raise ValueError("the list of own brands is empty")
    names = sorted({b.strip().upper() for b in own_brands})
    return F.when(norm_key(brand).isin(names), own).otherwise(other)


# --- composite scores --------------------------------------------------------------------------

# Weights of the two composite scores.
GROWTH_WEIGHTS = {
    "so_growth": 0.25,
    "share": 0.25,
    "waste": 0.20,
    "forecast": 0.15,
    "roi": 0.15,
}
RISK_WEIGHTS = {
    "share_loss": 0.30,
    "price_gap": 0.25,
    "num_dist": 0.20,
    "wgt_dist": 0.15,
    "share_yoy": 0.10,
}


def weighted_score(parts: Mapping[str, Column], weights: Mapping[str, float], max_missing: int = 2) -> tuple[Column, Column]:
    """(score 0-100 rounded to 1 decimal, number of missing parts).

    The weight of a missing part goes to the others in proportion to their weights. More than
    ``max_missing`` missing parts give no score.
    """
    missing = sum((parts[k].isNull().cast("int") for k in weights), F.lit(0))
    total = sum((F.coalesce(parts[k] * w, F.lit(0.0)) for k, w in weights.items()), F.lit(0.0))
    weight = sum((F.when(parts[k].isNotNull(), F.lit(w)).otherwise(0.0) for k, w in weights.items()), F.lit(0.0))
    score = F.when(missing <= max_missing, round_score(clamp(total / weight, 0.0, 100.0)))
    return score, missing


def growth_quality_score(
    parts: Mapping[str, Column], weights: Mapping[str, float] = GROWTH_WEIGHTS
) -> dict[str, Column]:
    score, missing = weighted_score(parts, weights)
    confidence = (
        F.when(missing == 0, "HIGH").when(missing == 1, "MEDIUM").when(missing == 2, "LOW").otherwise("NULL")
    )
    return {"score": score, "confidence": confidence, "null_component_count": missing}


def competitive_risk_score(
    parts: Mapping[str, Column],
    brands_in_category: Column | None = None,
    weights: Mapping[str, float] = RISK_WEIGHTS,
) -> dict[str, Column]:
    score, missing = weighted_score(parts, weights)
    confidence = (
        F.when(missing == 0, "FULL").when(missing == 1, "PARTIAL").when(missing == 2, "LOW").otherwise("NULL")
    )
    if brands_in_category is not None:
        alone = brands_in_category <= 1
        score = F.when(~alone, score)
        confidence = F.when(alone, "NO_COMPETITIVE_CONTEXT").otherwise(confidence)
    return {"score": score, "confidence": confidence, "null_component_count": missing}


def scale_rising(col: Column, low: float, high: float) -> Column:
    """0 at ``low``, 100 at ``high``, clamped."""
    return clamp((col - low) / (high - low) * 100.0, 0.0, 100.0)


def scale_falling(col: Column, low: float, high: float) -> Column:
    """100 at ``low``, 0 at ``high``, clamped."""
    return clamp((high - col) / (high - low) * 100.0, 0.0, 100.0)


def growth_components(
    growth_pct: Column,
    share_change_pp: Column,
    waste_rate_pct: Column,
    wape: Column,
    roi: Column,
    waste_threshold_pct: float = 5.0,
    growth_range_pct: float = 20.0,
) -> dict[str, Column]:
    """The five 0-100 inputs of the growth quality score."""
    return {
        "so_growth": scale_rising(growth_pct, -growth_range_pct, growth_range_pct),
        "share": scale_rising(share_change_pp, -3.0, 3.0),
        "waste": clamp(100.0 - waste_rate_pct / waste_threshold_pct * 100.0, 0.0, 100.0),
        "forecast": clamp((1.0 - wape) * 100.0, 0.0, 100.0),
        "roi": scale_rising(roi, 0.0, 3.0),
    }


def risk_components(
    share_change: Column,
    price_change_pct: Column,
    num_dist_change: Column,
    wgt_dist_change: Column,
    share_yoy: Column,
    share_range: float = 3.0,
    dist_range: float = 10.0,
) -> dict[str, Column]:
    """The five 0-100 inputs of the competitive risk score; 100 is the highest risk."""
    return {
        "share_loss": scale_falling(share_change, -share_range, share_range),
        "price_gap": scale_rising(price_change_pct, -20.0, 20.0),
        "num_dist": scale_falling(num_dist_change, -dist_range, dist_range),
        "wgt_dist": scale_falling(wgt_dist_change, -dist_range, dist_range),
        "share_yoy": scale_falling(share_yoy, -5.0, 5.0),
    }
