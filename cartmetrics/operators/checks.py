"""Data-quality checks. All checks of a table share one pass over it.

A check is a named metric with a limit. ``run_checks`` puts the metrics of all checks of a table
into one aggregate and turns the single result row into check rows
(check_id, table_name, metric, threshold, status); ``quality_gate`` turns check rows into a verdict.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartmetrics.functions.scalars import boundary_weeks, safe_divide

BLOCKER, WARNING, PASS = "BLOCKER", "WARNING", "PASS"
CHECK_COLUMNS = ["check_id", "table_name", "metric", "threshold", "status"]


@dataclass(frozen=True)
class Check:
    """``metric`` fails when it is above (``above``), below (``below``) or equal to the threshold."""

    check_id: str
    metric: Column
    threshold: float = 0.0
    fails: str = "above"
    severity: str = BLOCKER

    def warn(self) -> Check:
        return replace(self, severity=WARNING)


def status_of(metric: Column, threshold: Column, fails: str, severity: str) -> Column:
    failed = {"above": metric > threshold, "below": metric < threshold, "equal": metric == threshold}[fails]
    return F.when(F.coalesce(failed, F.lit(False)), severity).otherwise(PASS)


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One aggregate over the table, one row per check."""
    wide = df.agg(*[c.metric.cast("double").alias(f"m{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(c.check_id).alias("check_id"),
            F.lit(table).alias("table_name"),
            F.coalesce(F.col(f"m{i}"), F.lit(0.0)).alias("metric"),
            F.lit(float(c.threshold)).alias("threshold"),
            status_of(F.coalesce(F.col(f"m{i}"), F.lit(0.0)), F.lit(float(c.threshold)), c.fails, c.severity).alias("status"),
        )
        for i, c in enumerate(checks)
    ]
    return wide.select(F.inline(F.array(*rows)))


# --- checks of one table -----------------------------------------------------------------------


def check_not_empty() -> Check:
    return Check("B1_not_empty", F.count("*"), 1, "below")


def check_null_key(col: str, check_id: str = "B2_null_key") -> Check:
    return Check(f"{check_id}:{col}", F.count_if(F.col(col).isNull()))


def check_no_inf_nan(col: str) -> Check:
    value = F.col(col).cast("double")
    bad = F.isnan(value) | value.isin(float("inf"), float("-inf"))
    return Check(f"B4_inf_nan:{col}", F.count_if(bad))


def check_unique_keys(keys: Sequence[str]) -> Check:
    """Rows beyond one per key. NULLs in a key count as a value."""
    return Check(f"B10_unique:{','.join(keys)}", F.count("*") - F.count_distinct(F.struct(*keys)))


def check_month_range(col: str, start: str, end: str | None = None) -> list[Check]:
    """Months inside [start, end] and on the first day; no end means open."""
    month = F.col(col)
    outside = month < F.lit(start).cast("date")
    if end:
        outside = outside | (month > F.lit(end).cast("date"))
    return [
        Check(f"B11_month_range:{col}", F.count_if(outside)),
        Check(f"B13_first_of_month:{col}", F.count_if(F.dayofmonth(month) != 1)),
    ]


def check_month_coverage(col: str, minimum: int = 12) -> Check:
    return Check(f"W1_month_coverage:{col}", F.count_distinct(col), minimum, "below", WARNING)


def check_negative(col: str, check_id: str = "W2_negative") -> Check:
    return Check(f"{check_id}:{col}", F.count_if(F.col(col) < 0), severity=WARNING)


def check_structural_null(col: str) -> Check:
    """A column that must be NULL throughout by design."""
    return Check(f"A4_structural_null:{col}", F.count(col))


def check_no_fuzzy(col: str = "match_method") -> Check:
    return Check("A7_no_fuzzy", F.count_if(F.lower(F.col(col)).contains("fuzzy")))


def check_expected_rows(expected: int) -> Check:
    return Check("A8_expected_rows", F.abs(F.count("*") - F.lit(expected)))


def homologation_validate(converted: str, raw: str) -> Check:
    """A conversion must not lose a value that the raw column has."""
    return Check(f"H1_lost:{converted}", F.count_if(F.col(converted).isNull() & F.col(raw).isNotNull()))


def check_closed_vocabulary(col: str, allowed: Sequence[str]) -> Check:
    outside = F.col(col).isNotNull() & ~F.col(col).isin(*allowed)
    return Check(f"V1_vocabulary:{col}", F.count_if(outside))


# --- checks over groups and pairs of tables ----------------------------------------------------


def _check_row(df: DataFrame, check_id: str, table: str, metric: Column, threshold: float, fails: str, severity: str) -> DataFrame:
    metric = metric.cast("double")
    limit = F.lit(float(threshold))
    return df.select(
        F.lit(check_id).alias("check_id"),
        F.lit(table).alias("table_name"),
        metric.alias("metric"),
        limit.alias("threshold"),
        status_of(metric, limit, fails, severity).alias("status"),
    )


def values_outside_vocabulary(df: DataFrame, col: str, vocabulary: DataFrame, allowed: str, rows: str | None = None) -> DataFrame:
    """Values outside an allowed list that is itself a table, with their row counts; ``rows`` names a column of counts
    where df is already added up."""
    number = F.count("*") if rows is None else F.sum(rows)
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(number.alias("n_rows"))
    return counts.join(vocabulary.select(F.col(allowed).alias("value")), "value", "left_anti")


def check_one_to_one(df: DataFrame, key: str, partner: str, table: str) -> DataFrame:
    """Number of keys with more than one partner.

    Distinct pairs are counted per key instead of collected, so a hot key stays small.
    """
    pairs = df.filter(F.col(key).isNotNull() & F.col(partner).isNotNull()).select(key, partner).distinct()
    per_key = pairs.groupBy(key).agg(F.count("*").alias("_n"))
    bad = per_key.agg(F.count_if(F.col("_n") > 1).alias("_bad"))
    return _check_row(bad, f"A5_one_to_one:{key}->{partner}", table, F.col("_bad"), 0, "above", BLOCKER)


def _two_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    rows_after = after.agg(F.count("*")).scalar()
    return before.agg(F.count("*").alias("n_before")).withColumn("n_after", rows_after)


def check_no_fanout(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """A join must not add rows."""
    grown = F.col("n_after") - F.col("n_before")
    return _check_row(_two_counts(before, after), "B8_no_fanout", label, grown, 0, "above", BLOCKER)


def check_row_count_exact(before: DataFrame, after: DataFrame, label: str, documented_filter: str | None = None) -> DataFrame:
    """A left join keeps the row count. More rows block; fewer block too unless a filter explains
    them. The metric is rows after minus rows before."""
    diff = F.col("n_after") - F.col("n_before")
    fewer = WARNING if documented_filter else BLOCKER
    return _two_counts(before, after).select(
        F.lit("R15_row_count").alias("check_id"),
        F.lit(label).alias("table_name"),
        diff.cast("double").alias("metric"),
        F.lit(0.0).alias("threshold"),
        F.when(diff == 0, PASS).when(diff > 0, BLOCKER).otherwise(fewer).alias("status"),
    )


def check_null_accounted(df: DataFrame, quarantined: DataFrame, key: str, row_id: Sequence[str], table: str) -> DataFrame:
    """Rows with a NULL key must be in quarantine, found by their row id."""
    missing = df.filter(F.col(key).isNull()).join(quarantined.select(*row_id).distinct(), list(row_id), "left_anti")
    lost = missing.agg(F.count("*").alias("_lost"))
    return _check_row(lost, f"A9_null_accounted:{key}", table, F.col("_lost"), 0, "above", BLOCKER)


def join_key_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str, max_unmatched_pct: float = 20.0) -> DataFrame:
    """Share of distinct left keys that the right side has."""
    keys = left.select(F.col(left_key).alias("_k")).filter(F.col("_k").isNotNull()).distinct()
    other = right.select(F.col(right_key).alias("_r")).filter(F.col("_r").isNotNull()).distinct()
    found = keys.join(other, F.col("_k") == F.col("_r"), "left")
    out = found.agg(F.count("*").alias("left_keys"), F.count("_r").alias("matched_keys"))
    unmatched = safe_divide((F.col("left_keys") - F.col("matched_keys")) * 100.0, F.col("left_keys"), 0.0)
    return out.withColumns(
        {"unmatched_pct": unmatched, "status": F.when(unmatched > max_unmatched_pct, "FAIL").otherwise("PASS")}
    )


# --- reports over many columns -----------------------------------------------------------------


def _per_column(df: DataFrame, columns: Sequence[str], metric: str, expr) -> DataFrame:
    """(column_name, total_rows, metric) rows from one aggregate."""
    wide = df.agg(F.count("*").alias("_rows"), *[expr(c).alias(f"_{i}") for i, c in enumerate(columns)])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("total_rows"), F.col(f"_{i}").alias(metric))
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def null_rate_report(df: DataFrame, columns: Sequence[str], warn_pct: float = 1.0, high_pct: float = 5.0) -> DataFrame:
    out = _per_column(df, columns, "null_rows", lambda c: F.count_if(F.col(c).isNull()))
    pct = safe_divide(F.col("null_rows") * 100.0, F.col("total_rows"), 0.0)
    flag = F.when(pct > high_pct, "HIGH").when(pct > warn_pct, "WARN").otherwise("OK")
    return out.withColumns({"null_pct": pct, "null_flag": flag})


def coverage_report(df: DataFrame, thresholds: Mapping[str, float], exempt: Sequence[str] = ()) -> DataFrame:
    """Mapped share per column against its threshold; columns that are NULL by design are exempt."""
    out = _per_column(df, list(thresholds), "mapped_rows", lambda c: F.count(c))
    pct = safe_divide(F.col("mapped_rows") * 100.0, F.col("total_rows"), 0.0)
    limit = reduce(lambda e, kv: e.when(F.col("column_name") == kv[0], float(kv[1])), thresholds.items(), F)
    status = F.when(F.col("column_name").isin(*exempt), "EXEMPT") if exempt else F.when(F.lit(False), "EXEMPT")
    return out.withColumns(
        {"coverage_pct": pct, "threshold_pct": limit, "status": status.when(pct < limit, WARNING).otherwise(PASS)}
    )


# --- rule catalog ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """One data-quality rule: ``kind`` is mandatory, allowed_values, value_range, unique or pattern."""

    column: str
    kind: str
    argument: object = None
    severity: str = "MEDIUM"

    def violations(self) -> Column:
        col = F.col(self.column)
        if self.kind == "mandatory":
            return F.count_if(col.isNull())
        if self.kind == "allowed_values":
            return F.count_if(col.isNotNull() & ~col.isin(*self.argument))
        if self.kind == "value_range":
            low, high = self.argument
            below = F.lit(False) if low is None else col < low
            above = F.lit(False) if high is None else col > high
            return F.count_if(below | above)
        if self.kind == "pattern":
            return F.count_if(col.isNotNull() & ~col.rlike(self.argument))
        raise ValueError(f"unknown rule kind {self.kind!r}")


# Points a failed rule costs.
SEVERITY_POINTS = {"CRITICAL": 15, "HIGH": 8, "MEDIUM": 3, "LOW": 0}


def dq_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rules of a table in one aggregate; a unique rule adds one that reads its column alone, as several distinct
    counts in one aggregate would copy every row once per rule. Rules on absent columns fail with NULL violations."""
    present = [r for r in rules if r.column in df.columns]
    simple = [r.violations().alias(f"_{i}") for i, r in enumerate(present) if r.kind != "unique"]
    wide = df.agg(F.count("*").alias("_rows"), *simple)
    # NULL counts as a value of its own
    values = lambda c: df.groupBy(c).agg(F.lit(1)).agg(F.count("*")).scalar()
    wide = wide.withColumns({f"_{i}": F.col("_rows") - values(r.column) for i, r in enumerate(present) if r.kind == "unique"})
    position = {id(r): i for i, r in enumerate(present)}
    rows = [
        F.struct(
            F.lit(r.column).alias("column_name"),
            F.lit(r.kind).alias("rule_type"),
            F.lit(r.severity).alias("severity"),
            (F.col(f"_{position[id(r)]}") if id(r) in position else F.lit(None)).cast("long").alias("violations"),
        )
        for r in rules
    ]
    out = wide.select(F.inline(F.array(*rows)))
    return out.withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))


def dq_severity_score(results: DataFrame) -> DataFrame:
    """100 minus the points of the failed rules."""
    points = reduce(lambda e, kv: e.when(F.col("severity") == kv[0], kv[1]), SEVERITY_POINTS.items(), F).otherwise(0)
    lost = F.sum(F.when(F.col("status") == "FAIL", points).otherwise(0))
    return results.agg(
        F.count("*").alias("n_rules"),
        F.count_if(F.col("status") == "FAIL").alias("n_failed"),
        F.coalesce(lost, F.lit(0)).alias("points_lost"),
        F.greatest(F.lit(0), F.lit(100) - F.coalesce(lost, F.lit(0))).alias("dq_score"),
    )


def market_panel_thresholds(
    df: DataFrame, table: str, brand: str, month: str, value: str, limits: Mapping[str, float]
) -> DataFrame:
    """Plausibility of a market panel: brands, months, rows, missing brands and total value.

    The panel is rolled up to brand and month first; the sets of brands and months are read off that small frame.
    """
    rolled = df.groupBy(F.col(brand).alias("_brand"), F.col(month).alias("_month")).agg(F.count("*").alias("_n"), F.sum(value).alias("_value"))
    missing = F.sum(F.when(F.col("_brand").isNull(), F.col("_n")).otherwise(0))
    return run_checks(
        rolled,
        table,
        [
            Check("min_brands", F.size(F.collect_set("_brand")), limits["min_brands"], "below"),
            Check("min_distinct_months", F.size(F.collect_set("_month")), limits["min_distinct_months"], "below"),
            Check("min_rows", F.sum("_n"), limits["min_rows"], "below"),
            Check("max_null_brand_pct", safe_divide(missing * 100.0, F.sum("_n"), 0.0), limits["max_null_brand_pct"], "above"),
            Check("min_value", F.sum("_value"), limits["min_value"], "below"),
        ],
    )


def threshold_assertions(metrics: DataFrame) -> DataFrame:
    """Rows (name, value, comparison, threshold, override) -> status.

    GT, EQ and LT name the comparison that blocks, WARN warns above the threshold; an override wins.
    """
    value, limit, how = F.col("value"), F.col("threshold"), F.col("comparison")
    blocks = ((how == "GT") & (value > limit)) | ((how == "EQ") & (value == limit)) | ((how == "LT") & (value < limit))
    status = F.when(blocks, BLOCKER).when((how == "WARN") & (value > limit), WARNING).otherwise(PASS)
    return metrics.withColumn("status", F.coalesce("override", status))


# The columns of the check log.
LOG_COLUMNS = (
    "check_timestamp", "pipeline_layer", "source_table", "check_name", "check_type", "check_result", "actual_value",
    "threshold_value", "row_count", "batch_id", "error_message",
)
#: Kind of a check by the beginning of its id; others are VALUE_RANGE.
CHECK_TYPES = {
    "B2": "NULL_RATE", "A4": "NULL_RATE", "A9": "NULL_RATE", "max_null": "NULL_RATE", "B1_": "ROW_COUNT", "R15": "ROW_COUNT",
    "A8": "ROW_COUNT", "B8": "ROW_COUNT", "min_rows": "ROW_COUNT", "B10": "REFERENTIAL", "A5": "REFERENTIAL", "V1": "REFERENTIAL",
    "M12": "REFERENTIAL", "H1": "REFERENTIAL",
}


def check_log(results: DataFrame, layer: str, run_id: str, rows: Mapping[str, int] | None = None, at: str | None = None) -> DataFrame:
    """Check rows in the form of the log: layer, kind, PASS / WARNING / ERROR, number of rows of the table (``rows`` by
    table, where it is known), run and time. A blocker is an ERROR, and what failed gets a message."""
    kind = reduce(lambda e, kv: e.when(F.col("check_id").startswith(kv[0]), kv[1]), CHECK_TYPES.items(), F).otherwise("VALUE_RANGE")
    result = F.when(F.col("status") == BLOCKER, "ERROR").otherwise(F.col("status"))
    message = F.when(
        F.col("status") != PASS,
        F.format_string("%s of %s: %s against %s", "check_id", "table_name", F.col("metric").cast("string"), F.col("threshold").cast("string")),
    )
    known = reduce(lambda e, kv: e.when(F.col("table_name") == kv[0], F.lit(kv[1])), (rows or {}).items(), F.when(F.lit(False), F.lit(0)))
    return results.select(
        (F.current_timestamp() if at is None else F.lit(at).cast("timestamp")).alias("check_timestamp"), F.lit(layer).alias("pipeline_layer"),
        F.col("table_name").alias("source_table"), F.col("check_id").alias("check_name"), kind.alias("check_type"),
        result.alias("check_result"), F.col("metric").alias("actual_value"), F.col("threshold").alias("threshold_value"),
        known.cast("long").alias("row_count"), F.lit(run_id).alias("batch_id"), message.alias("error_message"),
    ).select(*LOG_COLUMNS)


def quality_gate(results: DataFrame) -> DataFrame:
    """CLEAR, CLEAR WITH WARNINGS or BLOCKED, with the number of each finding."""
    blockers = F.count_if(F.col("status") == BLOCKER)
    warnings = F.count_if(F.col("status") == WARNING)
    gate = F.when(blockers > 0, "BLOCKED").when(warnings > 0, "CLEAR WITH WARNINGS").otherwise("CLEAR")
    return results.agg(
        F.count("*").alias("n_checks"), blockers.alias("n_blockers"), warnings.alias("n_warnings"), gate.alias("gate")
    )


def require_clear(gate: DataFrame) -> None:
    """Raise when the gate is blocked; the one place where a check result reaches the driver."""
    row = gate.first()
    if row["gate"] == "BLOCKED":
        raise RuntimeError(f"quality gate blocked: {row['n_blockers']} blockers")


# --- schema and freshness ----------------------------------------------------------------------


def schema_rows(df: DataFrame, table: str) -> list[tuple[str, str, str, bool]]:
    return [(table, f.name.lower(), f.dataType.simpleString(), f.nullable) for f in df.schema.fields]


def schema_drift(snapshot: DataFrame, current: DataFrame) -> DataFrame:
    """Columns added, dropped or changed between two (table_name, column_name, type, nullable) lists."""
    keys = ["table_name", "column_name"]
    old = snapshot.select(*keys, F.col("type").alias("old_type"), F.col("nullable").alias("old_nullable"))
    new = current.select(*keys, F.col("type").alias("new_type"), F.col("nullable").alias("new_nullable"))
    change = (
        F.when(F.col("old_type").isNull(), "ADDED")
        .when(F.col("new_type").isNull(), "DROPPED")
        .when(F.col("old_type") != F.col("new_type"), "TYPE_CHANGED")
        .when(F.col("old_nullable") != F.col("new_nullable"), "NULLABILITY_CHANGED")
    )
    return old.join(new, keys, "full").withColumn("change", change).filter(F.col("change").isNotNull())


def market_data_lag(internal: DataFrame, market: DataFrame, internal_date: str, market_date: str, limit_weeks: int = 6) -> DataFrame:
    """Calendar weeks the market data lies behind the internal data, and whether to warn."""
    one = internal.agg(F.max(F.col(internal_date)).cast("date").alias("internal_max_date"))
    one = one.withColumn("market_max_date", market.agg(F.max(F.col(market_date)).cast("date")).scalar())
    lag = boundary_weeks(F.col("internal_max_date"), F.col("market_max_date"))
    late = lag > limit_weeks
    message = F.when(
        late,
        F.concat(
            F.lit("Market data as of "), F.date_format("market_max_date", "yyyy-MM-dd"),
            F.lit(" ("), lag.cast("string"), F.lit(" weeks behind internal data)"),
        ),
    ).otherwise("Market data current")
    return one.withColumns(
        {"lag_weeks": lag, "lag_banner_required": late, "lag_banner_message": message}
    )


def prior_period_volume_check(
    df: DataFrame, date: str, minimum_ratio: float, warn_drop: float = 0.10, error_drop: float = 0.20
) -> DataFrame:
    """Rows per month against the month before: a drop above 10% warns, above 20% is an error.

    The window runs over months; the calendar bounds it.
    """
    counts = df.groupBy(F.trunc(date, "MM").alias("period")).agg(F.count("*").alias("n_rows"))
    counts = counts.filter(F.col("period").isNotNull())
    out = counts.withColumn("prior_rows", F.lag("n_rows").over(W.orderBy("period")))
    ratio = safe_divide(F.col("n_rows") * 1.0, F.col("prior_rows"))
    drop = F.lit(1.0) - ratio
    status = F.when(drop > error_drop, "ERROR").when(drop > warn_drop, WARNING).otherwise(PASS)
    return out.withColumns({"ratio": ratio, "below_minimum": F.coalesce(ratio < minimum_ratio, F.lit(False)), "status": status})


def row_count_probe(df: DataFrame, key: str, date: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct(key).alias("distinct_keys"),
        F.min(date).alias("min_date"),
        F.max(date).alias("max_date"),
    )
