"""Each check with a frame that passes and one that fails."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartmetrics.operators import checks, std
from cartmetrics.operators.checks import Check, Rule

D = dt.date


def status(df):
    return {r["check_id"].split(":")[0]: r["status"] for r in df.collect()}


@pytest.mark.parametrize(
    "check,schema,good,bad",
    [
        (lambda: checks.check_not_empty(), "a int", [(1,)], []),
        (lambda: checks.check_null_key("a"), "a int", [(1,)], [(None,)]),
        (lambda: checks.check_no_inf_nan("a"), "a double", [(1.0,), (None,)], [(float("nan"),)]),
        (lambda: checks.check_no_inf_nan("a"), "a double", [(1.0,)], [(float("-inf"),)]),
        (lambda: checks.check_unique_keys(["a", "b"]), "a int, b int", [(1, None), (1, 2)], [(1, None), (1, None)]),
        (lambda: checks.check_month_range("a", "2022-01-01")[0], "a date", [(D(2022, 1, 1),)], [(D(2021, 12, 1),)]),
        (lambda: checks.check_month_range("a", "2022-01-01", "2022-06-01")[0], "a date", [(D(2022, 6, 1),)], [(D(2022, 7, 1),)]),
        (lambda: checks.check_month_range("a", "2022-01-01")[1], "a date", [(D(2022, 1, 1),)], [(D(2022, 1, 2),)]),
        (lambda: checks.check_month_coverage("a", 2), "a int", [(1,), (2,)], [(1,), (1,)]),
        (lambda: checks.check_negative("a"), "a double", [(0.0,)], [(-0.1,)]),
        (lambda: checks.check_structural_null("a"), "a string", [(None,)], [("x",)]),
        (lambda: checks.check_no_fuzzy(), "match_method string", [("EXACT",), (None,)], [("Fuzzy_NAME",)]),
        (lambda: checks.check_expected_rows(2), "a int", [(1,), (2,)], [(1,)]),
        (lambda: checks.homologation_validate("kg", "raw"), "kg double, raw double", [(None, None), (1.0, 1.0)], [(None, 1.0)]),
        (lambda: checks.check_closed_vocabulary("a", ["x", "y"]), "a string", [("x",), (None,)], [("z",)]),
    ],
)
def test_single_table_checks(spark, check, schema, good, bad):
    check = check()
    passed = checks.run_checks(spark.createDataFrame(good, schema), "t", [check]).first()
    failed = checks.run_checks(spark.createDataFrame(bad, schema), "t", [check]).first()
    assert passed["status"] == "PASS" and failed["status"] == check.severity


def test_row_counts(spark):
    three, four, two = (spark.range(n) for n in (3, 4, 2))
    assert checks.check_row_count_exact(three, three, "x").first()["status"] == "PASS"
    assert checks.check_row_count_exact(three, four, "x").first()["status"] == "BLOCKER"
    assert checks.check_row_count_exact(three, two, "x").first()["status"] == "BLOCKER"
    assert checks.check_row_count_exact(three, two, "x", "filter").first()["status"] == "WARNING"
    assert checks.check_no_fanout(three, two, "x").first()["status"] == "PASS"
    assert checks.check_no_fanout(three, four, "x").first()["status"] == "BLOCKER"


def test_one_to_one_and_quarantine(spark):
    pairs = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", None)], "k string, p string")
    assert checks.check_one_to_one(pairs, "k", "p", "t").first()["status"] == "PASS"
    more = pairs.union(spark.createDataFrame([("a", "2")], "k string, p string"))
    assert checks.check_one_to_one(more, "k", "p", "t").first()["metric"] == 1.0
    rows = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "id int, k string")
    held = std.quarantine(rows.filter("k is null"), "S", "no key")
    assert checks.check_null_accounted(rows, held, "k", ["id"], "t").first()["status"] == "PASS"
    assert checks.check_null_accounted(rows, held.filter("id = 1"), "k", ["id"], "t").first()["metric"] == 1.0


def test_rules_and_score(spark):
    df = spark.createDataFrame([("A", 5, "x1"), ("B", 50, "y"), (None, -1, None)], "s string, n int, c string")
    rules = [
        Rule("s", "mandatory", severity="CRITICAL"),
        Rule("s", "allowed_values", ["A", "B"], "HIGH"),
        Rule("n", "value_range", (0, 10), "MEDIUM"),
        Rule("n", "unique", severity="LOW"),
        Rule("c", "pattern", r"^x\d$", "HIGH"),
        Rule("gone", "mandatory", severity="MEDIUM"),
    ]
    out = checks.dq_rules(df, rules)
    assert [(r["violations"], r["status"]) for r in out.collect()] == [
        (1, "FAIL"), (0, "PASS"), (2, "FAIL"), (0, "PASS"), (1, "FAIL"), (None, "FAIL"),
    ]
    assert checks.dq_severity_score(out).first()["dq_score"] == 100 - 15 - 3 - 8 - 3
    with pytest.raises(ValueError):
        Rule("s", "typo").violations()


def test_gate(spark):
    df = spark.createDataFrame([(1, -1.0)], "a int, v double")
    ok = [Check("c", F.lit(0) * F.count("*"))]
    warn = [*ok, checks.check_negative("v")]
    block = [*warn, checks.check_expected_rows(5)]
    gates = [checks.quality_gate(checks.run_checks(df, "t", c)).first()["gate"] for c in (ok, warn, block)]
    assert gates == ["CLEAR", "CLEAR WITH WARNINGS", "BLOCKED"]
    checks.require_clear(checks.quality_gate(checks.run_checks(df, "t", warn)))
    with pytest.raises(RuntimeError):
        checks.require_clear(checks.quality_gate(checks.run_checks(df, "t", block)))


def test_drift(spark):
    schema = "table_name string, column_name string, type string, nullable boolean"
    old = spark.createDataFrame(checks.schema_rows(spark.createDataFrame([(1, "x", 2)], "a int, b string, gone int"), "t"), schema)
    new = spark.createDataFrame(checks.schema_rows(spark.createDataFrame([(1, 2.0, 2)], "a int not null, b double, fresh int"), "t"), schema)
    assert {(r["column_name"], r["change"]) for r in checks.schema_drift(old, new).collect()} == {
        ("a", "NULLABILITY_CHANGED"), ("b", "TYPE_CHANGED"), ("gone", "DROPPED"), ("fresh", "ADDED"),
    }


def test_lag_counts_mondays(spark):
    inner = spark.createDataFrame([(D(2024, 1, 1),)], "d date")  # a Monday
    market = spark.createDataFrame([(D(2023, 12, 31),)], "d date")  # the Sunday before
    out = checks.market_data_lag(inner, market, "d", "d", 0).first()
    assert (out["lag_weeks"], out["lag_banner_required"]) == (1, True)


def test_volume_drop(spark):
    rows = [(D(2024, 1, 5),)] * 10 + [(D(2024, 2, 5),)] * 9 + [(D(2024, 3, 5),)] * 7 + [(D(2024, 4, 5),)] * 6
    out = checks.prior_period_volume_check(spark.createDataFrame(rows, "d date"), "d", 0.8).orderBy("period").collect()
    assert [r["status"] for r in out] == ["PASS", "PASS", "ERROR", "WARNING"]
    assert [r["below_minimum"] for r in out] == [False, False, True, False]
