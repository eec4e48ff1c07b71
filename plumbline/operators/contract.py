"""Check a table against a data contract: schema, required fields, allowed values, ranges, formats, service levels.

The contract is a plain dict with `schema.fields` and `quality.rules`, as a contract file in YAML or JSON holds it. All
checks on values become one aggregate over one scan; the values outside a domain are listed from the violating rows only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.ladders import sla_status
from plumbline.functions.rates import mean_rate, to_basis_points
from plumbline.operators.rule import Scope

# The patterns of the known formats, and below the wording of checks and details. Fields with another format are not checked.
FORMATS = {"YYYY-MM": "^[0-9]{4}-[0-9]{2}$", "YYYY-MM-DD": "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"}

CHECK_SCHEMA = "section string, check string, status string, detail string, violations long"


def _number(value: float) -> str:
    return f"{value:,}"


def schema_checks(spark: SparkSession, columns: Sequence[str], contract: Mapping[str, Any]) -> DataFrame:
    """Contract fields absent from the table fail; columns the contract does not know are a warning."""
    wanted = [f["name"] for f in contract["schema"]["fields"]]
    absent = [c for c in wanted if c not in columns]
    extra = [c for c in columns if c not in wanted]
    rows = [
        (
            "schema",
            "All contract fields present in dataset",
            "FAIL" if absent else "PASS",
            f"Missing: {absent}" if absent else "",
            len(absent),
        ),
        (
            "schema",
            "No undocumented columns in dataset",
            "WARN" if extra else "PASS",
            f"Undocumented: {extra}" if extra else "",
            len(extra),
        ),
    ]
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def _value_checks(scope: Scope, contract: Mapping[str, Any]) -> list[tuple[str, str, str, Column, str]]:
    """(section, field, label, violating predicate, unit of the detail) for each check on the values of a field."""
    fields = [f for f in contract["schema"]["fields"] if scope.has(f["name"])]
    checks = []
    for f in fields:
        if f.get("required"):
            name = f["name"]
            checks.append(("required", name, f"{name} has no nulls (required: true)", scope.missing(name), "null(s) found"))
    for f in fields:
        if f.get("validValues"):
            name = f["name"]
            outside = ~scope.col(name).isin(list(f["validValues"]))
            checks.append(("valid_values", name, f"{name} values within defined domain", outside, ""))
    for f in fields:
        name = f["name"]
        if f.get("minimum") is not None:
            below = scope.col(name) < f["minimum"]
            label = f"{name} >= {_number(f['minimum'])}"
            checks.append(("range", name, label, below, "record(s) below minimum"))
        if f.get("maximum") is not None:
            above = scope.col(name) > f["maximum"]
            label = f"{name} <= {_number(f['maximum'])}"
            checks.append(("range", name, label, above, "record(s) above maximum"))
    for f in fields:
        if f.get("format") in FORMATS:
            name = f["name"]
            wrong = ~scope.col(name).cast("string").rlike(FORMATS[f["format"]])
            checks.append(("format", name, f"{name} follows {f['format']} format", wrong, "record(s) with invalid format"))
    return checks


def value_checks(df: DataFrame, contract: Mapping[str, Any]) -> DataFrame:
    """One row per check on values, with the number of violating rows; one scan for all of them."""
    checks = _value_checks(Scope(df.schema), contract)
    counts = df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(f"v{i}") for i, (*_, bad, _) in enumerate(checks)])
    lines = [
        F.struct(
            F.lit(section).alias("section"),
            F.lit(field).alias("field"),
            F.lit(label).alias("check"),
            F.col(f"v{i}").alias("violations"),
            F.lit(unit).alias("unit"),
        )
        for i, (section, field, label, _, unit) in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*lines)))


def invalid_values(df: DataFrame, contract: Mapping[str, Any]) -> DataFrame:
    """Rows (field, value, records): every value outside the domain of its field, whole."""
    bad = [(field, cond) for section, field, _, cond, _ in _value_checks(Scope(df.schema), contract) if section == "valid_values"]
    if not bad:
        return df.sparkSession.createDataFrame([], "field string, value string, records long")
    any_bad = F.lit(False)
    for _, cond in bad:
        any_bad = any_bad | F.coalesce(cond, F.lit(False))
    lines = [
        F.when(cond, F.struct(F.lit(field).alias("field"), F.col(f"`{field}`").cast("string").alias("value")))
        for field, cond in bad
    ]
    values = df.filter(any_bad).select(F.inline(F.array(*lines))).filter("field IS NOT NULL")
    return values.groupBy("field", "value").agg(F.count(F.lit(1)).alias("records"))


def _kinds(invalid: DataFrame) -> DataFrame:
    """Per field, the number of distinct invalid values; the values themselves are rows of invalid_values()."""
    return invalid.groupBy("field").agg(F.count(F.lit(1)).alias("kinds"))


def sla_checks(scorecard: DataFrame, contract: Mapping[str, Any]) -> DataFrame:
    """The pass rate of each rule against its own thresholds. A rule without a result fails."""
    spark = scorecard.sparkSession
    rules = [
        (r["ruleId"], r["field"], int(r["tier"]), float(r["warnThreshold"]), float(r["criticalThreshold"]))
        for r in contract["quality"]["rules"]
    ]
    wanted = spark.createDataFrame(rules, "Rule_ID string, field string, tier int, warn double, critical double")
    rates = scorecard.select("Rule_ID", F.col("Pass_Rate_Pct").cast("double").alias("rate"), F.col("Records_Failed").cast("long").alias("failed"))
    rate, warn, critical = F.col("rate"), F.col("warn"), F.col("critical")
    level = sla_status(rate, warn, critical)
    outcome = F.when(level == "PASS", "met").when(level == "WARN", "warn").otherwise("CRITICAL breach")
    label = F.format_string("%s (%s) — Tier %d SLA %s", "Rule_ID", "field", "tier", outcome)
    detail = (
        F.when(level == "PASS", F.concat(F.format_string("Pass rate %.2f%% >= ", rate), warn.cast("string"), F.lit("% warn threshold")))
        .when(
            level == "WARN",
            F.concat(
                F.format_string("Pass rate %.2f%% below ", rate),
                warn.cast("string"),
                F.lit("% warn threshold (above "),
                critical.cast("string"),
                F.lit("% critical)"),
            ),
        )
        .otherwise(F.concat(F.format_string("Pass rate %.2f%% below ", rate), critical.cast("string"), F.lit("% critical threshold")))
    )
    found = rate.isNotNull()
    # Both sides have one row per rule.
    joined = wanted.join(F.broadcast(rates), "Rule_ID", "left")
    return joined.select(
        F.lit("sla").alias("section"),
        F.when(found, label).otherwise(F.concat("Rule_ID", F.lit(" — result found in scorecard"))).alias("check"),
        F.when(found, level).otherwise("FAIL").alias("status"),
        F.when(found, detail).otherwise("Rule not found in scorecard").alias("detail"),
        F.coalesce("failed", F.lit(0)).alias("violations"),
    )


def _tiers(scorecard: DataFrame, contract: Mapping[str, Any]) -> DataFrame:
    """Scorecard rows of the rules the contract knows, with the tier it puts them in."""
    rules = [(r["ruleId"], int(r["tier"])) for r in contract["quality"]["rules"]]
    wanted = scorecard.sparkSession.createDataFrame(rules, "Rule_ID string, tier int")
    # Both sides have one row per rule.
    return scorecard.join(F.broadcast(wanted), "Rule_ID")


def tier_levels(scorecard: DataFrame, contract: Mapping[str, Any]) -> DataFrame:
    """Each rule judged by the thresholds of its tier, whatever its own are."""
    limits = contract["quality"]["tiers"]

    def limit(kind: str) -> Column:
        expr = F.lit(None).cast("double")
        for name, tier in limits.items():
            expr = F.when(F.col("tier") == int(name.removeprefix("tier")), float(tier[kind])).otherwise(expr)
        return expr

    level = sla_status(F.col("Pass_Rate_Pct"), limit("warnThreshold"), limit("criticalThreshold"))
    return _tiers(scorecard, contract).select("Rule_ID", "tier", "Pass_Rate_Pct", level.alias("level"))


def dimension_levels(scorecard: DataFrame, contract: Mapping[str, Any]) -> DataFrame:
    """Mean pass rate per dimension and tier, judged by the thresholds the contract sets for them."""
    limits = [
        (d["dimension"], int(name.removeprefix("tier")), float(d[name]["warn"]), float(d[name]["critical"]))
        for d in contract["quality"]["dimensions"]
        for name in d
        if name.startswith("tier")
    ]
    wanted = scorecard.sparkSession.createDataFrame(limits, "dimension string, tier int, warn double, critical double")
    means = (
        _tiers(scorecard, contract)
        .groupBy(F.lower("DQ_Dimension").alias("dimension"), "tier")
        .agg(F.count(F.lit(1)).alias("rules"), F.sum(to_basis_points(F.col("Pass_Rate_Pct"))).alias("_bp"))
        .withColumn("avg_pass_rate", mean_rate(F.col("_bp"), F.col("rules")))
    )
    level = sla_status(F.col("avg_pass_rate"), F.col("warn"), F.col("critical"))
    # A few rows on both sides.
    joined = means.join(F.broadcast(wanted), ["dimension", "tier"])
    return joined.select("dimension", "tier", "rules", "avg_pass_rate", level.alias("level"))


def value_details(df: DataFrame, contract: Mapping[str, Any]) -> DataFrame:
    """The checks on values as rows (section, check, status, detail, violations)."""
    # A row for each field of the contract on both sides.
    checks = value_checks(df, contract).join(F.broadcast(_kinds(invalid_values(df, contract))), "field", "left")
    bad = F.col("violations") > 0
    invalid = F.format_string("Invalid values found: %d distinct in %d record(s)", "kinds", "violations")
    counted = F.concat_ws(" ", F.col("violations").cast("string"), "unit")
    return checks.select(
        "section",
        "check",
        F.when(bad, "FAIL").otherwise("PASS").alias("status"),
        F.when(~bad, "").when(F.col("section") == "valid_values", invalid).otherwise(counted).alias("detail"),
        "violations",
    )


def validate(df: DataFrame, contract: Mapping[str, Any], scorecard: DataFrame | None = None) -> DataFrame:
    """All checks as rows (section, check, status, detail, violations). Service levels are judged by the scorecard given,
    fresh or read back."""
    out = schema_checks(df.sparkSession, df.columns, contract).unionByName(value_details(df, contract))
    return out if scorecard is None else out.unionByName(sla_checks(scorecard, contract))


def verdict(checks: DataFrame) -> DataFrame:
    """One row: number of checks by status, and the verdict."""
    counts = checks.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("status") == s).alias(name) for s, name in (("PASS", "passed"), ("WARN", "warned"), ("FAIL", "failed"))],
    )
    text = F.when(F.col("failed") > 0, "FAILED").when(F.col("warned") > 0, "PASSED WITH WARNINGS").otherwise("SATISFIED")
    return counts.withColumn("verdict", text)
