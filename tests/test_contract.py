import json

import pytest
from helpers import by, housing_rows
from test_scorecards import published  # noqa: F401

from plumbline.operators import contract as k
from plumbline.plans.housing_contract import contract
from plumbline.sources.tables import HOUSING_SCHEMA, read_contract


@pytest.fixture(scope="module")
def table_like_published(spark):
    """A table with the published faults: only negative starts and prices break the contract's value checks."""
    good = {
        "REF_DATE": "2020-01", "GEO": "Ontario", "GEO_CODE": "ON", "DWELLING_TYPE": "Row House", "INTENDED_MARKET": "Rental",
        "HOUSING_STARTS": 1.0, "AVERAGE_PRICE_CAD": 1.0, "DECIMALS": 0, "STATUS": None,
    }
    rows = [{**good}, {**good, "HOUSING_STARTS": -1.0}, {**good, "AVERAGE_PRICE_CAD": -1.0, "STATUS": "E"}]
    return spark.createDataFrame([tuple(r.get(f.name, "x") for f in HOUSING_SCHEMA) for r in rows], HOUSING_SCHEMA)


def test_thirty_nine_checks(table_like_published, published):  # noqa: F811
    checks = k.validate(table_like_published, contract(), published)
    row = k.verdict(checks).first()
    assert (row["total"], row["passed"], row["warned"], row["failed"], row["verdict"]) == (39, 32, 5, 2, "FAILED")
    sections = {}
    for r in checks.collect():
        sections[r["section"]] = sections.get(r["section"], 0) + 1
    assert sections == {"schema": 2, "required": 13, "valid_values": 5, "range": 3, "format": 1, "sla": 15}
    details = by(checks, "check")
    assert details["HOUSING_STARTS >= 0"]["detail"] == "1 record(s) below minimum"
    assert details["DQ-001 (HOUSING_STARTS) — Tier 1 SLA warn"]["detail"] == (
        "Pass rate 98.12% below 99.0% warn threshold (above 97.0% critical)"
    )
    assert details["DQ-012 (STATUS) — Tier 2 SLA met"]["detail"] == "Pass rate 100.00% >= 97.0% warn threshold"


def test_schema_checks(spark):
    rows = by(k.schema_checks(spark, ["REF_DATE", "extra"], contract(("REF_DATE", "GEO"))), "check")
    missing, extra = rows["All contract fields present in dataset"], rows["No undocumented columns in dataset"]
    assert (missing["status"], missing["detail"]) == ("FAIL", "Missing: ['GEO']")
    assert (extra["status"], extra["detail"]) == ("WARN", "Undocumented: ['extra']")


def test_value_checks_ignore_nulls_and_unknown_formats(spark):
    spec = {"schema": {"fields": [
        {"name": "REF_DATE", "format": "YYYY-MM"}, {"name": "GEO", "format": "whatever"},
        {"name": "GEO_CODE", "validValues": ["ON"]}, {"name": "HOUSING_STARTS", "minimum": 100, "maximum": 100},
    ]}}
    nulls = {"REF_DATE": None, "GEO_CODE": None, "HOUSING_STARTS": None}
    df = housing_rows(spark, {}, nulls, {"REF_DATE": "2020", "GEO_CODE": "QC", "HOUSING_STARTS": 101.0}, {"HOUSING_STARTS": float("nan")})
    rows = by(k.value_checks(df, spec), "check")
    assert {name: r["violations"] for name, r in rows.items()} == {
        "REF_DATE follows YYYY-MM format": 1, "GEO_CODE values within defined domain": 1, "HOUSING_STARTS >= 100": 0, "HOUSING_STARTS <= 100": 1,
    }


def test_day_format(spark):
    spec = {"schema": {"fields": [{"name": "d", "format": "YYYY-MM-DD"}]}}
    df = spark.createDataFrame([("2020-01-31",), ("2020-01",), (None,)], "d string")
    assert k.value_checks(df, spec).first()["violations"] == 1


def test_many_invalid_values_are_all_listed_apart(spark):
    spec = {"schema": {"fields": [{"name": "v", "validValues": ["ok"]}]}}
    df = spark.range(2000).selectExpr("concat('bad', lpad(id % 70, 3, '0')) AS v")
    assert k.invalid_values(df, spec).count() == 70
    detail = by(k.validate(df, spec), "check")["v values within defined domain"]["detail"]
    assert detail == "Invalid values found: 70 distinct in 2000 record(s)"


def test_rule_without_result_fails(published):  # noqa: F811
    rows = by(k.sla_checks(published.filter("Rule_ID <> 'DQ-005'"), contract()), "check")
    row = rows["DQ-005 — result found in scorecard"]
    assert (row["status"], row["detail"]) == ("FAIL", "Rule not found in scorecard")


def test_warnings_and_satisfied(spark):
    def verdict(*statuses):
        rows = [("s", "c", s, "", 0) for s in statuses]
        return k.verdict(spark.createDataFrame(rows, k.CHECK_SCHEMA)).first()["verdict"]

    assert verdict("PASS", "PASS") == "SATISFIED"
    assert verdict("PASS", "WARN") == "PASSED WITH WARNINGS"
    assert verdict("WARN", "FAIL") == "FAILED"


def test_contract_files(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(contract()))
    (tmp_path / "c.json").write_text(json.dumps(contract()))
    assert read_contract(spark, str(tmp_path / "c.yaml")) == contract() == read_contract(spark, str(tmp_path / "c.json"))


def test_levels_by_tier_and_dimension(published):  # noqa: F811
    tiers = {name: r["level"] for name, r in by(k.tier_levels(published, contract()), "Rule_ID").items()}
    # Held to the thresholds of tier 1 alone, only these five fall short.
    assert sorted(name for name, level in tiers.items() if level == "WARN") == ["DQ-001", "DQ-002", "DQ-003", "DQ-004", "DQ-014"]
    assert tiers["DQ-012"] == "PASS" and len(tiers) == 15
    rows = k.dimension_levels(published, contract()).collect()
    levels = {(r["dimension"], r["tier"]): (r["rules"], r["avg_pass_rate"], r["level"]) for r in rows}
    assert levels[("completeness", 1)] == (2, 98.44, "WARN")
    assert levels[("validity", 1)] == (8, 99.51, "PASS") and levels[("validity", 2)] == (1, 100.0, "PASS")
    assert len(levels) == 6
