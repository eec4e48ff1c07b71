from helpers import by, housing_rows

from plumbline.operators.remediate import flag_counts, remediate, remediation_summary
from plumbline.plans import housing as pack
from plumbline.plans.fixture import housing
from plumbline.sources.outputs import export_columns


def run(df):
    return remediate(df, pack.rules(), pack.REMEDIATION, "2026-12-01", as_of="2026-12")


def test_texts_keep_the_leading_separator(spark):
    df = housing_rows(
        spark,
        {"HOUSING_STARTS": -5.0, "AVERAGE_PRICE_CAD": -200000.0},
        {"AVERAGE_PRICE_CAD": -200000.0},
        {"HOUSING_STARTS": None, "AVERAGE_PRICE_CAD": None},
        {"HOUSING_STARTS": None, "AVERAGE_PRICE_CAD": None, "STATUS": "F"},
        {"HOUSING_STARTS": -20001.0},
        {},
        {"AVERAGE_PRICE_CAD": 50000.0},
    )
    out = by(run(df), "record_key")
    flags = [out[i]["_dq_flag"] for i in range(1, 8)]
    assert flags == [
        "DQ-002: Negative value corrected to absolute | DQ-004: Negative price corrected",
        " | DQ-004: Negative price corrected",
        " | DQ-001: NULL flagged for steward review | DQ-003: NULL price flagged for steward review",
        " | DQ-001: NULL flagged for steward review",
        "DQ-002: Negative value corrected to absolute | DQ-013: Statistical outlier flagged for steward review",
        "CLEAN",
        " | DQ-014: Price accuracy outlier flagged for steward review",
    ]
    assert (out[1]["HOUSING_STARTS"], out[1]["AVERAGE_PRICE_CAD"], out[3]["HOUSING_STARTS"]) == (5.0, 200000.0, None)
    assert out[1]["_dq_flags"] == ["DQ-002", "DQ-004"] and out[6]["_dq_flags"] == []
    assert out[6]["_remediation_date"] == "2026-12-01"


def test_fixture(spark, sf_dir):
    out = run(housing(spark, sf_dir))
    counts = {k: r["records"] for k, r in by(flag_counts(out), "rule_id").items()}
    assert (counts["DQ-013"], counts["DQ-014"]) == (11, 2)
    row = remediation_summary(out, pack.REMEDIATION).first()
    assert (row["total_records"], row["clean_records"], row["auto_remediated"]) == (1500, 1384, 40 + 16)


def test_a_second_run_changes_no_value(spark, sf_dir):
    columns = ["record_key", "HOUSING_STARTS", "AVERAGE_PRICE_CAD"]
    once = run(housing(spark, sf_dir)).drop("_dq_flags", "_dq_flag", "_remediation_date")
    twice = run(once)
    assert sorted(once.select(columns).collect(), key=str) == sorted(twice.select(columns).collect(), key=str)
    assert twice.filter("array_contains(_dq_flags, 'DQ-002') OR array_contains(_dq_flags, 'DQ-004')").count() == 0


def test_export_drops_helpers(spark):
    df = housing_rows(spark, {}).selectExpr("*", "1 AS _helper")
    columns = export_columns(run(df)).columns
    assert "_helper" not in columns and "_dq_flags" not in columns
    assert columns[-2:] == ["_dq_flag", "_remediation_date"]
