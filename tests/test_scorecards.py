"""The published rule results go in, the published roll-ups come out."""

import pytest
from helpers import by

from plumbline.operators import explore, scorecards
from plumbline.operators.governance import escalation
from plumbline.operators.run import finish_scorecard
from plumbline.operators.rule import rule_table
from plumbline.plans import housing as pack

FAILED = {"DQ-001": 203, "DQ-002": 307, "DQ-003": 134, "DQ-004": 117, "DQ-013": 6, "DQ-014": 117}


@pytest.fixture(scope="module")
def published(spark):
    meta = rule_table(spark, pack.rules())
    counts = spark.createDataFrame(
        [(r.rule_id, 10800, FAILED.get(r.rule_id, 0)) for r in pack.rules()],
        "Rule_ID string, Total_Records long, Records_Failed long",
    )
    return finish_scorecard(counts.join(meta, "Rule_ID")).cache()


def test_rates_and_status(published):
    rates = {k: r["Pass_Rate_Pct"] for k, r in by(published, "Rule_ID").items()}
    assert [rates[k] for k in FAILED] == [98.12, 97.16, 98.76, 98.92, 99.94, 98.92]
    assert sum(r["Status"] == "PASS" for r in published.collect()) == 9
    assert sum(r["Status"] == "WARN" for r in published.collect()) == 6


def test_by_dimension(published):
    rows = by(scorecards.by_dimension(published), "DQ_Dimension")
    got = {d: (r["Rules_Count"], r["Avg_Pass_Rate"], r["Total_Failed"], r["Rules_Passing"], r["Dimension_Grade"]) for d, r in rows.items()}
    assert got == {
        "Accuracy": (2, 99.43, 123, 0, "A"),
        "Completeness": (2, 98.44, 337, 0, "B"),
        "Consistency": (1, 100.0, 0, 1, "A"),
        "Uniqueness": (1, 100.0, 0, 1, "A"),
        "Validity": (9, 99.56, 424, 7, "A"),
    }
    worst_first = [r["DQ_Dimension"] for r in scorecards.by_dimension(published, ordered=True).collect()]
    assert worst_first[0] == "Completeness"


def test_by_cde(published):
    rows = by(scorecards.by_cde(published, pack.CDE_RULES), "CDE")
    got = {k: (r["Rules_Applied"], r["Avg_Pass_Rate"], r["Total_Failed_Records"], r["CDE_Grade"], r["Action_Required"]) for k, r in rows.items()}
    assert got == {
        "HOUSING_STARTS": (3, 98.41, 516, "B", "Yes"),
        "AVERAGE_PRICE_CAD": (4, 99.15, 368, "B", "Yes"),
        "GEO + GEO_CODE": (2, 100.0, 0, "A", "No"),
        "DWELLING_TYPE": (1, 100.0, 0, "A", "No"),
        "INTENDED_MARKET": (1, 100.0, 0, "A", "No"),
        "REF_DATE": (2, 100.0, 0, "A", "No"),
    }


def test_summary(published):
    row = scorecards.summary(published, "d", "2026-05-30").first().asDict()
    assert (row["Rules_PASS"], row["Rules_WARN"], row["Rules_FAIL"], row["Total_Rule_Failures"]) == (9, 6, 0, 884)
    assert (row["Overall_DQ_Score_Pct"], row["Overall_Grade"]) == (99.45, "A")
    assert [row[f"{d}_Score"] for d in scorecards.DIMENSIONS] == [98.44, 99.56, 100.0, 99.43, 100.0]
    assert row["Recommended_Action"].startswith("Escalate DQ-001, DQ-002, DQ-003, DQ-004, DQ-013, DQ-014 to")


def test_dimension_without_rules(published):
    few = published.filter("DQ_Dimension <> 'Accuracy'")
    assert scorecards.summary(few, "d", "x").first()["Accuracy_Score"] is None
    assert scorecards.run_summary(few).first()["accuracy"] == 100.0


def test_run_summary_and_clean_share(spark, published):
    unique = spark.createDataFrame([(10800, 751, 93.0)], "total_records long, failed_records long, clean_pct double")
    row = scorecards.run_summary(published, unique).first()
    assert (row["overall_score"], row["overall_grade"], row["clean_pct"]) == (99.5, "A", 93.0)
    assert scorecards.run_summary(published).first()["clean_pct"] == 91.8  # from the sum of failures


def test_executive(spark, published):
    unique = spark.createDataFrame([(10800, 751, 93.0)], "total_records long, failed_records long, clean_pct double")
    row = explore.executive(scorecards.summary(published, "d", "x"), unique).first()
    assert (row["Unique_Failed_Records"], row["Clean_Records_Pct"], row["Overall_Grade"]) == (751, 93.0, "A")


def test_escalation_bands(published):
    rows = by(escalation(published), "Rule_ID")
    assert {k: r["Issue_Severity"] for k, r in rows.items()} == {
        "DQ-001": "Medium", "DQ-002": "Medium", "DQ-003": "Medium", "DQ-004": "Medium", "DQ-013": "Low", "DQ-014": "Medium",
    }


def test_escalation_bounds(spark):
    rows = [(str(f), "x", 1000, f) for f in (0, 1, 9, 10, 49, 50, 150, 151, 1000)]
    df = spark.createDataFrame(rows, "Rule_ID string, CDE_Affected string, Total_Records long, Records_Failed long")
    got = {k: r["Issue_Severity"] for k, r in by(escalation(df), "Rule_ID").items()}
    assert got == {
        "1": "Low", "9": "Low", "10": "Medium", "49": "Medium", "50": "High", "150": "High", "151": "Critical", "1000": "Critical",
    }


def test_grades(spark):
    from pyspark.sql import functions as F

    from plumbline.functions.ladders import grade

    df = spark.createDataFrame([(s,) for s in (100.0, 99.15, 99.0, 95.0, 94.99, 90.0, 89.9)], "s double")
    rows = df.select(*[grade(F.col("s"), k).alias(k) for k in ("engine", "dashboard", "cde")]).collect()
    assert [r["engine"] for r in rows] == list("AAABCCC")
    assert [r["dashboard"] for r in rows] == list("AAABCCD")
    assert [r["cde"] for r in rows] == list("ABBBCCC")
