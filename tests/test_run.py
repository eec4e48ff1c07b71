import pytest
from helpers import GOOD, HOUSING, by, housing_rows, one
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.operators import checks as c
from plumbline.operators.run import SCORECARD_COLUMNS, Run
from plumbline.plans import housing as pack
from plumbline.plans import packs
from plumbline.plans.fixture import housing, table

AS_OF = "2026-12"
EXPECTED = [29, 40, 22, 16, 1, 5, 3, 3, 10, 139, 7, 2, 11, 18, 9]


@pytest.fixture(scope="module")
def run(spark, sf_dir):
    return Run(housing(spark, sf_dir), pack.rules(), as_of=AS_OF, run_ts="2026-12-01 00:00")


def test_scorecard_of_the_fixture(run):
    rows = by(run.scorecard(), "Rule_ID")
    assert [rows[r.rule_id]["Records_Failed"] for r in pack.rules()] == EXPECTED
    assert {r["Total_Records"] for r in rows.values()} == {1500}
    assert all(r["Records_Passed"] + r["Records_Failed"] == 1500 for r in rows.values())
    assert tuple(run.scorecard().columns) == SCORECARD_COLUMNS


def test_rates_round_like_the_published_ones(spark):
    from plumbline.functions.rates import percent

    failed = {203: 98.12, 307: 97.16, 134: 98.76, 117: 98.92, 6: 99.94, 0: 100.0}
    df = spark.createDataFrame([(f, 10800) for f in failed], "f long, n long")
    rates = df.select("f", percent(F.col("n") - F.col("f"), F.col("n")).alias("p")).collect()
    assert {r["f"]: r["p"] for r in rates} == failed


def test_exceptions_agree_with_the_scorecard(run):
    counts = {r["_rule_id"]: r["count"] for r in run.exceptions().groupBy("_rule_id").count().collect()}
    assert [counts[r.rule_id] for r in pack.rules()] == EXPECTED
    assert run.exceptions().columns[-8:] == [
        "_rule_id", "_rule_name", "_dimension", "_cde", "_severity", "_failure_reason", "_remediation", "_flagged_at",
    ]


def test_distinct_failing_records_both_ways(run):
    assert run.unique_failed().first()["failed_records"] == 272
    assert run.annotated().filter(F.size("_failed_rules") > 0).count() == 272
    assert run.exceptions().select("record_key").distinct().count() == 272


def test_violations_agree_with_masks(run):
    for rule, n in zip(pack.rules(), EXPECTED, strict=True):
        assert run.violations(rule.rule_id, ["record_key"]).count() == n


def test_empty_table_scores_zero(spark):
    df = spark.createDataFrame([], HOUSING)
    run = Run(df, pack.rules(), as_of=AS_OF)
    rows = run.scorecard().collect()
    assert len(rows) == 15
    assert {(r["Total_Records"], r["Records_Failed"], r["Pass_Rate_Pct"], r["Status"]) for r in rows} == {(0, 0, 0.0, "FAIL")}
    assert run.exceptions().count() == 0
    assert run.unique_failed().first().asDict() == {"total_records": 0, "failed_records": 0, "clean_pct": 100.0}


def test_pass_is_judged_on_the_rounded_rate(spark):
    df = spark.range(30000).select(F.when(F.col("id") > 0, F.col("id")).alias("v"))
    loose = Run(df, [one(c.not_null("v"))]).scorecard().first()
    strict = Run(df, [one(c.not_null("v"))], strict_pass=True).scorecard().first()
    assert (loose["Records_Failed"], loose["Pass_Rate_Pct"], loose["Status"]) == (1, 100.0, "PASS")
    assert strict["Status"] == "WARN"


def test_missing_columns_are_named(spark):
    df = housing_rows(spark, {}).drop("GEO", "STATUS")
    with pytest.raises(ValueError, match="GEO, STATUS"):
        Run(df, pack.rules(), as_of=AS_OF)


def test_lenient_run_on_an_incomplete_table(spark):
    df = housing_rows(spark, {}, {"STATUS": "F", "AVERAGE_PRICE_CAD": None}, {"HOUSING_STARTS": 30000.0})
    run = Run(df.drop("STATUS", "GEO", "GEO_CODE"), pack.upload_rules(), as_of=AS_OF, lenient=True)
    failed = {k: r["Records_Failed"] for k, r in by(run.scorecard(), "Rule_ID").items()}
    assert failed["DQ-003"] == 1  # without a status nothing counts as suppressed
    assert failed["DQ-006"] == 3  # an absent code is no valid code
    assert failed["DQ-012"] == failed["DQ-013"] == failed["DQ-014"] == failed["DQ-015"] == 0
    assert failed["DQ-010"] == 0
    assert run.unique_failed().first()["failed_records"] == 3
    assert {r["Remediation_Action"] for r in run.scorecard().collect()} == {pack.UPLOAD_ACTION}


def test_lenient_run_with_an_empty_metric(spark):
    df = housing_rows(spark, {"HOUSING_STARTS": None}, {"HOUSING_STARTS": None})
    failed = by(Run(df, pack.upload_rules(), as_of=AS_OF, lenient=True).scorecard(), "Rule_ID")
    assert (failed["DQ-001"]["Records_Failed"], failed["DQ-013"]["Records_Failed"]) == (2, 0)


def test_price_ceiling_is_a_parameter(spark):
    df = housing_rows(spark, {"AVERAGE_PRICE_CAD": 5e6}, {"AVERAGE_PRICE_CAD": 2e6}, {"AVERAGE_PRICE_CAD": 2e7})
    default = by(Run(df, pack.rules(), as_of=AS_OF).scorecard(), "Rule_ID")["DQ-005"]
    high = by(Run(df, pack.rules(price_ceiling=1e7), as_of=AS_OF).scorecard(), "Rule_ID")["DQ-005"]
    assert (default["Records_Failed"], high["Records_Failed"]) == (2, 1)
    assert high["Description"] == "AVERAGE_PRICE_CAD must not exceed $10,000,000."


cell = {
    "REF_DATE": st.sampled_from(["2020-01", "2020/01", "2999-01", "2020-13", None]),
    "GEO_CODE": st.sampled_from(["ON", "QC", "XX", None]),
    "DWELLING_TYPE": st.sampled_from(["Row House", "Duplex", None]),
    "INTENDED_MARKET": st.sampled_from(["Rental", "Other", None]),
    "HOUSING_STARTS": st.sampled_from([None, float("nan"), -5.0, 0.0, 10.0, 20000.0, 20001.0]),
    "AVERAGE_PRICE_CAD": st.sampled_from([None, -1.0, 0.0, 99999.0, 100000.0, 2000000.0, 3000001.0]),
    "STATUS": st.sampled_from([None, "", "F", "X"]),
}


def brute_force(rows):
    """Failures per rule for rows as dicts, in plain Python."""
    import math
    import statistics as s

    def missing(v):
        return v is None or (isinstance(v, float) and math.isnan(v))

    limit = {}
    for column in ("HOUSING_STARTS", "AVERAGE_PRICE_CAD"):
        groups = {}
        for r in rows:
            if r["GEO_CODE"] is not None and not missing(r[column]):
                groups.setdefault(r["GEO_CODE"], []).append(r[column])
        limit[column] = {k: s.mean(v) + 3 * s.stdev(v) for k, v in groups.items() if len(v) > 1}
    grain = [tuple(r[k] for k in pack.GRAIN) for r in rows]
    out = []
    for r, key in zip(rows, grain, strict=True):
        hs, price, code, status = r["HOUSING_STARTS"], r["AVERAGE_PRICE_CAD"], r["GEO_CODE"], r["STATUS"]
        month = r["REF_DATE"]
        fails = [
            missing(hs),
            not missing(hs) and hs < 0,
            missing(price) and status != "F",
            not missing(price) and price < 0,
            not missing(price) and price > 2_000_000,
            code not in pack.GEO_CODES.values(),
            r["DWELLING_TYPE"] not in pack.DWELLING_TYPES,
            r["INTENDED_MARKET"] not in pack.MARKETS,
            month is None or "/" in month,
            grain.count(key) > 1,
            month is None or month > AS_OF,
            (status or "") not in pack.STATUS_CODES,
            not missing(hs) and (hs > 20_000 or hs > limit["HOUSING_STARTS"].get(code, math.inf)),
            not missing(price)
            and (price < 100_000 or price > 3_000_000 or price > limit["AVERAGE_PRICE_CAD"].get(code, math.inf)),
            r["GEO"] in pack.GEO_CODES and pack.GEO_CODES[r["GEO"]] != code,
        ]
        out.append({rule.rule_id for rule, bad in zip(pack.rules(), fails, strict=True) if bad})
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.fixed_dictionaries(cell), min_size=1, max_size=25))
def test_any_table_against_brute_force(spark, rows):
    rows = [{**GOOD, **r} for r in rows]
    df = spark.createDataFrame([(i, *[r[k] for k in GOOD]) for i, r in enumerate(rows)], HOUSING)
    run = Run(df, pack.rules(), as_of=AS_OF)
    expected = brute_force(rows)
    found = {r["record_key"]: set(r["_failed_rules"]) for r in run.annotated().collect()}
    assert found == dict(enumerate(expected))
    failed = {r["Rule_ID"]: r["Records_Failed"] for r in run.scorecard().collect()}
    assert failed == {r.rule_id: sum(r.rule_id in x for x in expected) for r in pack.rules()}
    assert run.unique_failed().first()["failed_records"] == sum(bool(x) for x in expected)


def test_scorecards_of_slices_add_up(spark, sf_dir):
    lines = packs.lineitem(spark, sf_dir).withColumn("flag", F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")))
    run = Run(lines, packs.lineitem_rules(spark, sf_dir), as_of="2001-06")
    whole = by(run.scorecard(), "Rule_ID")
    rows = run.scorecard_by("flag", "l_linestatus", totals=True).collect()
    for level in (0, 1, 2):
        for rule_id, total in whole.items():
            own = [r for r in rows if r["Slice_Level"] == level and r["Rule_ID"] == rule_id]
            assert sum(r["Records_Failed"] for r in own) == total["Records_Failed"]
            assert sum(r["Total_Records"] for r in own) == total["Total_Records"]
    assert len({r["flag"] for r in rows if r["Slice_Level"] == 1}) == 3  # NULL is a slice
    top = [r.asDict() for r in rows if r["Slice_Level"] == 0]
    assert {r["Rule_ID"]: {k: v for k, v in r.items() if k in total} for r in top} == whole


def test_slices_are_read_in_one_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    plan = Run(orders, packs.order_rules()).scorecard_by("year")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    with pytest.raises(ValueError, match="rename"):
        Run(orders.withColumnRenamed("year", "status"), packs.order_rules()).scorecard_by("status")


def test_a_lenient_run_by_slices(spark):
    df = housing_rows(spark, {"HOUSING_STARTS": -1.0}, {"GEO_CODE": "QC"}, {})
    rules = [one(c.non_negative("HOUSING_STARTS")), one(c.unique("GEO_CODE", "NOT_THERE"), "X-002"), one(c.max_value("ABSENT", 3), "X-003")]
    rows = {(r["GEO_CODE"], r["Rule_ID"]): r["Records_Failed"] for r in Run(df, rules, lenient=True).scorecard_by("GEO_CODE").collect()}
    assert rows == {("ON", "X-001"): 1, ("QC", "X-001"): 0, ("ON", "X-002"): 2, ("QC", "X-002"): 0, ("ON", "X-003"): 0, ("QC", "X-003"): 0}


def test_failures_per_record_equal_the_listed_ones(spark, sf_dir):
    lines = packs.lineitem(spark, sf_dir)
    rules = packs.lineitem_rules(spark, sf_dir)
    for some in (rules, [r for r in rules if r.rule_id != "LI-007"], [r for r in rules if r.rule_id in ("LI-007", "LI-010")]):
        run = Run(lines, some, as_of="2001-06")
        wanted = {r[0]: r[1] for r in run.annotated().groupBy(F.size("_failed_rules")).count().collect()}
        assert {r["rules_failed"]: r["records"] for r in run.failures_per_record().collect()} == wanted
    assert Run(lines.limit(0), rules, as_of="2001-06").failures_per_record().collect() == []
