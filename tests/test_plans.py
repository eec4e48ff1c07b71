"""The shape of the plans: how often tables are read, what reaches the scan, what shuffles."""

import re

import pytest
from pyspark.sql import functions as F

from plumbline.operators import contract as contracts
from plumbline.operators import profile
from plumbline.operators.run import Run
from plumbline.plans import housing as pack
from plumbline.plans import packs
from plumbline.plans.fixture import housing, table
from plumbline.plans.housing_contract import DOMAIN_CHECKS, contract


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def run(spark, sf_dir):
    return Run(housing(spark, sf_dir), pack.rules(), as_of="2026-12", run_ts="t")


def test_row_rules_share_one_scan(run):
    local = run.only([r.rule_id for r in pack.rules() if r.rule_id != "DQ-010"])
    text = plan(local.scorecard())
    assert text.count("FileScan") == 1
    assert "SortMergeJoin" not in text


def test_uniqueness_is_tallied_from_its_keys(run):
    text = plan(run.only(["DQ-010"]).scorecard())
    assert text.count("FileScan") == 1
    assert re.search(r"ReadSchema: struct<REF_DATE:string,GEO_CODE:string,DWELLING_TYPE:string,INTENDED_MARKET:s", text)
    assert text.count("Exchange hashpartitioning") == 1


def test_distinct_failing_records_need_one_scan(run):
    text = plan(run.unique_failed())
    assert text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") == 1


def test_exceptions_do_not_shuffle(run):
    text = plan(run.exceptions())
    assert text.count("FileScan") == 1
    assert "Exchange hashpartitioning" not in text
    assert "Python" not in text and "lambda" not in text


def test_filters_reach_the_scan(spark, sf_dir, run):
    def pushed(df):
        return re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", plan(df))[0]

    assert "LessThan(HOUSING_STARTS,0.0)" in pushed(run.violations("DQ-002", ["record_key"]))
    assert "GreaterThan(AVERAGE_PRICE_CAD,2000000.0)" in pushed(run.violations("DQ-005", ["record_key"]))
    assert "GreaterThan(l_extendedprice,90000.0)" in pushed(
        Run(table(spark, sf_dir, "lineitem"), [packs.rule("X", "x", "x", "x", packs.max_value("l_extendedprice", 90000))]).failing_rows("X")
    )


def test_a_violation_listing_reads_its_columns_only(run):
    schema = re.findall(r"ReadSchema: struct<(.*?)>", plan(run.violations("DQ-002", ["record_key"])))
    assert schema == ["record_key:bigint,HOUSING_STARTS:double"]


def test_contract_values_share_one_scan(spark, sf_dir):
    text = plan(contracts.value_checks(housing(spark, sf_dir, wide=True), contract()))
    assert text.count("FileScan") == 1
    assert "Exchange SinglePartition" in text and "hashpartitioning" not in text


@pytest.mark.parametrize("approximate", [True, False])
def test_profile_reads_the_table_once_beside_what_it_stored(spark, sf_dir, approximate):
    text = plan(profile.column_profile(table(spark, sf_dir, "events"), ["event_type", "value"], approximate=approximate))
    assert text.count("FileScan") == 1 and "events.parquet" in text
    assert not re.search(r"[^a-z]Sort \[", text)


def test_profile_scorecard_reads_the_rows_once_beside_the_grain(spark, sf_dir):
    df = housing(spark, sf_dir, wide=True).drop("record_key")
    text = plan(profile.profile_scorecard(df, DOMAIN_CHECKS, pack.GRAIN, pack.CRITICAL_DATA_ELEMENTS, "d", "x"))
    assert text.count("FileScan") == 2


def test_summary_and_distinct_failures_share_one_grouping(run):
    score, found = run.scorecard_and_unique_failed()
    assert "hashpartitioning" not in plan(score) and "FileScan" not in plan(score)
    assert sorted(score.collect()) == sorted(run.scorecard().collect())
    assert found.collect() == run.unique_failed().collect()


def test_references_meet_after_counting(spark, sf_dir):
    run = Run(packs.lineitem(spark, sf_dir), packs.lineitem_rules(spark, sf_dir), as_of="2001-06").only(["LI-010"])
    text = plan(run.scorecard())
    join = min(i for i in (text.find("SortMergeJoin"), text.find("BroadcastHashJoin"), text.find("ShuffledHashJoin")) if i >= 0)
    assert "HashAggregate" in text[join:] and "count(1)" in text[join:]


def test_annotated_rows_keep_their_number(run):
    assert run.annotated().count() == 1500
    assert run.annotated().agg(F.sum(F.size("_failed_rules"))).first()[0] == run.exceptions().count()
