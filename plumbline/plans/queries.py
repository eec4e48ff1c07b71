"""The operators bound to the test tables, one query per operator. Each takes (spark, folder of Parquet tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import contract as contracts
from plumbline.operators import explore, governance, profile, rca, scorecards
from plumbline.operators.checks import maps_to_table
from plumbline.operators.remediate import flag_counts, remediate, remediation_summary
from plumbline.operators.rule import rule_table
from plumbline.operators.run import Run
from plumbline.plans import governance_data as gov
from plumbline.plans import housing as pack
from plumbline.plans import packs
from plumbline.plans.fixture import housing, table
from plumbline.plans.housing_contract import DOMAIN_CHECKS, contract
from plumbline.session import configure, shared_dir
from plumbline.sources.outputs import export_columns
from plumbline.sources.tables import with_record_id
from plumbline.streaming.monitor import score_stream, scorecard_so_far, snapshot

AS_OF = "2026-12"
RUN_TS = "2026-12-01 00:00"
RUN_DATE = "2026-12-01"
DATASET = "housing_starts"
KEY = ["record_key"]
FILES_PER_BATCH = 4

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def housing_run(spark: SparkSession, sf_dir: str) -> Run:
    return Run(housing(spark, sf_dir), pack.rules(), as_of=AS_OF, run_ts=RUN_TS)


def upload_run(spark: SparkSession, sf_dir: str) -> Run:
    """The fixture as a user might hand it in, without its status and name columns."""
    df = housing(spark, sf_dir).drop("STATUS", "GEO")
    return Run(df, pack.upload_rules(), as_of=AS_OF, run_ts=RUN_TS, lenient=True)


def full_housing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sixteen columns, without the key."""
    return housing(spark, sf_dir, wide=True).drop("record_key")


# Rules and scorecards.


@query
def rule_scorecard(spark, sf_dir):
    return housing_run(spark, sf_dir).scorecard()


@query
def strict_scorecard(spark, sf_dir):
    """PASS only where nothing failed; in a large table a rounded rate of 100 hides a few failures."""
    df = packs.lineitem(spark, sf_dir)
    rules = [r for r in packs.lineitem_rules(spark, sf_dir) if r.rule_id in ("LI-001", "LI-007", "LI-011", "LI-012")]
    return Run(df, rules, as_of="2001-06", strict_pass=True).scorecard()


@query
def lineitem_scorecard(spark, sf_dir):
    return Run(packs.lineitem(spark, sf_dir), packs.lineitem_rules(spark, sf_dir), as_of="2001-06").scorecard()


@query
def lineitem_failures_per_line(spark, sf_dir):
    """How many rules a line fails, counted over all lines."""
    run = Run(packs.lineitem(spark, sf_dir), packs.lineitem_rules(spark, sf_dir), as_of="2001-06")
    return run.failures_per_record().withColumnRenamed("records", "lines")


@query
def conversation_scorecard(spark, sf_dir):
    return Run(table(spark, sf_dir, "conversations"), packs.turn_rules()).scorecard()


@query
def upload_scorecard(spark, sf_dir):
    return upload_run(spark, sf_dir).scorecard()


@query
def upload_summary(spark, sf_dir):
    return scorecards.run_summary(*upload_run(spark, sf_dir).scorecard_and_unique_failed())


@query
def by_dimension(spark, sf_dir):
    return scorecards.by_dimension(housing_run(spark, sf_dir).scorecard(), ordered=True)


@query
def by_cde(spark, sf_dir):
    return scorecards.by_cde(housing_run(spark, sf_dir).scorecard(), pack.CDE_RULES)


@query
def summary(spark, sf_dir):
    return scorecards.summary(housing_run(spark, sf_dir).scorecard(), DATASET, RUN_DATE)


@query
def run_summary(spark, sf_dir):
    return scorecards.run_summary(*housing_run(spark, sf_dir).scorecard_and_unique_failed())


@query
def executive(spark, sf_dir):
    score, found = housing_run(spark, sf_dir).scorecard_and_unique_failed()
    return explore.executive(scorecards.summary(score, DATASET, RUN_DATE), found)


@query
def executive_view(spark, sf_dir):
    """All parts come from one row of counts."""
    score, found = housing_run(spark, sf_dir).scorecard_and_unique_failed()
    head = scorecards.summary(score, DATASET, RUN_DATE)
    return explore.executive_view(score, head, scorecards.by_dimension(score), scorecards.by_cde(score, pack.CDE_RULES), found)


@query
def exception_pages(spark, sf_dir):
    return explore.pages(housing_run(spark, sf_dir).exceptions())


@query
def unique_failed(spark, sf_dir):
    return housing_run(spark, sf_dir).unique_failed()


# Exceptions and violations.


@query
def exceptions(spark, sf_dir):
    return housing_run(spark, sf_dir).exceptions()


def _violations(name: str, rule_id: str) -> None:
    def fn(spark, sf_dir):
        return housing_run(spark, sf_dir).violations(rule_id, KEY)

    fn.__name__ = name
    query(fn)


_violations("completeness", "DQ-001")
_violations("starts_non_negative", "DQ-002")
_violations("conditional_completeness", "DQ-003")
_violations("price_non_negative", "DQ-004")
_violations("price_ceiling", "DQ-005")
_violations("geo_code_domain", "DQ-006")
_violations("dwelling_domain", "DQ-007")
_violations("market_domain", "DQ-008")
_violations("month_format", "DQ-009")
_violations("housing_grain", "DQ-010")
_violations("month_not_future", "DQ-011")
_violations("status_domain", "DQ-012")
_violations("mapping_consistency", "DQ-015")


def rounded(listing: DataFrame) -> DataFrame:
    """Group statistics to four places, as sums of doubles depend on their order."""
    return listing.withColumns({c: F.round(c, 4) for c in ("group_mean", "group_std")})


@query
def sigma_starts(spark, sf_dir):
    return rounded(housing_run(spark, sf_dir).violations("DQ-013", KEY))


@query
def sigma_range(spark, sf_dir):
    return rounded(housing_run(spark, sf_dir).violations("DQ-014", KEY))


@query
def non_negative(spark, sf_dir):
    return Run(table(spark, sf_dir, "customer"), packs.customer_rules()).violations("CU-001", ["c_custkey"])


@query
def ceiling(spark, sf_dir):
    return Run(table(spark, sf_dir, "orders"), packs.order_rules()).violations("OR-001", ["o_orderkey"])


@query
def not_future(spark, sf_dir):
    run = Run(packs.lineitem(spark, sf_dir), packs.lineitem_rules(spark, sf_dir), as_of="2001-06")
    return run.violations("LI-006", ["l_orderkey", "l_linenumber"])


@query
def grain_unique(spark, sf_dir):
    run = Run(packs.lineitem(spark, sf_dir), packs.lineitem_rules(spark, sf_dir), as_of="2001-06")
    return run.violations("LI-007", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query
def duplicate_groups(spark, sf_dir):
    run = Run(packs.lineitem(spark, sf_dir), packs.lineitem_rules(spark, sf_dir), as_of="2001-06")
    return run.duplicate_groups("LI-007")


@query
def housing_duplicate_groups(spark, sf_dir):
    return housing_run(spark, sf_dir).duplicate_groups("DQ-010")


@query
def referential(spark, sf_dir):
    run = Run(table(spark, sf_dir, "documents"), packs.document_rules(spark, sf_dir))
    return run.violations("DO-001", ["doc_id"])


@query
def document_copies(spark, sf_dir):
    """Documents whose whole text occurs more than once."""
    run = Run(table(spark, sf_dir, "documents"), packs.document_rules(spark, sf_dir))
    return run.violations("DO-002", ["doc_id"])


@query
def referential_lines(spark, sf_dir):
    run = Run(packs.lineitem(spark, sf_dir), packs.lineitem_rules(spark, sf_dir), as_of="2001-06")
    return run.violations("LI-010", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query
def sigma_outlier(spark, sf_dir):
    return rounded(Run(table(spark, sf_dir, "events"), packs.event_rules()).violations("EV-001", ["event_id"]))


@query
def sigma_two_sided(spark, sf_dir):
    return rounded(Run(table(spark, sf_dir, "events"), packs.event_rules()).violations("EV-002", ["event_id"]))


@query
def compare_columns(spark, sf_dir):
    """Lines shipped before their order was placed."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    check = packs.compare("l_shipdate", ">=", "o_orderdate")
    early = Run(joined, [packs.rule("LO-001", "Shipped after order", "Consistency", "l_shipdate", check)])
    days = [F.col(c).cast("string").alias(c) for c in ("l_shipdate", "o_orderdate")]
    return early.failing_rows("LO-001").select("l_orderkey", "l_linenumber", "l_partkey", *days)


@query
def business_rules(spark, sf_dir):
    return Run(housing(spark, sf_dir, wide=True), packs.business_rules(), as_of=AS_OF).scorecard()


# Root causes.


def _causes(spark, sf_dir):
    run = housing_run(spark, sf_dir).only([rule_id for _, rule_id, _ in pack.ROOT_CAUSES])
    return rca.root_causes(run.exceptions(), pack.ROOT_CAUSES, {"year": F.substring("REF_DATE", 1, 4)})


@query
def root_causes(spark, sf_dir):
    return rca.ordered(_causes(spark, sf_dir))


@query
def top_causes(spark, sf_dir):
    return rca.top_causes(_causes(spark, sf_dir))


@query
def negative_balance_by_segment(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return rca.breakdown(customers, F.col("c_acctbal") < 0, "c_mktsegment")


# Remediation.


def _remediated(spark, sf_dir):
    return remediate(housing(spark, sf_dir), pack.rules(), pack.REMEDIATION, RUN_DATE, as_of=AS_OF)


@query
def remediated(spark, sf_dir):
    return export_columns(_remediated(spark, sf_dir))


@query
def remediation_totals(spark, sf_dir):
    return remediation_summary(_remediated(spark, sf_dir), pack.REMEDIATION)


@query
def remediation_flags(spark, sf_dir):
    return flag_counts(_remediated(spark, sf_dir))


# Contract.


@query
def contract_checks(spark, sf_dir):
    return contracts.validate(full_housing(spark, sf_dir), contract(), housing_run(spark, sf_dir).scorecard())


@query
def contract_checks_incomplete(spark, sf_dir):
    """The fixture without the descriptive columns, with a column too many and without the last rules' results."""
    results = housing_run(spark, sf_dir).scorecard().filter("Rule_ID < 'DQ-013'")
    return contracts.validate(housing(spark, sf_dir), contract(), results)


@query
def contract_verdict(spark, sf_dir):
    checks = contracts.validate(full_housing(spark, sf_dir), contract(), housing_run(spark, sf_dir).scorecard())
    return contracts.verdict(checks)


@query
def contract_invalid_values(spark, sf_dir):
    return contracts.invalid_values(full_housing(spark, sf_dir), contract())


@query
def tier_levels(spark, sf_dir):
    return contracts.tier_levels(housing_run(spark, sf_dir).scorecard(), contract())


@query
def dimension_levels(spark, sf_dir):
    return contracts.dimension_levels(housing_run(spark, sf_dir).scorecard(), contract())


# Profile. Quartiles are shown with four places, where interpolation between two-place values is exact.


@query
def profile_housing(spark, sf_dir):
    df = housing(spark, sf_dir).drop("record_key")
    return profile.column_profile(df, cdes=pack.CRITICAL_DATA_ELEMENTS, places=4)


@query
def profile_events(spark, sf_dir):
    return profile.column_profile(table(spark, sf_dir, "events"), places=4)


@query
def profile_parts(spark, sf_dir):
    return profile.column_profile(table(spark, sf_dir, "part"), places=4)


@query
def domain_validation(spark, sf_dir):
    return profile.domain_validation(full_housing(spark, sf_dir), DOMAIN_CHECKS)


@query
def profile_scorecard(spark, sf_dir):
    return profile.profile_scorecard(
        full_housing(spark, sf_dir), DOMAIN_CHECKS, pack.GRAIN, pack.CRITICAL_DATA_ELEMENTS, DATASET, RUN_DATE
    )


# Exploration.


@query
def rule_list(spark, sf_dir):
    found = explore.filter_rules(housing_run(spark, sf_dir).scorecard(), dimension="Validity", status="WARN")
    return explore.project_existing(found, explore.RULE_COLUMNS)


@query
def exception_list(spark, sf_dir):
    found = explore.filter_exceptions(housing_run(spark, sf_dir).exceptions(), dimension="Validity", geo="ON")
    return explore.project_existing(found, [*KEY, *explore.EXCEPTION_COLUMNS])


@query
def exception_totals(spark, sf_dir):
    return explore.exception_counts(housing_run(spark, sf_dir).exceptions())


@query
def filter_options(spark, sf_dir):
    return explore.options(housing_run(spark, sf_dir).exceptions(), "DWELLING_TYPE")


@query
def top_values(spark, sf_dir):
    return explore.top_values(table(spark, sf_dir, "events"), "event_type")


@query
def top_failing_codes(spark, sf_dir):
    return explore.top_values(housing_run(spark, sf_dir).exceptions(), "GEO_CODE")


@query
def failures_by_dwelling(spark, sf_dir):
    return explore.top_values(housing_run(spark, sf_dir).exceptions(), "DWELLING_TYPE", n=None)


@query
def exception_page(spark, sf_dir):
    rows = explore.project_existing(housing_run(spark, sf_dir).exceptions(), [*KEY, *explore.EXCEPTION_COLUMNS])
    return explore.page(rows, ["record_key", "_rule_id"], number=3)


@query
def exception_page_after(spark, sf_dir):
    rows = explore.project_existing(housing_run(spark, sf_dir).exceptions(), [*KEY, *explore.EXCEPTION_COLUMNS])
    return explore.page_after(rows, ["record_key", "_rule_id"], last=[500, "DQ-010"])


@query
def record_ids(spark, sf_dir):
    return with_record_id(table(spark, sf_dir, "orders"))


# Governance.


def _assignments(spark):
    return spark.createDataFrame(gov.ASSIGNMENTS, gov.ASSIGNMENT_SCHEMA)


@query
def escalation(spark, sf_dir):
    return governance.escalation(housing_run(spark, sf_dir).scorecard())


@query
def steward_load(spark, sf_dir):
    return governance.steward_load(housing_run(spark, sf_dir).scorecard(), _assignments(spark))


@query
def steward_routing(spark, sf_dir):
    run = housing_run(spark, sf_dir)
    routed = governance.route_exceptions(run.exceptions(), run.rule_table, _assignments(spark))
    return routed.select("record_key", "_rule_id", "CDE", "Data_Steward", "Review_Cycle")


@query
def threshold_compliance(spark, sf_dir):
    return governance.threshold_compliance(housing(spark, sf_dir), gov.LIMITS)


@query
def conformance(spark, sf_dir):
    return governance.conformance(housing(spark, sf_dir, wide=True), gov.DICTIONARY)


@query
def catalog_conformance(spark, sf_dir):
    return governance.catalog_conformance(full_housing(spark, sf_dir), gov.CATALOG_ROWS, gov.CATALOG_COLUMNS)


@query
def size_conformance(spark, sf_dir):
    return governance.size_conformance(full_housing(spark, sf_dir), gov.SIZES)


@query
def mapping_by_table(spark, sf_dir):
    """Orders whose status is not the one that their first line says, the mapping being a table as large as the orders."""
    lines = table(spark, sf_dir, "lineitem").filter("l_linenumber = 1")
    mapping = lines.groupBy("l_orderkey").agg(F.min("l_linestatus").alias("expected"))
    rule = packs.rule("OR-002", "Status follows first line", "Consistency", "o_orderkey + o_orderstatus",
                      maps_to_table("o_orderkey", "o_orderstatus", mapping, "l_orderkey", "expected"))
    return Run(table(spark, sf_dir, "orders"), [rule]).violations("OR-002", ["o_orderkey"])


@query
def cde_coverage(spark, sf_dir):
    cdes = spark.createDataFrame([(c,) for c in [*pack.CRITICAL_DATA_ELEMENTS, "UOM"]], "CDE string")
    return governance.cde_coverage(housing_run(spark, sf_dir).scorecard(), cdes)


@query
def uncovered_columns(spark, sf_dir):
    """Columns without a rule, with the nulls nobody watches."""
    df = full_housing(spark, sf_dir)
    free = governance.uncovered_columns(df.columns, rule_table(spark, pack.rules()))
    nulls = governance.conformance(df, gov.DICTIONARY).select(F.col("Column").alias("column"), "Null_Count")
    return free.join(F.broadcast(nulls), "column")


@query
def lineage_impact(spark, sf_dir):
    """Every upstream hop of the critical elements, with the failures found on the element."""
    edges = spark.createDataFrame(gov.EDGES, gov.EDGE_SCHEMA)
    hops = governance.trace(edges, spark.createDataFrame(gov.ROOTS, gov.ROOT_SCHEMA))
    found = governance.cde_coverage(
        housing_run(spark, sf_dir).scorecard(), edges.select(F.col("cde").alias("CDE")).distinct()
    ).select(F.col("CDE").alias("cde"), "Failures")
    return hops.join(F.broadcast(found), "cde")


# Streaming.


@query
def stream_scorecard(spark, sf_dir):
    """lineitem read as a stream of files and scored by batch; the scorecards of all batches together."""
    path = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    group = ("LI-007", "LI-010")
    rules = [r for r in packs.lineitem_rules(spark, sf_dir) if r.rule_id not in group]
    lines = table(spark, sf_dir, "lineitem")
    # written as a pattern, as only then a stream takes a path that is one file as well as one that is a folder of files
    files = f"{sf_dir}/lineitem.parque[t]"
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(files)
    score_stream(
        packs.with_month(stream),
        rules,
        path,
        as_of="2001-06",
        stats=snapshot(packs.lineitem(spark, sf_dir), rules),
        with_exceptions=False,
        availableNow=True,
    ).awaitTermination()
    return scorecard_so_far(spark, path)
