"""Small packs over the other test tables, each using the same checks as the housing pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.checks import (
    Bounds,
    compare,
    in_domain,
    in_reference,
    maps_to,
    matches,
    max_value,
    non_negative,
    not_after,
    not_null,
    sigma_outlier,
    unique,
    where,
)
from plumbline.operators.rule import Rule
from plumbline.plans.fixture import table


def rule(rule_id: str, name: str, dimension: str, cde: str, check, severity: str = "Medium") -> Rule:
    return Rule(rule_id, name, dimension, cde, f"{name} on {cde}.", severity, "Review flagged records.", check)


def with_month(lines: DataFrame) -> DataFrame:
    """lineitem with its ship month as text."""
    # Built from its parts, which is much faster than cutting the text form of a timestamp.
    month = F.lpad(F.month("l_shipdate").cast("string"), 2, "0")
    return lines.withColumn("ship_month", F.concat_ws("-", F.year("l_shipdate").cast("string"), month))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_month(table(spark, sf_dir, "lineitem"))


def lineitem_rules(spark: SparkSession, sf_dir: str) -> list[Rule]:
    return [
        rule("LI-001", "Quantity present", "Completeness", "l_quantity", not_null("l_quantity")),
        rule("LI-002", "Discount range", "Validity", "l_discount", Bounds("l_discount", low=0.01, high=0.09)),
        rule("LI-003", "Price ceiling", "Validity", "l_extendedprice", max_value("l_extendedprice", 90000)),
        rule("LI-004", "Return flag domain", "Validity", "l_returnflag", in_domain("l_returnflag", ["A", "N"])),
        rule("LI-005", "Ship month format", "Validity", "ship_month", matches("ship_month", "^[0-9]{4}-[0-9]{2}$")),
        rule("LI-006", "Ship month not future", "Validity", "ship_month", not_after("ship_month")),
        rule("LI-007", "Line grain", "Uniqueness", "l_orderkey+l_linenumber", unique("l_orderkey", "l_linenumber")),
        rule(
            "LI-008", "Price range", "Accuracy", "l_extendedprice", sigma_outlier("l_extendedprice", by="l_linenumber", k=2)
        ),
        rule(
            "LI-009",
            "Flag and status agree",
            "Consistency",
            "l_returnflag + l_linestatus",
            maps_to("l_returnflag", "l_linestatus", {"A": "F", "R": "F"}),
        ),
        rule(
            "LI-010",
            "Customer order known",
            "Consistency",
            "l_orderkey",
            in_reference("l_orderkey", table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'"), "o_orderkey"),
        ),
        rule("LI-011", "Tax below discount", "Consistency", "l_tax + l_discount", compare("l_tax", "<=", "l_discount")),
        rule("LI-012", "Small bulk lines", "Accuracy", "l_quantity", where("l_quantity > 45 AND l_extendedprice < 20000")),
    ]


def business_rules() -> list[Rule]:
    """Cross-column rules of the housing dictionary; they need the full sixteen columns."""
    return [
        rule(
            "BR-001",
            "Updated after reference month",
            "Consistency",
            "LAST_UPDATED",
            where("substr(LAST_UPDATED, 1, 7) < REF_DATE", ["LAST_UPDATED", "REF_DATE"]),
        ),
        rule("BR-002", "Updated not in the future", "Validity", "LAST_UPDATED", not_after("LAST_UPDATED", "2026-12-31")),
        rule(
            "BR-003", "Price above starts", "Consistency", "AVERAGE_PRICE_CAD", compare("AVERAGE_PRICE_CAD", ">", "HOUSING_STARTS")
        ),
        rule(
            "BR-004",
            "Unit matches scalar",
            "Consistency",
            "UOM + SCALAR_FACTOR",
            maps_to("UOM", "SCALAR_FACTOR", {"Units": "units", "Thousands of Units": "thousands"}),
        ),
        rule("BR-005", "Starts ceiling", "Validity", "HOUSING_STARTS", max_value("HOUSING_STARTS", 99999)),
        rule(
            "BR-006", "Named area has a code", "Completeness", "GEO_CODE", where("GEO IS NOT NULL AND GEO_CODE IS NULL", ["GEO", "GEO_CODE"])
        ),
        rule("BR-007", "Survey method domain", "Validity", "SURVEY_METHOD",
             in_domain("SURVEY_METHOD", ["Direct Survey", "Administrative Data", "Modelled Estimate"], null_passes=True)),
    ]


def customer_rules() -> list[Rule]:
    return [rule("CU-001", "Balance not negative", "Validity", "c_acctbal", non_negative("c_acctbal"))]


def order_rules() -> list[Rule]:
    return [rule("OR-001", "Order price ceiling", "Validity", "o_totalprice", max_value("o_totalprice", 400000))]


def document_rules(spark: SparkSession, sf_dir: str) -> list[Rule]:
    return [
        rule("DO-001", "Document is labelled", "Consistency", "doc_id", in_reference("doc_id", table(spark, sf_dir, "labels"), "doc_id")),
        rule("DO-002", "Text occurs once", "Uniqueness", "text", unique("text", digest=True)),
    ]


def event_rules() -> list[Rule]:
    return [
        rule("EV-001", "Value range", "Accuracy", "value", sigma_outlier("value", by="event_type", high=300)),
        rule("EV-002", "Value band", "Accuracy", "value", sigma_outlier("value", by="event_type", k=1.5, two_sided=True)),
    ]


def turn_rules() -> list[Rule]:
    return [
        rule("CO-001", "Role domain", "Validity", "role", in_domain("role", ["user", "assistant"])),
        rule("CO-002", "Turn grain", "Uniqueness", "conv_id+turn", unique("conv_id", "turn")),
        rule("CO-003", "Reply occurs once", "Uniqueness", "text", unique("text", digest=True)),
    ]
