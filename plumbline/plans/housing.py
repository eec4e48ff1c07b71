"""The housing-starts pack: fifteen rules over monthly housing starts, as data.

Everything in this file that is text or a number is a fixed value: names, domains, thresholds and messages are what
results are compared by.
"""

from __future__ import annotations

from dataclasses import dataclass

from plumbline.operators.checks import (
    in_domain,
    maps_to,
    matches,
    max_value,
    non_negative,
    not_after,
    not_null,
    sigma_outlier,
    unique,
)
from plumbline.operators.rule import Rule

# The columns an uploaded table must have, and the grain.
REQUIRED_COLUMNS = (
    "REF_DATE", "GEO", "GEO_CODE", "DWELLING_TYPE", "INTENDED_MARKET", "HOUSING_STARTS", "AVERAGE_PRICE_CAD",
)
GRAIN = ("REF_DATE", "GEO_CODE", "DWELLING_TYPE", "INTENDED_MARKET")

# Province and territory names with their codes, and the other domains.
GEO_CODES = {
    "Ontario": "ON",
    "British Columbia": "BC",
    "Alberta": "AB",
    "Quebec": "QC",
    "Manitoba": "MB",
    "Saskatchewan": "SK",
    "Nova Scotia": "NS",
    "New Brunswick": "NB",
    "Newfoundland and Labrador": "NL",
    "Prince Edward Island": "PE",
    "Northwest Territories": "NT",
    "Yukon": "YT",
    "Nunavut": "NU",
}
DWELLING_TYPES = (
    "Single-Detached", "Semi-Detached", "Row House", "Apartment - 5+ storeys", "Apartment - Under 5 storeys",
)
MARKETS = ("Homeowner", "Rental", "Condominium")
STATUS_CODES = ("", "E", "F", "r")
SURVEY_METHODS = ("Direct Survey", "Administrative Data", "Modelled Estimate")

# Thresholds and the month pattern.
PRICE_CEILING = 2_000_000
STARTS_CAP = 20_000
PRICE_FLOOR, PRICE_CAP = 100_000, 3_000_000
MONTH_PATTERN = "^[0-9]{4}-[0-9]{2}$"


def rules(price_ceiling: float = PRICE_CEILING, null_month_is_future: bool = True) -> list[Rule]:
    """The fifteen rules. Ids, names, dimensions, elements, descriptions, severities and actions."""
    return [
        Rule(
            "DQ-001", "Housing Starts Completeness", "Completeness", "HOUSING_STARTS",
            "HOUSING_STARTS must not be NULL.",
            "High",
            "Escalate to Data Steward. Attempt back-fill from source permit system. If unavailable, flag STATUS='F'.",
            not_null("HOUSING_STARTS"),
        ),
        Rule(
            "DQ-002", "Housing Starts Non-Negative", "Validity", "HOUSING_STARTS",
            "HOUSING_STARTS must be >= 0. Negative values are physically impossible.",
            "Critical",
            "Root cause: manual data entry error in source permit system. Remediation: take absolute value and flag "
            "record for steward review.",
            non_negative("HOUSING_STARTS"),
            "HOUSING_STARTS cannot be negative",
        ),
        Rule(
            "DQ-003", "Average Price Completeness", "Completeness", "AVERAGE_PRICE_CAD",
            "AVERAGE_PRICE_CAD must not be NULL on non-suppressed records.",
            "Medium",
            "Escalate to Data Steward. Re-run price survey aggregation for affected period/geography.",
            not_null("AVERAGE_PRICE_CAD", unless=("STATUS", "F"), STATUS=""),
            "AVERAGE_PRICE_CAD is NULL on non-suppressed record",
        ),
        Rule(
            "DQ-004", "Average Price Non-Negative", "Validity", "AVERAGE_PRICE_CAD",
            "AVERAGE_PRICE_CAD must be > 0. Negative prices are invalid.",
            "Critical",
            "Root cause: sign-flip error during CPI adjustment. Remediation: take absolute value and reprocess through "
            "price adjustment pipeline.",
            non_negative("AVERAGE_PRICE_CAD"),
        ),
        Rule(
            "DQ-005", "Average Price Ceiling Check", "Validity", "AVERAGE_PRICE_CAD",
            f"AVERAGE_PRICE_CAD must not exceed ${price_ceiling:,.0f}.",
            "Medium",
            "Escalate to Data Owner for manual review. Likely data entry error or unit mismatch.",
            max_value("AVERAGE_PRICE_CAD", price_ceiling),
            f"AVERAGE_PRICE_CAD exceeds ${price_ceiling:,.0f} ceiling",
        ),
        Rule(
            "DQ-006", "GEO_CODE Referential Integrity", "Validity", "GEO_CODE",
            "GEO_CODE must be a valid Canadian province/territory code.",
            "High",
            "Lookup correct GEO_CODE from Statistics Canada geographic reference table.",
            in_domain("GEO_CODE", GEO_CODES.values(), GEO_CODE=""),
            "GEO_CODE is not a valid Canadian province/territory code",
        ),
        Rule(
            "DQ-007", "Dwelling Type Domain Validity", "Validity", "DWELLING_TYPE",
            "DWELLING_TYPE must be one of 5 approved categories.",
            "High",
            "Map to nearest approved dwelling type using reference lookup table. Escalate if ambiguous.",
            in_domain("DWELLING_TYPE", DWELLING_TYPES),
            "DWELLING_TYPE is not in the approved domain list",
        ),
        Rule(
            "DQ-008", "Intended Market Domain Validity", "Validity", "INTENDED_MARKET",
            "INTENDED_MARKET must be one of: Homeowner, Rental, Condominium.",
            "High",
            "Map to approved value using permit application reference data.",
            in_domain("INTENDED_MARKET", MARKETS),
            "INTENDED_MARKET is not in approved domain list",
        ),
        Rule(
            "DQ-009", "Reference Date Format", "Validity", "REF_DATE",
            "REF_DATE must follow YYYY-MM format.",
            "Medium",
            "Reformat to YYYY-MM using date parsing. Reject if year or month is out of valid range.",
            matches("REF_DATE", MONTH_PATTERN),
            "REF_DATE does not match YYYY-MM format",
        ),
        Rule(
            "DQ-010", "Grain Uniqueness", "Uniqueness", "REF_DATE+GEO_CODE+DWELLING_TYPE+INTENDED_MARKET",
            "Each grain combination must be unique.",
            "High",
            "Identify source of duplicate load. Remove duplicate keeping most recent record. Investigate ETL pipeline.",
            unique(*GRAIN),
            "Duplicate grain combination detected",
        ),
        Rule(
            "DQ-011", "Reference Date Not Future", "Validity", "REF_DATE",
            "REF_DATE must not be after the current month.",
            "Medium",
            "Remove future-dated records. Investigate source system for clock/date errors.",
            not_after("REF_DATE", null_fails=null_month_is_future),
            "REF_DATE is a future date",
        ),
        Rule(
            "DQ-012", "Status Code Validity", "Validity", "STATUS",
            "STATUS must be blank, 'E', 'F', or 'r'.",
            "Low",
            "Map to nearest valid status code. Blank (final) is default.",
            in_domain("STATUS", STATUS_CODES, null_as="", STATUS=""),
            "STATUS is not a recognized quality code",
        ),
        Rule(
            "DQ-013", "Housing Starts Accuracy — Statistical Range", "Accuracy", "HOUSING_STARTS",
            "HOUSING_STARTS must not exceed 20,000 or mean + 3 std dev for its province. Extreme outliers flagged for "
            "steward review.",
            "High",
            "Escalate to Data Steward. Cross-reference with municipal permit office records to confirm or correct value.",
            sigma_outlier("HOUSING_STARTS", by="GEO_CODE", high=STARTS_CAP, places=0),
            "HOUSING_STARTS exceeds statistical plausibility threshold for this province",
        ),
        Rule(
            "DQ-014", "Average Price Accuracy — Statistical Range", "Accuracy", "AVERAGE_PRICE_CAD",
            "AVERAGE_PRICE_CAD must be between $100,000 and $3,000,000 and not exceed mean + 3 std dev for its province.",
            "High",
            "Escalate to Data Steward. Verify against price survey raw data for the affected province and period.",
            sigma_outlier(
                "AVERAGE_PRICE_CAD", by="GEO_CODE", low=PRICE_FLOOR, high=PRICE_CAP,
                reasons=(
                    "Price below $100,000 minimum threshold",
                    "Price exceeds $3,000,000 maximum threshold",
                    "Price exceeds mean + 3 std dev for this province",
                ),
            ),
        ),
        Rule(
            "DQ-015", "GEO and GEO_CODE Consistency", "Consistency", "GEO + GEO_CODE",
            "GEO (full province name) and GEO_CODE (2-letter code) must always refer to the same province. Any mismatch "
            "indicates a data entry or join error.",
            "Critical",
            "Correct GEO_CODE using the authoritative GEO-to-GEO_CODE lookup table. Investigate source join logic.",
            maps_to("GEO", "GEO_CODE", GEO_CODES),
            "GEO name and GEO_CODE refer to different provinces",
        ),
    ]


# Texts that differ when the pack runs on an uploaded table.
UPLOAD_ACTION = "Review flagged records and correct source data."
UPLOAD_DESCRIPTIONS = {
    "DQ-010": "Each grain combination (REF_DATE + GEO_CODE + DWELLING_TYPE + INTENDED_MARKET) must be unique.",
    "DQ-013": "HOUSING_STARTS must not exceed 20,000 or mean + 3 std dev for its province.",
    "DQ-015": "GEO (full province name) and GEO_CODE (2-letter code) must always refer to the same province.",
}


def upload_rules() -> list[Rule]:
    """The pack as it runs on an uploaded table; use with lenient=True."""
    return [
        r.with_(description=UPLOAD_DESCRIPTIONS.get(r.rule_id, r.description), remediation=UPLOAD_ACTION)
        for r in rules()
    ]


@dataclass(frozen=True)
class Step:
    """A step of remediation: correct a column of the rows that fail a rule, or only flag them."""

    rule_id: str
    text: str
    correct: str | None = None  # column to replace by its absolute value


# The order of the steps and the flag texts.
REMEDIATION = (
    Step("DQ-002", "DQ-002: Negative value corrected to absolute", correct="HOUSING_STARTS"),
    Step("DQ-004", "DQ-004: Negative price corrected", correct="AVERAGE_PRICE_CAD"),
    Step("DQ-001", "DQ-001: NULL flagged for steward review"),
    Step("DQ-003", "DQ-003: NULL price flagged for steward review"),
    Step("DQ-013", "DQ-013: Statistical outlier flagged for steward review"),
    Step("DQ-014", "DQ-014: Price accuracy outlier flagged for steward review"),
)

# Breakdown name, rule, and the key that its failures are counted by ("year" is the first four
# characters of REF_DATE).
ROOT_CAUSES = (
    ("negative_starts_by_province", "DQ-002", "GEO_CODE"),
    ("null_starts_by_year", "DQ-001", "year"),
    ("negative_price_by_dwelling", "DQ-004", "DWELLING_TYPE"),
    ("accuracy_outliers_by_province", "DQ-013", "GEO_CODE"),
    ("price_accuracy_outliers_by_province", "DQ-014", "GEO_CODE"),
)

# The rules that count towards each critical data element.
CDE_RULES = {
    "HOUSING_STARTS": ("DQ-001", "DQ-002", "DQ-013"),
    "AVERAGE_PRICE_CAD": ("DQ-003", "DQ-004", "DQ-005", "DQ-014"),
    "GEO + GEO_CODE": ("DQ-006", "DQ-015"),
    "DWELLING_TYPE": ("DQ-007",),
    "INTENDED_MARKET": ("DQ-008",),
    "REF_DATE": ("DQ-009", "DQ-011"),
}
CRITICAL_DATA_ELEMENTS = (
    "REF_DATE", "GEO", "DWELLING_TYPE", "INTENDED_MARKET", "HOUSING_STARTS", "AVERAGE_PRICE_CAD",
)
