"""The data contract of the housing-starts table, as data. All names and numbers are fixed values."""

from __future__ import annotations

from typing import Any

from plumbline.operators.checks import in_domain, max_value, non_negative
from plumbline.operators.profile import DomainCheck
from plumbline.plans.housing import DWELLING_TYPES, GEO_CODES, MARKETS, STATUS_CODES, SURVEY_METHODS

# The ten provinces the contract allows by name; territories are allowed by code only.
CONTRACT_PROVINCES = [
    "Ontario", "Quebec", "British Columbia", "Alberta", "Manitoba", "Saskatchewan", "Nova Scotia", "New Brunswick",
    "Prince Edward Island", "Newfoundland and Labrador",
]

FIELDS: list[dict[str, Any]] = [
    {"name": "REF_DATE", "type": "string", "format": "YYYY-MM", "required": True},
    {"name": "GEO", "type": "string", "required": True, "validValues": CONTRACT_PROVINCES},
    {"name": "GEO_CODE", "type": "string", "required": True, "validValues": list(GEO_CODES.values())},
    {"name": "DWELLING_TYPE", "type": "string", "required": True, "validValues": list(DWELLING_TYPES)},
    {"name": "INTENDED_MARKET", "type": "string", "required": True, "validValues": list(MARKETS)},
    {"name": "HOUSING_STARTS", "type": "number", "required": False, "minimum": 0},
    {"name": "AVERAGE_PRICE_CAD", "type": "number", "required": False, "minimum": 0, "maximum": 2000000},
    {"name": "DATA_SOURCE", "type": "string", "required": True},
    {"name": "REPORTING_AGENCY", "type": "string", "required": True},
    {"name": "LAST_UPDATED", "type": "string", "required": True},
    {"name": "SURVEY_METHOD", "type": "string", "required": True},
    {"name": "GEOGRAPHY_TYPE", "type": "string", "required": True},
    {"name": "UOM", "type": "string", "required": True},
    {"name": "SCALAR_FACTOR", "type": "string", "required": True},
    {"name": "STATUS", "type": "string", "required": False, "validValues": ["E", "F", "r"]},
    {"name": "DECIMALS", "type": "integer", "required": True},
]

# Rule, field, tier, warn and critical threshold.
SERVICE_LEVELS = (
    ("DQ-001", "HOUSING_STARTS", 1, 99.0, 97.0),
    ("DQ-002", "HOUSING_STARTS", 1, 99.0, 97.0),
    ("DQ-003", "AVERAGE_PRICE_CAD", 1, 99.0, 97.0),
    ("DQ-004", "AVERAGE_PRICE_CAD", 1, 99.0, 97.0),
    ("DQ-005", "AVERAGE_PRICE_CAD", 1, 100.0, 97.0),
    ("DQ-006", "GEO_CODE", 1, 100.0, 97.0),
    ("DQ-007", "DWELLING_TYPE", 1, 100.0, 97.0),
    ("DQ-008", "INTENDED_MARKET", 1, 100.0, 97.0),
    ("DQ-009", "REF_DATE", 1, 100.0, 97.0),
    ("DQ-010", "REF_DATE+GEO_CODE+DWELLING_TYPE+INTENDED_MARKET", 1, 100.0, 97.0),
    ("DQ-011", "REF_DATE", 1, 100.0, 97.0),
    ("DQ-012", "STATUS", 2, 97.0, 95.0),
    ("DQ-013", "HOUSING_STARTS", 1, 99.0, 97.0),
    ("DQ-014", "AVERAGE_PRICE_CAD", 1, 99.0, 97.0),
    ("DQ-015", "GEO+GEO_CODE", 1, 100.0, 97.0),
)

# Thresholds by tier, and by dimension and tier.
TIERS = {
    "tier1": {"warnThreshold": 99.0, "criticalThreshold": 97.0},
    "tier2": {"warnThreshold": 97.0, "criticalThreshold": 95.0},
}
DIMENSION_LEVELS = [
    {"dimension": "completeness", "tier1": {"warn": 99.0, "critical": 97.0}, "tier2": {"warn": 97.0, "critical": 95.0}},
    {"dimension": "validity", "tier1": {"warn": 99.0, "critical": 97.0}, "tier2": {"warn": 97.0, "critical": 95.0}},
    {"dimension": "uniqueness", "tier1": {"warn": 99.0, "critical": 97.0}},
    {"dimension": "accuracy", "tier1": {"warn": 99.0, "critical": 97.0}},
    {"dimension": "consistency", "tier1": {"warn": 99.0, "critical": 97.0}},
]


def contract(columns: tuple[str, ...] | None = None) -> dict[str, Any]:
    """The contract; with `columns`, reduced to those fields."""
    levels = [
        {"ruleId": rule, "field": field, "tier": tier, "warnThreshold": warn, "criticalThreshold": critical}
        for rule, field, tier, warn, critical in SERVICE_LEVELS
    ]
    fields = [f for f in FIELDS if columns is None or f["name"] in columns]
    quality = {"tiers": TIERS, "dimensions": DIMENSION_LEVELS, "rules": levels}
    return {"schema": {"type": "table", "fields": fields}, "quality": quality}


# The eight domain checks of the profile.
DOMAIN_CHECKS = (
    DomainCheck("GEO_CODE", "Invalid province/territory code", in_domain("GEO_CODE", GEO_CODES.values())),
    DomainCheck("DWELLING_TYPE", "Invalid dwelling type", in_domain("DWELLING_TYPE", DWELLING_TYPES)),
    DomainCheck("INTENDED_MARKET", "Invalid intended market", in_domain("INTENDED_MARKET", MARKETS)),
    DomainCheck("STATUS", "Invalid status code", in_domain("STATUS", STATUS_CODES, null_as="")),
    DomainCheck("SURVEY_METHOD", "Invalid survey method", in_domain("SURVEY_METHOD", SURVEY_METHODS, null_passes=True)),
    DomainCheck("HOUSING_STARTS", "Negative housing starts", non_negative("HOUSING_STARTS")),
    DomainCheck("AVERAGE_PRICE_CAD", "Negative average price", non_negative("AVERAGE_PRICE_CAD")),
    DomainCheck("AVERAGE_PRICE_CAD", "Price exceeds $10M ceiling", max_value("AVERAGE_PRICE_CAD", 10_000_000)),
)
