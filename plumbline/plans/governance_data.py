"""Governance tables for the housing pack. Elements, owners, thresholds, declared types.

The lineage edges are a sample of their own, with plain names for systems; a site hands in its own edge table.
"""

from __future__ import annotations

from plumbline.operators.governance import ESCALATION, Limit
from plumbline.operators.rule import Scope
from plumbline.plans.housing import DWELLING_TYPES, GEO_CODES, MARKETS, MONTH_PATTERN

_OWNER = "VP Housing Market Analytics"
_STEWARD = "Senior DQ Analyst, Housing Market Analytics"
_CUSTODIAN = "Enterprise Data Engineer, IT"

ASSIGNMENT_SCHEMA = "CDE string, Data_Owner string, Data_Steward string, Data_Custodian string, Review_Cycle string"
ASSIGNMENTS = [
    ("HOUSING_STARTS", _OWNER, _STEWARD, _CUSTODIAN, "Monthly"),
    ("AVERAGE_PRICE_CAD", _OWNER, _STEWARD, _CUSTODIAN, "Monthly"),
    ("GEO / GEO_CODE", _OWNER, _STEWARD, _CUSTODIAN, "Quarterly"),
    ("REF_DATE", _OWNER, _STEWARD, _CUSTODIAN, "Monthly"),
    ("DWELLING_TYPE", _OWNER, _STEWARD, _CUSTODIAN, "Quarterly"),
    ("INTENDED_MARKET", _OWNER, _STEWARD, _CUSTODIAN, "Quarterly"),
]


def _outside(column, values):
    return lambda scope: scope.missing(column) | ~scope.col(column).isin(list(values))


def _is_null(column):
    return lambda scope: scope.missing(column)


def _negative(column):
    return lambda scope: scope.col(column) < 0


def _bad_month(scope: Scope):
    return ~scope.col("REF_DATE").rlike(MONTH_PATTERN)


LIMITS = (
    Limit("HOUSING_STARTS", "< 1% null", _is_null("HOUSING_STARTS"), 1, strict=True),
    Limit("HOUSING_STARTS", "0% negative", _negative("HOUSING_STARTS")),
    Limit("AVERAGE_PRICE_CAD", "< 2% null", _is_null("AVERAGE_PRICE_CAD"), 2, strict=True),
    Limit("AVERAGE_PRICE_CAD", "0% negative", _negative("AVERAGE_PRICE_CAD")),
    Limit("GEO / GEO_CODE", "0% invalid values", _outside("GEO_CODE", GEO_CODES.values())),
    Limit("REF_DATE", "0% null", _is_null("REF_DATE")),
    Limit("REF_DATE", "0% invalid format", _bad_month),
    Limit("DWELLING_TYPE", "0% invalid domain values", _outside("DWELLING_TYPE", DWELLING_TYPES)),
    Limit("INTENDED_MARKET", "0% invalid domain values", _outside("INTENDED_MARKET", MARKETS)),
)

# The declared type family of each column and whether it may be null.
DICTIONARY = (
    ("REF_DATE", "text", False),
    ("GEO", "text", False),
    ("GEO_CODE", "text", False),
    ("DWELLING_TYPE", "text", False),
    ("INTENDED_MARKET", "text", False),
    ("HOUSING_STARTS", "integer", True),
    ("AVERAGE_PRICE_CAD", "decimal", True),
    ("DATA_SOURCE", "text", False),
    ("REPORTING_AGENCY", "text", False),
    ("LAST_UPDATED", "date", False),
    ("SURVEY_METHOD", "text", True),
    ("GEOGRAPHY_TYPE", "text", False),
    ("UOM", "text", False),
    ("SCALAR_FACTOR", "text", False),
    ("STATUS", "text", True),
    ("DECIMALS", "text", False),
)

# The declared number of rows and columns, and the sizes of texts and decimals.
CATALOG_ROWS, CATALOG_COLUMNS = 10_800, 16
SIZES = (
    ("REF_DATE", 7, None), ("GEO", 100, None), ("GEO_CODE", 2, None), ("DWELLING_TYPE", 50, None), ("INTENDED_MARKET", 20, None),
    ("AVERAGE_PRICE_CAD", 12, 2), ("DATA_SOURCE", 100, None), ("REPORTING_AGENCY", 100, None), ("SURVEY_METHOD", 30, None),
    ("GEOGRAPHY_TYPE", 30, None), ("UOM", 20, None), ("SCALAR_FACTOR", 10, None), ("STATUS", 2, None), ("DECIMALS", 2, None),
)

EDGE_SCHEMA = "cde string, src_system string, src_field string, dst_system string, dst_field string"
EDGES = [
    ("HOUSING_STARTS", "Permit Offices", "PERMIT_CONSTRUCTION_START_DATE", "Staging", "HOUSING_STARTS"),
    ("HOUSING_STARTS", "Staging", "HOUSING_STARTS", "Public Repository", "HOUSING_STARTS"),
    ("AVERAGE_PRICE_CAD", "Price Survey", "TRANSACTION_PRICE_CAD", "Staging", "AVERAGE_PRICE_CAD"),
    ("GEO", "Geographic Reference", "PROV_TERR_NAME", "Staging", "GEO"),
    ("GEO_CODE", "Geographic Reference", "PROV_TERR_CODE", "Staging", "GEO_CODE"),
    ("REF_DATE", "Market Survey", "SURVEY_PERIOD_YEAR + SURVEY_PERIOD_MONTH", "Staging", "REF_DATE"),
    ("DWELLING_TYPE", "Permit Registry", "STRUCTURE_TYPE_CODE", "Staging", "DWELLING_TYPE"),
    ("INTENDED_MARKET", "Permit Registry", "MARKET_SEGMENT_CODE", "Staging", "INTENDED_MARKET"),
]
ROOT_SCHEMA = "cde string, system string, field string"
ROOTS = [
    ("HOUSING_STARTS", "Public Repository", "HOUSING_STARTS"),
    ("AVERAGE_PRICE_CAD", "Staging", "AVERAGE_PRICE_CAD"),
    ("GEO", "Staging", "GEO"),
    ("GEO_CODE", "Staging", "GEO_CODE"),
    ("REF_DATE", "Staging", "REF_DATE"),
    ("DWELLING_TYPE", "Staging", "DWELLING_TYPE"),
    ("INTENDED_MARKET", "Staging", "INTENDED_MARKET"),
]

# The severity bands as a table; a bound belongs to the band above it unless the one below takes it in.
BAND_SCHEMA = "Issue_Severity string, From_Pct string, To_Pct string, To_Included string, First_Responder string, Resolution_Target string, Escalate_To string"
BANDS = [
    (
        name,
        str(begin),
        str(ESCALATION[i + 1][1]) if i + 1 < len(ESCALATION) else None,
        "true" if i + 2 == len(ESCALATION) else "false",
        who,
        target,
        to,
    )
    for i, (name, begin, who, target, to) in enumerate(ESCALATION)
]

# The layers between source and use, with plain names for systems: an element is a whole asset, a field the asset's name.
SYSTEM_EDGES = [
    ("Housing Starts", "1 - Permit Offices", "Permit Records", "2 - Ingestion Portal", "Staging Table"),
    ("Housing Starts", "1 - Field Survey", "Survey Responses", "2 - Ingestion Portal", "Staging Table"),
    ("Housing Starts", "2 - Ingestion Portal", "Staging Table", "3 - Quality Engine", "Validated Table"),
    ("Housing Starts", "3 - Quality Engine", "Validated Table", "4 - Public Repository", "Public Dataset"),
    ("Housing Starts", "3 - Quality Engine", "Validated Table", "3 - Data Catalog", "Catalog Entry"),
    ("Housing Starts", "4 - Public Repository", "Public Dataset", "5 - Market Dashboard", "Dashboard"),
    ("Housing Starts", "4 - Public Repository", "Public Dataset", "5 - Policy Reporting", "Annual Report"),
]
SYSTEM_ROOTS = [("Housing Starts", "5 - Market Dashboard", "Dashboard"), ("Housing Starts", "5 - Policy Reporting", "Annual Report"), ("Housing Starts", "3 - Data Catalog", "Catalog Entry")]
