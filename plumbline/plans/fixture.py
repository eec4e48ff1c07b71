"""The table the housing pack is tried on: one row per order, joined to its customer, with faults worked in.

The test tables have no nulls and no bad codes, so `k % m = r` decides which orders get which fault; every order is kept.
The text is portable SQL, so that Spark and the checking engine build the same rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from plumbline.plans.housing import GEO_CODES
from plumbline.session import file_states, is_there, shared_dir

WIDE_COLUMNS = (
    "DATA_SOURCE", "REPORTING_AGENCY", "LAST_UPDATED", "SURVEY_METHOD", "GEOGRAPHY_TYPE", "UOM", "SCALAR_FACTOR",
    "DECIMALS",
)

MONTH = "concat(cast(year(o_orderdate) AS string), '-', lpad(cast(month(o_orderdate) AS string), 2, '0'))"


def _nth(index: str, values) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {cases} END"


def housing_sql(orders: str = "orders", customer: str = "customer", wide: bool = False) -> str:
    k = "o_orderkey"
    extra = f""",
      CASE WHEN {k} % 463 = 16 THEN NULL ELSE 'Housing Market Survey' END AS DATA_SOURCE,
      'National Housing Agency' AS REPORTING_AGENCY,
      CASE WHEN {k} % 431 = 9 THEN '1990-01-15' WHEN {k} % 433 = 10 THEN '2999-12-31'
           ELSE concat({MONTH}, '-28') END AS LAST_UPDATED,
      CASE WHEN {k} % 443 = 12 THEN 'Phone Poll' WHEN {k} % 3 = 0 THEN 'Direct Survey'
           WHEN {k} % 3 = 1 THEN 'Administrative Data' ELSE 'Modelled Estimate' END AS SURVEY_METHOD,
      'Province/Territory' AS GEOGRAPHY_TYPE,
      CASE WHEN {k} % 457 = 14 THEN 'Thousands of Units' ELSE 'Units' END AS UOM,
      CASE WHEN {k} % 461 = 15 THEN 'thousands' ELSE 'units' END AS SCALAR_FACTOR,
      0 AS DECIMALS"""
    return f"""
    SELECT {k} AS record_key,
      CASE WHEN {k} % 997 = 5 THEN NULL WHEN {k} % 307 = 7 THEN '2999-01'
           WHEN {k} % 211 = 3 THEN replace({MONTH}, '-', '/') ELSE {MONTH} END AS REF_DATE,
      {_nth("c_nationkey % 13", GEO_CODES)} AS GEO,
      CASE WHEN {k} % 887 = 11 THEN NULL WHEN {k} % 503 = 13 THEN 'XX'
           WHEN {k} % 401 = 17 THEN {_nth("(c_nationkey + 1) % 13", GEO_CODES.values())}
           ELSE {_nth("c_nationkey % 13", GEO_CODES.values())} END AS GEO_CODE,
      CASE WHEN {k} % 601 = 19 THEN 'Duplex' WHEN o_orderpriority = '1-URGENT' THEN 'Single-Detached'
           WHEN o_orderpriority = '2-HIGH' THEN 'Semi-Detached' WHEN o_orderpriority = '3-MEDIUM' THEN 'Row House'
           WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Apartment - 5+ storeys'
           ELSE 'Apartment - Under 5 storeys' END AS DWELLING_TYPE,
      CASE WHEN {k} % 701 = 23 THEN NULL WHEN o_orderstatus = 'F' THEN 'Homeowner'
           WHEN o_orderstatus = 'O' THEN 'Rental' ELSE 'Condominium' END AS INTENDED_MARKET,
      cast(CASE WHEN {k} % 53 = 1 THEN NULL WHEN {k} % 37 = 2 THEN -floor(o_totalprice / 400)
           WHEN {k} % 149 = 4 THEN 9000 WHEN {k} % 1999 = 6 THEN 25000
           ELSE floor(o_totalprice / 400) END AS double) AS HOUSING_STARTS,
      cast(CASE WHEN {k} % 61 = 1 THEN NULL WHEN {k} % 91 = 2 THEN -(o_totalprice + 100000)
           WHEN {k} % 1499 = 3 THEN 2500000 WHEN {k} % 2999 = 4 THEN 50000
           ELSE o_totalprice + 100000 END AS double) AS AVERAGE_PRICE_CAD,
      CASE WHEN {k} % 809 = 29 THEN 'X' WHEN {k} % 8 = 0 THEN 'F' WHEN {k} % 8 = 1 THEN 'E'
           WHEN {k} % 8 = 2 THEN 'r' WHEN {k} % 8 = 3 THEN '' ELSE NULL END AS STATUS{extra if wide else ""}
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WRITTEN: dict[tuple, tuple[str, StructType]] = {}


def housing(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """The fixture as a stored table. A run goes over its table several times (statistics, rules, grain), so the join
    behind this one is done once per application and state of the files, and its result kept in the shared folder."""
    states = [file_states(spark, f"{sf_dir}/{name}.parquet") for name in ("orders", "customer")]
    key = (spark.sparkContext.applicationId, sf_dir, *states)
    if key not in _WRITTEN or not is_there(spark, _WRITTEN[key][0]):
        text = housing_sql("{orders}", "{customer}", wide=True)
        joined = spark.sql(text, orders=table(spark, sf_dir, "orders"), customer=table(spark, sf_dir, "customer"))
        path = f"{shared_dir(spark)}/housing-{uuid.uuid4().hex}"
        joined.write.parquet(path)
        _WRITTEN[key] = path, joined.schema
    path, schema = _WRITTEN[key]
    stored = spark.read.schema(schema).parquet(path)
    return stored if wide else stored.drop(*WIDE_COLUMNS)
