import numpy as np
import pytest
from helpers import by
from pyspark.sql import functions as F

from plumbline.operators.profile import DISTINCT_ERROR, RANK_ERROR, column_profile, domain_validation, profile_scorecard, sketch_error
from plumbline.operators.quantiles import exact_quantiles
from plumbline.plans import housing as pack
from plumbline.plans.fixture import table
from plumbline.plans.housing_contract import DOMAIN_CHECKS


@pytest.fixture(scope="module")
def like_published(spark):
    """10,800 rows with the published numbers of nulls and negatives."""
    i = F.col("id")
    return spark.range(10800).select(
        i.cast("string").alias("REF_DATE"),
        F.lit("Alberta").alias("GEO"),
        F.lit("AB").alias("GEO_CODE"),
        F.lit("Row House").alias("DWELLING_TYPE"),
        F.lit("Rental").alias("INTENDED_MARKET"),
        F.when(i < 203, None).when(i < 510, F.lit(-1.0)).otherwise(1.0).alias("HOUSING_STARTS"),
        F.when(i < 180, None).when(i < 297, F.lit(-1.0)).otherwise(5.0).alias("AVERAGE_PRICE_CAD"),
        *[F.lit("x").alias(c) for c in ("DATA_SOURCE", "REPORTING_AGENCY", "LAST_UPDATED", "GEOGRAPHY_TYPE", "UOM", "SCALAR_FACTOR")],
        F.lit("Direct Survey").alias("SURVEY_METHOD"),
        F.when(i >= 6535, "E").alias("STATUS"),
        F.lit(0).alias("DECIMALS"),
    )


def test_published_profile_scorecard(like_published):
    row = profile_scorecard(like_published, DOMAIN_CHECKS, pack.GRAIN, pack.CRITICAL_DATA_ELEMENTS, "d", "x").first()
    scores = [row[f"{s}_Score"] for s in ("Completeness", "Validity", "Uniqueness")]
    assert scores == [96.0, 99.51, 100.0]
    assert (row["Overall_DQ_Score"], row["Overall_Grade"]) == (98.5, "B")
    assert (row["Total_Null_Cells"], row["Columns_With_Nulls"], row["Domain_Checks_Run"], row["Domain_Checks_Failed"]) == (6918, 3, 8, 2)


def test_published_domain_checks(like_published):
    rows = by(domain_validation(like_published, DOMAIN_CHECKS), "Check")
    negative = rows["Negative housing starts"]
    assert (negative["Failed_Records"], negative["Failed_Pct"], negative["Status"]) == (307, 2.84, "WARN")
    assert rows["Negative average price"]["Failed_Pct"] == 1.08
    assert rows["Price exceeds $10M ceiling"]["Status"] == "PASS"


def test_published_column_rates(like_published):
    row = by(column_profile(like_published, ["HOUSING_STARTS", "STATUS", "GEO"], ["GEO"]), "Column")
    starts = row["HOUSING_STARTS"]
    assert (starts["Null_Pct"], starts["Completeness_Pct"], starts["Not_Null_Count"]) == (1.88, 98.12, 10597)
    assert (starts["Negative_Count"], starts["Zero_Count"], starts["Positive_Count"]) == (307, 0, 10290)
    assert (row["STATUS"]["Null_Pct"], row["STATUS"]["Completeness_Pct"], row["STATUS"]["Min"]) == (60.51, 39.49, None)
    assert (row["GEO"]["Is_CDE"], row["GEO"]["Top_Value"], row["GEO"]["Top_Value_Freq"]) == ("Yes", "Alberta", 10800)


def test_mode_takes_the_smallest_of_equals(spark):
    rows = [("b", 10.0), ("b", 10.0), ("a", 9.0), ("a", 9.0), (None, float("nan"))]
    row = by(column_profile(spark.createDataFrame(rows, "s string, n double")), "Column")
    assert row["s"]["Top_Value"] == "a"
    assert (row["n"]["Top_Value"], row["n"]["Null_Count"], row["n"]["Unique_Values"]) == ("9.0", 1, 2)


def test_empty_and_all_null_columns(spark):
    empty = by(column_profile(spark.createDataFrame([], "n double, s string")), "Column")
    assert (empty["n"]["Total_Records"], empty["n"]["Median"], empty["s"]["Top_Value"]) == (0, None, None)
    void = by(column_profile(spark.createDataFrame([(None, "x")], "n double, s string")), "Column")["n"]
    assert (void["Null_Count"], void["Unique_Values"], void["Q1"], void["Outlier_Count_IQR"]) == (1, 0, None, 0)


def test_quantiles_are_exact(spark):
    i = F.col("id")
    df = spark.range(20_000).select(
        (F.xxhash64("id") % 100_000 / 7).alias("spread"),
        F.when(i % 3 == 0, F.lit(5.0)).otherwise(F.xxhash64("id") % 1000 * 1.0).alias("hot"),
        F.when(i % 2 == 0, F.pow(F.lit(1.5), i % 90)).alias("tail"),
        F.lit(None).cast("double").alias("void"),
        F.lit(3.0).alias("same"),
    )
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(df, df.columns, probs)
    pdf = df.toPandas()
    for name in ("spread", "hot", "tail", "same"):
        assert got[name] == pytest.approx(list(np.quantile(pdf[name].dropna(), probs)), rel=1e-12)
    assert got["void"] == [None] * len(probs)


def test_approximate_quartiles_are_close(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    exact = by(column_profile(events, ["value"]), "Column")["value"]
    rough = by(column_profile(events, ["value"], approximate=True), "Column")["value"]
    assert rough["Median"] == pytest.approx(exact["Median"], rel=0.05)
    assert rough["Unique_Values"] == pytest.approx(exact["Unique_Values"], rel=0.1)
    kinds = [by(column_profile(events, ["event_type"], approximate=a), "Column")["event_type"] for a in (False, True)]
    assert kinds[0] == kinds[1]


def test_long_texts_are_counted_by_digest(spark):
    long = "x" * 500
    rows = [(long + "a",), (long + "b",), (long + "b",), ("short",)]
    row = column_profile(spark.createDataFrame(rows, "s string")).first()
    assert (row["Top_Value"], row["Top_Value_Freq"], row["Unique_Values"]) == (long + "b", 2, 3)


def test_sketch_error(spark):
    rows = [(float(i % 1000), i, None, 7) for i in range(20_000)]
    found = by(sketch_error(spark.createDataFrame(rows, "a double, b long, c int, d int").repartition(3)), "Column")
    assert {c: (r["Not_Null_Count"], r["Unique_Values"]) for c, r in found.items()} == {"a": (20_000, 1000), "b": (20_000, 20_000), "c": (0, 0), "d": (20_000, 1)}
    assert all(r["Rank_Error"] <= RANK_ERROR and r["Distinct_Error"] <= DISTINCT_ERROR for r in found.values())


def test_approximate_profile_without_a_frequent_value(spark):
    row = column_profile(spark.range(200_000), approximate=True).first()
    assert row["Top_Value"] is None or row["Top_Value_Freq"] >= 1
