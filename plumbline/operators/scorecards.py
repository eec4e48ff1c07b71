"""Roll-ups of a rule scorecard: by dimension, by critical data element, one-row summaries.

Input is a scorecard with one row per rule, freshly made or read back. Means of rates are taken over whole basis points.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.ladders import grade
from plumbline.functions.rates import mean_rate, share, to_basis_points

# The five dimensions, in the order in which summaries list them.
DIMENSIONS = ("Completeness", "Validity", "Uniqueness", "Accuracy", "Consistency")


def _rates() -> Column:
    return to_basis_points(F.col("Pass_Rate_Pct"))


def _tallies() -> list[Column]:
    return [F.count_if(F.col("Status") == s).alias(f"_{s.lower()}") for s in ("PASS", "WARN", "FAIL")]


def by_dimension(scorecard: DataFrame, ordered: bool = False) -> DataFrame:
    """Per dimension: rules, mean pass rate, failures, rules by status, grade. `ordered` puts the worst first."""
    out = (
        scorecard.groupBy("DQ_Dimension")
        .agg(
            F.count(F.lit(1)).alias("Rules_Count"),
            F.sum(_rates()).alias("_bp"),
            F.sum("Records_Failed").alias("Total_Failed"),
            *_tallies(),
        )
        .withColumn("_score", mean_rate(F.col("_bp"), F.col("Rules_Count")))
        .select(
            "DQ_Dimension",
            "Rules_Count",
            F.col("_score").alias("Avg_Pass_Rate"),
            "Total_Failed",
            F.col("_pass").alias("Rules_Passing"),
            F.col("_warn").alias("Rules_Warning"),
            F.col("_fail").alias("Rules_Failing"),
            F.col("_score").alias("Dimension_Score"),
            grade(F.col("_score")).alias("Dimension_Grade"),
        )
    )
    return out.orderBy("Dimension_Score", "DQ_Dimension") if ordered else out


def by_cde(scorecard: DataFrame, cde_rules: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per critical data element: rules applied, mean pass rate, failures, grade, whether action is required."""
    owner = F.create_map(*[F.lit(x) for cde, ids in cde_rules.items() for i in ids for x in (i, cde)])
    return (
        scorecard.withColumn("CDE", owner[F.col("Rule_ID")])
        .filter(F.col("CDE").isNotNull())
        .groupBy("CDE")
        .agg(
            F.count(F.lit(1)).alias("Rules_Applied"),
            F.sum(_rates()).alias("_bp"),
            F.sum("Records_Failed").alias("Total_Failed_Records"),
        )
        .withColumn("Avg_Pass_Rate", mean_rate(F.col("_bp"), F.col("Rules_Applied")))
        .select(
            "CDE",
            "Rules_Applied",
            "Avg_Pass_Rate",
            "Total_Failed_Records",
            grade(F.col("Avg_Pass_Rate"), "cde").alias("CDE_Grade"),
            F.when(F.col("Total_Failed_Records") > 0, "Yes").otherwise("No").alias("Action_Required"),
        )
    )


def _totals(scorecard: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    in_dim = {d: F.col("DQ_Dimension") == d for d in dimensions}
    return scorecard.agg(
        F.max("Total_Records").alias("_total"),
        F.count(F.lit(1)).alias("_rules"),
        F.sum(_rates()).alias("_bp"),
        F.sum("Records_Failed").alias("_failures"),
        *_tallies(),
        *[F.sum(F.when(cond, _rates())).alias(f"_bp_{d}") for d, cond in in_dim.items()],
        *[F.count_if(cond).alias(f"_n_{d}") for d, cond in in_dim.items()],
        F.array_sort(F.collect_list(F.when(F.col("Status") != "PASS", F.col("Rule_ID")))).alias("_open"),
    )


def summary(scorecard: DataFrame, dataset: str, date: str, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """One row for the whole table; a dimension without rules has a null score. The recommended action names the rules
    that do not pass."""
    overall = mean_rate(F.col("_bp"), F.col("_rules"))
    escalate = F.concat(F.lit("Escalate "), F.array_join("_open", ", "), F.lit(" to Data Steward."))
    return _totals(scorecard, dimensions).select(
        F.lit(dataset).alias("Dataset"),
        F.lit(date).alias("Scorecard_Date"),
        F.col("_total").alias("Total_Records"),
        F.col("_rules").alias("Total_DQ_Rules"),
        F.col("_pass").alias("Rules_PASS"),
        F.col("_warn").alias("Rules_WARN"),
        F.col("_fail").alias("Rules_FAIL"),
        F.col("_failures").alias("Total_Rule_Failures"),
        overall.alias("Overall_DQ_Score_Pct"),
        grade(overall).alias("Overall_Grade"),
        *[mean_rate(F.col(f"_bp_{d}"), F.col(f"_n_{d}")).alias(f"{d}_Score") for d in dimensions],
        F.when(F.size("_open") > 0, escalate).otherwise("No action required.").alias("Recommended_Action"),
    )


def run_summary(
    scorecard: DataFrame, unique_failed: DataFrame | None = None, dimensions: Sequence[str] = DIMENSIONS
) -> DataFrame:
    """One row with one-place scores and four grades. Clean records are those that fail no rule; without a count of
    distinct failing records, the sum of failures stands in. A dimension without rules scores 100."""
    distinct = F.col("_failures") if unique_failed is None else unique_failed.select("failed_records").scalar()
    totals = _totals(scorecard, dimensions).withColumn("_distinct", distinct)
    overall = mean_rate(F.col("_bp"), F.col("_rules"), places=1)
    scores = {d: mean_rate(F.col(f"_bp_{d}"), F.col(f"_n_{d}"), places=1) for d in dimensions}
    return totals.select(
        F.col("_total").alias("total_records"),
        F.col("_rules").alias("total_rules"),
        F.col("_pass").alias("n_pass"),
        F.col("_warn").alias("n_warn"),
        F.col("_fail").alias("n_fail"),
        F.col("_failures").alias("total_failed"),
        overall.alias("overall_score"),
        grade(overall, "dashboard").alias("overall_grade"),
        share(F.col("_total") - F.col("_distinct"), F.col("_total")).alias("clean_pct"),
        *[F.coalesce(score, F.lit(100.0)).alias(d.lower()) for d, score in scores.items()],
    )
