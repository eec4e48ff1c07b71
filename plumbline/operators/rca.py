"""Root-cause breakdowns: failures of a rule counted by a key of the failing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def root_causes(
    exceptions: DataFrame, breakdowns: Sequence[tuple[str, str, str]], keys: Mapping[str, Column] | None = None
) -> DataFrame:
    """Rows (breakdown, rule_id, key, failures). `breakdowns` lists (name, rule id, key); a key is a column, or a name in
    `keys` that stands for an expression. Null keys are left out. All breakdowns come from one pass and one shuffle of
    partial counts."""
    keys = dict(keys or {})
    names = exceptions.columns
    usable = [(name, rule_id, key) for name, rule_id, key in breakdowns if key in keys or key in names]
    # One row per breakdown: a rule can have several.
    wanted = exceptions.sparkSession.createDataFrame(usable, "breakdown string, rule_id string, key_name string")
    value = F.lit(None).cast("string")
    for key in sorted({key for *_, key in usable}):
        column = keys[key] if key in keys else F.col(f"`{key}`")
        value = F.when(F.col("key_name") == key, column.cast("string")).otherwise(value)
    picked = exceptions.join(F.broadcast(wanted), F.col("_rule_id") == F.col("rule_id"))
    return (
        picked.select("breakdown", "rule_id", value.alias("key"))
        .filter(F.col("key").isNotNull())
        .groupBy("breakdown", "rule_id", "key")
        .agg(F.count(F.lit(1)).alias("failures"))
    )


def top_causes(causes: DataFrame) -> DataFrame:
    """Per breakdown: the key with most failures (the smallest key among equals), and how many keys there are."""
    best = F.min(F.struct((-F.col("failures")).alias("n"), F.col("key")))
    return (
        causes.groupBy("breakdown", "rule_id")
        .agg(best.alias("best"), F.sum("failures").alias("total_failures"), F.count(F.lit(1)).alias("keys"))
        .select(
            "breakdown",
            "rule_id",
            F.col("best.key").alias("top_key"),
            (-F.col("best.n")).alias("top_failures"),
            "total_failures",
            "keys",
        )
    )


def breakdown(df: DataFrame, failing: Column, key: str) -> DataFrame:
    """Failing rows of any table counted by one of its columns."""
    return (
        df.filter(failing & F.col(f"`{key}`").isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("failures"))
    )


def ordered(causes: DataFrame) -> DataFrame:
    """Most failures first, for a report."""
    return causes.orderBy("breakdown", F.desc("failures"), "key")
