"""Remediation: correct what can be corrected, flag the rest, in the order of the steps.

Corrections come first. The flagging rules then see the corrected table, group statistics included, so the outliers found
here can differ from those in the exceptions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.rates import basis_points
from plumbline.operators.rule import Rule
from plumbline.operators.run import Run

FLAGS = "_dq_flags"
FLAG = "_dq_flag"
CLEAN = "CLEAN"


def remediate(df: DataFrame, rules: Sequence[Rule], steps: Sequence, run_date: str, as_of: str | None = None) -> DataFrame:
    """The table with `_dq_flags` (rule ids, in step order), `_dq_flag` (text) and `_remediation_date`."""
    by_id = {r.rule_id: r for r in rules}
    fixes = [s for s in steps if s.correct]
    flags = [s for s in steps if not s.correct]
    if list(steps) != fixes + flags:
        raise ValueError("corrections must come before flags")

    first = Run(df, [by_id[s.rule_id] for s in fixes], as_of=as_of)
    columns = [F.col(f"`{c}`") for c in first.schema.names]
    was = {s.rule_id: f"_fixed_{i}" for i, s in enumerate(fixes)}
    marked = first.with_stats().select(*columns, *[first.mask(by_id[s.rule_id]).alias(was[s.rule_id]) for s in fixes])
    corrected = marked
    for step in fixes:
        value = F.col(f"`{step.correct}`")
        corrected = corrected.withColumn(step.correct, F.when(F.col(was[step.rule_id]), F.abs(value)).otherwise(value))

    second = Run(corrected, [by_id[s.rule_id] for s in flags], as_of=as_of)
    hits: list[tuple[str, str, Column]] = [(s.rule_id, s.text, F.col(was[s.rule_id])) for s in fixes]
    hits += [(s.rule_id, s.text, second.mask(by_id[s.rule_id])) for s in flags]
    ids = F.concat_ws(",", *[F.when(hit, F.lit(rule_id)) for rule_id, _, hit in hits])
    # The first step assigns its text; every later one appends " | text", also where nothing came before.
    texts = [F.when(hit, F.lit(text if i == 0 and fixes else f" | {text}")) for i, (_, text, hit) in enumerate(hits)]
    rows = second.prepared.select(*columns, ids.alias("_ids"), F.concat_ws("", *texts).alias("_text"))
    none = F.col("_ids") == ""
    return rows.select(
        *columns,
        F.when(none, F.array().cast("array<string>")).otherwise(F.split("_ids", ",")).alias(FLAGS),
        F.when(none, CLEAN).otherwise(F.col("_text")).alias(FLAG),
        F.lit(run_date).alias("_remediation_date"),
    )


def remediation_summary(remediated: DataFrame, steps: Sequence) -> DataFrame:
    """One row: records, clean and flagged records, corrections made (a row can have two), clean share."""
    fixes = [s.rule_id for s in steps if s.correct]
    made = F.lit(0)
    for rule_id in fixes:
        made = made + F.array_contains(FLAGS, rule_id).cast("int")
    totals = remediated.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(FLAG) == CLEAN).alias("clean_records"),
        F.coalesce(F.sum(made), F.lit(0)).cast("long").alias("auto_remediated"),
    )
    total, clean = F.col("total_records"), F.col("clean_records")
    return totals.withColumns(
        {"flagged_records": total - clean, "clean_pct": basis_points(clean, total) / F.lit(100.0)}
    )


def flag_counts(remediated: DataFrame) -> DataFrame:
    """Rows (rule_id, records): how many records carry each flag."""
    flags = remediated.select(F.explode(FLAGS).alias("rule_id"))
    return flags.groupBy("rule_id").agg(F.count(F.lit(1)).alias("records"))
