"""Write the results of a run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The folders a run writes, and the ones that explorers read back.
REMEDIATED, EXCEPTIONS, SCORECARD = "remediated", "exceptions", "scorecard"
SUMMARY, BY_DIMENSION = "summary", "by_dimension"


def export_columns(remediated: DataFrame) -> DataFrame:
    """The remediated table without helper columns, but with its flag and date."""
    kept = [c for c in remediated.columns if not c.startswith("_")]
    return remediated.select(*[F.col(f"`{c}`") for c in kept], "_dq_flag", "_remediation_date")


def write_exceptions(exceptions: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per rule, so that a filter on a rule reads that rule only. The rebalance gives every rule files of a
    good size and splits the rules with very many rows."""
    exceptions.hint("rebalance", F.col("_rule_id")).write.mode(mode).partitionBy("_rule_id").parquet(path)


def write_outputs(
    path: str,
    remediated: DataFrame,
    exceptions: DataFrame,
    scorecard: DataFrame,
    summary: Callable[[DataFrame], DataFrame],
    by_dimension: Callable[[DataFrame], DataFrame],
    mode: str = "overwrite",
) -> None:
    """Everything a run leaves behind, under one folder. Each result is worked out once: the scorecard is written first, and
    `summary` and `by_dimension` are made from what was written. Without exceptions their folder is left empty, so that
    none of an earlier run remain."""
    export_columns(remediated).write.mode(mode).parquet(f"{path}/{REMEDIATED}")
    write_exceptions(exceptions, f"{path}/{EXCEPTIONS}", mode)
    # A few rows each.
    scorecard.coalesce(1).write.mode(mode).parquet(f"{path}/{SCORECARD}")
    written = scorecard.sparkSession.read.schema(scorecard.schema).parquet(f"{path}/{SCORECARD}")
    for name, make in ((SUMMARY, summary), (BY_DIMENSION, by_dimension)):
        make(written).coalesce(1).write.mode(mode).parquet(f"{path}/{name}")


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A filtered view as delimited text with a header, quotes doubled. Arrays, maps and structs are written as JSON text."""
    nested = {name for name, kind in df.dtypes if kind.startswith(("array", "map", "struct"))}
    cells = [F.to_json(F.col(f"`{c}`")).alias(c) if c in nested else F.col(f"`{c}`") for c in df.columns]
    df.select(*cells).write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)
