"""A rule is metadata plus a check; a list of rules is a pack. Both are data that a caller can write or change."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.nulls import drop_nan, is_missing
from plumbline.operators.lookup import Facts


@dataclass(frozen=True)
class Scope:
    """The columns of the table under test as a check sees them.

    `as_of` is the current month, handed in so that a run can be repeated. `defaults` stand in for absent columns.
    """

    schema: T.StructType
    as_of: str | None = None
    defaults: Mapping[str, Any] = field(default_factory=dict)

    def has(self, name: str) -> bool:
        return name in self.schema.names

    def dtype(self, name: str) -> T.DataType:
        return self.schema[name].dataType

    def raw(self, name: str) -> Column:
        if not self.has(name) and name in self.defaults:
            return F.lit(self.defaults[name])
        return F.col(f"`{name}`")

    def col(self, name: str) -> Column:
        """The column with NaN as NULL."""
        return drop_nan(self.raw(name), self.dtype(name)) if self.has(name) else self.raw(name)

    def missing(self, name: str) -> Column:
        return is_missing(self.raw(name), self.dtype(name)) if self.has(name) else self.raw(name).isNull()


class Check:
    """What a row must satisfy. `fails` is the predicate of a failing row; NULL reads as passing."""

    columns: tuple[str, ...] = ()
    defaults: Mapping[str, Any] = {}

    def fails(self, scope: Scope) -> Column:
        raise NotImplementedError

    def runnable(self, scope: Scope) -> bool:
        return all(scope.has(c) or c in self.defaults for c in self.columns)

    def failed_value(self, scope: Scope) -> Column:
        return scope.raw(self.columns[0])


class GroupCheck(Check):
    """A check that a whole key group passes or fails, such as uniqueness. It can be tallied without touching rows."""

    def facts(self, df: DataFrame, scope: Scope) -> Facts:
        """The failing keys, to be attached to rows."""
        raise NotImplementedError

    def tally(self, df: DataFrame, scope: Scope) -> DataFrame:
        """One row: total, failed."""
        raise NotImplementedError

    def tally_by(self, df: DataFrame, scope: Scope, slices: Sequence[str]) -> DataFrame:
        """One row per slice: the slice columns, total, failed."""
        raise NotImplementedError


@dataclass(frozen=True)
class Rule:
    rule_id: str
    name: str
    dimension: str
    cde: str
    description: str
    severity: str
    remediation: str
    check: Check
    reason: str | None = None  # short text used by violation listings

    def with_(self, **changes: Any) -> Rule:
        return replace(self, **changes)


METADATA = {
    "rule_id": "Rule_ID",
    "name": "Rule_Name",
    "dimension": "DQ_Dimension",
    "cde": "CDE_Affected",
    "description": "Description",
    "severity": "Severity",
    "remediation": "Remediation_Action",
}


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """Rule metadata as a table with one row per rule."""
    schema = ", ".join(f"{name} string" for name in METADATA.values())
    return spark.createDataFrame([tuple(getattr(r, name) for name in METADATA) for r in rules], schema)
