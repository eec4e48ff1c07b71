"""Status and grade ladders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The lower bound of each letter; the last letter has none.
GRADES = {
    "engine": (("A", 99), ("B", 95), ("C", None)),
    "dashboard": (("A", 99), ("B", 95), ("C", 90), ("D", None)),
    "cde": (("A", 100), ("B", 95), ("C", None)),
}


def _ladder(score: Column, steps) -> Column:
    expr = None
    for label, floor in steps:
        if floor is None:
            return expr.otherwise(label)
        expr = F.when(score >= floor, label) if expr is None else expr.when(score >= floor, label)
    return expr


def status(rate: Column, failed: Column | None = None) -> Column:
    """PASS at 100, WARN from 95, else FAIL. The rate is the rounded one, so a few failures among very many rows
    still read PASS; give `failed` to demand that no row failed."""
    clean = rate == 100 if failed is None else (failed == 0) & (rate == 100)
    return F.when(clean, "PASS").when(rate >= 95, "WARN").otherwise("FAIL")


def grade(score: Column, kind: str = "engine") -> Column:
    return _ladder(score, GRADES[kind])


def sla_status(rate: Column, warn: Column, critical: Column) -> Column:
    return F.when(rate >= warn, "PASS").when(rate >= critical, "WARN").otherwise("FAIL")
