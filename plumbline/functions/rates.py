"""Percentages computed in whole numbers, so that every engine and every plan rounds alike.

A rate of 98.12 % is held as 9812 basis points. Rounding is half-up and happens once, on integers; only the last
division by 100 touches floating point.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def basis_points(part: Column, total: Column) -> Column:
    """round(100 * part / total, 2) as a whole number of hundredths; 0 for an empty table. Counts of cells times 20,000 may
    exceed a long."""
    wide = part.cast("decimal(30,0)") * 20000 + total
    return F.when(total > 0, _div(wide, total.cast("decimal(30,0)") * 2)).otherwise(F.lit(0))


def percent(part: Column, total: Column) -> Column:
    """Percentage with two places; 0.0 for an empty table."""
    return basis_points(part, total) / F.lit(100.0)


def share(part: Column, total: Column, when_empty: float = 100.0) -> Column:
    """Percentage with one place, as the run summary shows it."""
    tenths = _div(part * 2000 + total, total * 2)
    return F.when(total > 0, tenths / F.lit(10.0)).otherwise(F.lit(when_empty))


def mean_rate(sum_bp: Column, n: Column, places: int = 2) -> Column:
    """Mean of n rates given the sum of their basis points, with two places or one; NULL when n is 0."""
    unit, scale = (1, 100.0) if places == 2 else (10, 10.0)
    return F.when(n > 0, _div(sum_bp * 2 + n * unit, n * (2 * unit)) / F.lit(scale))


def to_basis_points(rate: Column) -> Column:
    """A two-place percentage back to whole basis points."""
    return F.round(rate * 100).cast("long")
