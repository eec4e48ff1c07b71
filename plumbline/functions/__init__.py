"""Column expressions shared by the operators: null tests, rates, status and grade ladders."""

from plumbline.functions.ladders import grade, sla_status, status
from plumbline.functions.nulls import drop_nan, is_missing
from plumbline.functions.rates import basis_points, mean_rate, percent, share

__all__ = ["basis_points", "drop_nan", "grade", "is_missing", "mean_rate", "percent", "share", "sla_status", "status"]
