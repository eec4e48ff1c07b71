"""NaN counts as missing. Spark keeps NaN and NULL apart, and NaN > x is true, so float columns need care."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATS = (T.FloatType, T.DoubleType)


def is_missing(col: Column, dtype: T.DataType) -> Column:
    """True for NULL and, on floating columns, for NaN."""
    return col.isNull() | F.isnan(col) if isinstance(dtype, FLOATS) else col.isNull()


def drop_nan(col: Column, dtype: T.DataType) -> Column:
    """The column with NaN turned into NULL; other types pass through."""
    return F.when(~F.isnan(col), col) if isinstance(dtype, FLOATS) else col
