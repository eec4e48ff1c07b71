"""Range join: rows to the band that their value lies in, the bands being a table of any size.

Bands must follow one another without gap or overlap. That is checked by counting: every bound must be the end of one band and
the beginning of one other, closed on one side only, but for the least bound and the greatest. No band is compared with
another, so the check is one grouping.

The join goes by bins of equal width, about as many as there are bands: a band is copied to the bins that it reaches, at most
two copies for each band on the average, and a row has the bin of its value. Within a bin the exact bounds decide. Few
bands are broadcast, by their measured number; more of them meet the rows in a shuffle join by bin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import materialize

#: So many bands at most are broadcast.
BROADCAST_BANDS = 100_000
LOW, HIGH, LOW_IN, HIGH_IN = "_low", "_high", "_low_in", "_high_in"
#: Bounds are exact to six places.
BOUND = "decimal(20,6)"


def bands(table: DataFrame, low: str, high: str, low_included: str | None = None, high_included: str | None = None) -> DataFrame:
    """A checked table of bands: the columns of `table` and four more for the bounds. `low` and `high` may be text; an absent
    or empty bound is open-ended. Bounds belong to the band above them, unless the columns `low_included` and
    `high_included` (true or false) say otherwise. Raises if bands are missing between others, overlap, are empty or if
    there are none."""
    number = lambda c: F.expr(f"try_cast(nullif(trim(cast(`{c}` AS string)), '') AS {BOUND})")
    truth = lambda c, default: F.lit(default) if c is None else F.coalesce(F.col(f"`{c}`").cast("boolean"), F.lit(default))
    wrong = F.lit(False)
    for c in (low, high):
        text = F.trim(F.col(f"`{c}`").cast("string"))
        wrong = wrong | (text.isNotNull() & (text != "") & number(c).isNull())
    found = table.withColumns({LOW: number(low), HIGH: number(high), LOW_IN: truth(low_included, True), HIGH_IN: truth(high_included, False), "_wrong": wrong})
    found = materialize(found)
    empty = F.col("_wrong") | (F.col(LOW) >= F.col(HIGH))
    ends = F.array(
        F.struct(F.col(LOW).alias("at"), F.lit(1).alias("begins"), F.lit(0).alias("ends"), F.col(LOW_IN).cast("int").alias("closed")),
        F.struct(F.col(HIGH).alias("at"), F.lit(0).alias("begins"), F.lit(1).alias("ends"), F.col(HIGH_IN).cast("int").alias("closed")),
    )
    # of a bound, the number of bands that begin and end there; an absent bound is the table's edge
    sums = [F.sum(c).alias(c) for c in ("begins", "ends", "closed")]
    bounds = found.select(F.inline(ends)).groupBy("at").agg(*sums)
    inner = F.col("at").isNotNull()
    met = (F.col("begins") == 1) & (F.col("ends") == 1) & (F.col("closed") == 1)
    loose = inner & ~met
    row = bounds.agg(
        F.count_if(loose & ~(((F.col("begins") == 1) & (F.col("ends") == 0)) | ((F.col("begins") == 0) & (F.col("ends") == 1)))).alias("clashes"),
        F.coalesce(F.sum(F.when(loose, F.col("begins"))), F.lit(0)).alias("first"),
        F.coalesce(F.sum(F.when(loose, F.col("ends"))), F.lit(0)).alias("last"),
        F.coalesce(F.sum(F.when(~inner, F.col("begins"))), F.lit(0)).alias("open_first"),
        F.coalesce(F.sum(F.when(~inner, F.col("ends"))), F.lit(0)).alias("open_last"),
    ).first()
    if found.isEmpty():
        raise ValueError("no bands")
    if not found.filter(empty).isEmpty():
        raise ValueError("a band is empty, or a bound is no number")
    if row["clashes"] or row["first"] + row["open_first"] != 1 or row["last"] + row["open_last"] != 1:
        raise ValueError("bands overlap, or some are missing between others")
    return found.drop("_wrong")


def _bin(value: Column, start: float, width: float, count: int) -> Column:
    place = F.floor((value.cast("double") - F.lit(start)) / F.lit(width))
    return F.greatest(F.lit(0), F.least(F.lit(count), place)).cast("long")


def in_band(rows: DataFrame, checked: DataFrame, value: Column, of: Column | None = None, max_broadcast: int = BROADCAST_BANDS) -> DataFrame:
    """The rows with the columns of the band that `value` lies in, NULL outside all bands or where it is NULL. With `of`, the
    ratio value / of is meant and compared without dividing, so whole numbers are compared exactly; a ratio to 0 has no band."""
    edges = checked.agg(F.min(F.coalesce(LOW, HIGH)).alias("least"), F.max(F.coalesce(HIGH, LOW)).alias("most"), F.count(F.lit(1)).alias("n")).first()
    count = int(edges["n"])
    start = float(edges["least"]) if edges["least"] is not None else 0.0
    width = (float(edges["most"]) - start) / count if edges["most"] is not None and edges["most"] > edges["least"] else 1.0
    first = F.when(F.col(LOW).isNull(), F.lit(0)).otherwise(F.greatest(F.lit(0), _bin(F.col(LOW), start, width, count) - 1))
    last = F.when(F.col(HIGH).isNull(), F.lit(count)).otherwise(F.least(F.lit(count), _bin(F.col(HIGH), start, width, count) + 1))
    # one bin more on each side: a ratio in floating point may fall beside the bound that it equals
    copies = checked.withColumn("_bin", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    wanted = [F.col(f"`{c}`") for c in [*rows.columns, *[c for c in checked.columns if c not in (LOW, HIGH, LOW_IN, HIGH_IN)]]]
    ratio = F.try_divide(value.cast("double"), of.cast("double")) if of is not None else value.cast("double")
    placed = rows.withColumns({"_value": value, "_of": F.lit(1) if of is None else of})
    placed = placed.withColumn("_at", F.when(ratio.isNull() | F.isnan(ratio), F.lit(None)).otherwise(_bin(ratio, start, width, count)))
    times = lambda c: F.col(c) * F.col("_of").cast("decimal(18,0)") if of is not None else F.col(c).cast("double")
    own = F.col("_value").cast("decimal(38,6)") if of is not None else F.col("_value").cast("double")
    above = F.col(LOW).isNull() | (own > times(LOW)) | (F.col(LOW_IN) & (own == times(LOW)))
    below = F.col(HIGH).isNull() | (own < times(HIGH)) | (F.col(HIGH_IN) & (own == times(HIGH)))
    side = F.broadcast(copies) if count <= max_broadcast else copies
    return placed.join(side, (F.col("_at") == F.col("_bin")) & above & below, "left").select(*wanted)
