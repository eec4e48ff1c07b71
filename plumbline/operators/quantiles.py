"""Exact quantiles of large columns from a table of values and their frequencies, without a column in one task.

The frequencies are cut by ranges of values and written once. Sums per range, a row for each range, tell in which range a
wanted rank lies; only that range's rows are ranked. A hot value does no harm, as copies only ever count.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.session import write_rows


def frequency_quantiles(frequencies: DataFrame, places: Sequence[int], probs: Sequence[float]) -> dict[int, list[float | None]]:
    """Linear-interpolated quantiles for each place of a table (place, number, n); None for a place without numbers. A
    number may have several rows."""
    rows = frequencies.filter(F.col("place").isin(list(places)) & F.col("number").isNotNull()).select("place", "number", "n")
    rows = write_rows(rows.repartitionByRange("place", "number").withColumn("cut", F.spark_partition_id()))
    sums = rows.groupBy("place", "cut").agg(F.sum("n").alias("n"), F.min("number").alias("low"))
    ranges: dict[int, list] = {p: [] for p in places}
    for r in sorted(sums.collect(), key=lambda r: (r["place"], r["low"])):  # a row for each column and range
        ranges[r["place"]].append((r["cut"], r["n"]))

    def locate(place: int, rank: int) -> tuple[int, int]:
        """The range that holds a rank, and the rank in it."""
        for cut, n in ranges[place]:
            if rank < n:
                return cut, rank
            rank -= n
        raise ValueError("no such rank")

    wanted = {}
    for place in places:
        total = sum(n for _, n in ranges[place])
        for p in probs if total else ():
            rank = math.floor(p * (total - 1))
            wanted[place, p] = [locate(place, r) for r in (rank, min(rank + 1, total - 1))], p * (total - 1) - rank
    if not wanted:
        return {place: [None] * len(probs) for place in places}
    spots = sorted({(place, *spot) for (place, _), (both, _) in wanted.items() for spot in both})
    held = F.lit(False)
    for place, cut in sorted({(place, cut) for place, cut, _ in spots}):
        held = held | ((F.col("place") == place) & (F.col("cut") == cut))
    upto = F.sum("n").over(W.partitionBy("place", "cut").orderBy("number").rowsBetween(W.unboundedPreceding, 0))
    # the first number with more than `rank` rows up to it
    picks = [
        F.min(F.when((F.col("place") == place) & (F.col("cut") == cut) & (F.col("upto") > rank), F.col("number"))).alias(f"x{i}")
        for i, (place, cut, rank) in enumerate(spots)
    ]
    row = rows.filter(held).withColumn("upto", upto).agg(*picks).first()
    at = {spot: row[f"x{i}"] for i, spot in enumerate(spots)}

    def value(place: int, p: float) -> float | None:
        if (place, p) not in wanted:
            return None
        (low, high), fraction = wanted[place, p]
        x, y = at[(place, *low)], at[(place, *high)]
        return x if fraction == 0 else x + (y - x) * fraction

    return {place: [value(place, p) for p in probs] for place in places}


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """The same for columns of a table. NaN must be NULL already."""
    lines = [F.struct(F.lit(i).alias("place"), F.col(f"`{c}`").cast("double").alias("number")) for i, c in enumerate(columns)]
    values = df.select(F.inline(F.array(*lines))).filter("number IS NOT NULL")
    counted = values.groupBy("place", "number").agg(F.count(F.lit(1)).alias("n"))
    found = frequency_quantiles(counted, range(len(columns)), probs)
    return {c: found[i] for i, c in enumerate(columns)}
