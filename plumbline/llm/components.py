"""Connected components of a graph of links, by alternating large and small stars.

Each round joins every link with the smallest neighbour of one of its ends. Minima are combined before the shuffle and
written; links then meet them in joins of two tables at rest, which AQE can split, so a node with any number of links is no
task of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import settle


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0).cast("decimal(20,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); the label is the smallest node that it reaches."""
    down = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    down = settle(down, light=True)
    state = None
    while (now := _state(down)) != state:
        state = now
        # large star: larger neighbours of u go to the smallest node of u and its neighbours
        both = down.union(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m")), light=True)
        large = both.filter("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large.filter("u <> v").distinct(), light=True)
        # small star: u and its smaller neighbours go to the smallest of them
        least = settle(large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m"), light=True)
        small = large.join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.select(F.col("c").alias("u"), F.col("m").alias("v"))
        down = settle(small.union(own).filter("u <> v").distinct(), light=True)
    labels = down.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.union(down.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
