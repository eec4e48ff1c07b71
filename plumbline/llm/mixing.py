"""Mixing sources to target weights by capped water-filling.

Every source is to give a share of the mix in proportion to its weight, but at most `epochs` times its own size. Sources
whose share is above that are clamped there and the rest is shared out anew by weight, until no source is above. A source
then gives whole repetitions of all its documents, and of some, drawn by a seeded hash, one more; the last drawn is due the
fraction of a repetition that is left, so that a source's words meet its target to half a word. In `mixed`, which hands texts
on, that one is drawn whole or not at all.

Only sums per source and per slice of the hash order are gathered: one source may hold most rows. A row's share of the mix
follows from its own columns and one row of facts about its source, so texts are not shuffled for it.

Defined cases: text NULL or without words has size 0 and gives nothing. Source NULL is a source, last in order. Rows of
one source with the same id are drawn together and share the fraction by size. Without rows, or with no words at all,
nothing is taken. Columns of the input other than those named are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.common import SLICE, WORD, settle

SEED = "mix-1"
#: Facts about so many sources at most are broadcast; more of them meet the rows in a shuffle join.
BROADCAST_SOURCES = 50_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(ident: Column, seed: str) -> Column:
    """The place of a document in the seeded order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))))


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Numbers rows with distinct keys from 0 in the given order; the rows are cut by ranges, none of them in one task."""
    rows = settle(df.repartitionByRange(*order).withColumn("cut", F.spark_partition_id()))
    ahead = Window.orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    counts = rows.groupBy("cut").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("cut", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    inner = F.row_number().over(Window.partitionBy("cut").orderBy(*order)) - 1
    return rows.withColumn(name, inner).join(F.broadcast(offsets), "cut").withColumn(name, F.col(name) + F.col("offset")).drop("cut", "offset")


def cyclic_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """Weighs sources 1, 2, ... `cycle`, repeating, in the order of their code points, NULL last."""
    numbered = ranked(sources, [F.col("source").asc_nulls_last()], "place")
    return numbered.withColumn("weight", (F.col("place") % cycle + 1).cast("long")).drop("place")


def water_fill(sources: DataFrame, epochs: int = 3) -> DataFrame:
    """Adds `target` to a table (source, source_size, weight). Each round adds up what is clamped and what is not, and
    raises the level; as clamped sources stay so, the rounds end when their number does not grow."""
    sources = settle(sources)
    cap, weight = F.col("source_size") * epochs, F.col("weight")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, clamped = 0.0, -1
    while True:
        above = cap < F.lit(level) * weight if clamped >= 0 else F.lit(False)
        row = sources.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, weight)), F.lit(0)).alias("free"),
            F.count(F.when(above, 1)).alias("n"),
        ).first()
        if row["n"] == clamped or row["free"] == 0:
            break
        clamped, level = row["n"], float(total - row["held"]) / float(row["free"])
    share = F.lit(level) * weight
    return sources.withColumn("target", F.when(share > cap, cap.cast("double")).otherwise(share.cast("double")))


def source_plan(rows: DataFrame, weights: DataFrame | None = None, epochs: int = 3) -> DataFrame:
    """One row per source: what its documents give. `rows` has (source, place, size); `weights` has (source, weight), and
    sources that it lacks weigh nothing. Columns: source, source_size, target, whole (repetitions of every document),
    edge, edge_size, edge_left: documents before `edge` in the drawn order give one more repetition, those at it share
    `edge_left` words."""
    sums = rows.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    if weights is None:
        sums = cyclic_weights(sums)
    else:
        given = weights.select(F.col("source").alias("given"), F.col("weight").cast("long").alias("weight"))
        sums = sums.join(given, F.col("source").eqNullSafe(F.col("given")), "left").drop("given").na.fill({"weight": 0})
    sums = water_fill(sums, epochs)
    goal = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    sums = settle(sums.withColumn("whole", whole).withColumn("rest", goal - F.col("whole") * F.col("source_size")))

    def edge(parts: DataFrame, key: str, left: str) -> DataFrame:
        """Of the parts of each source, in order of the key, the one in which `left` words are used up."""
        ahead = Window.partitionBy("source").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0)).cast("long"))
        inside = (F.col("before") <= F.col(left)) & (F.col(left) < F.col("before") + F.col("n"))
        return parts.filter(inside).withColumn("left", F.col(left) - F.col("before"))

    def beside(one: DataFrame, other: DataFrame, *take: str) -> DataFrame:
        other = other.select(F.col("source").alias("of"), *take)
        return one.join(other, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")

    slices = rows.withColumn("slice", F.substring("place", 1, SLICE)).groupBy("source", "slice").agg(F.sum("size").alias("n"))
    slices = edge(beside(slices, sums, "rest"), "slice", "rest").select("source", F.col("slice").alias("at"), F.col("left").alias("slice_left"))
    near = beside(rows, slices, "at", "slice_left").filter(F.substring("place", 1, SLICE) == F.col("at"))
    near = near.groupBy("source", "slice_left", "place").agg(F.sum("size").alias("n"))
    edges = edge(near, "place", "slice_left").select("source", F.col("place").alias("edge"), F.col("n").alias("edge_size"), F.col("left").alias("edge_left"))
    return settle(beside(sums, edges, "edge", "edge_size", "edge_left").drop("rest", "weight"))


def with_taken(df: DataFrame, plan: DataFrame, source: str, place: Column, size: Column) -> DataFrame:
    """Adds source_size, target, whole and extra (words beyond the whole repetitions) to rows."""
    n = plan.count()
    facts = plan.withColumnRenamed("source", "facts_source")
    facts = F.broadcast(facts) if n <= BROADCAST_SOURCES else facts
    joined = df.join(facts, F.col(f"`{source}`").eqNullSafe(F.col("facts_source")), "left")
    extra = (
        F.when(F.col("edge").isNull() | (place > F.col("edge")), F.lit(0))
        .when(place < F.col("edge"), size)
        .otherwise(F.floor(F.col("edge_left") * size / F.col("edge_size")))
    )
    return joined.withColumn("extra", extra.cast("long")).drop("facts_source", "edge", "edge_size", "edge_left")


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, epochs: int = 3, seed: str = SEED) -> DataFrame:
    """Per document (doc_id, text, source): doc_id, size, source_size, target, whole, extra and taken, in words."""
    rows = settle(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))).withColumn("place", draw(F.col("doc_id"), seed))
    plan = source_plan(rows.select("source", "place", "size"), weights, epochs)
    out = with_taken(rows, plan, "source", F.col("place"), F.col("size"))
    taken = F.col("whole") * F.col("size") + F.col("extra")
    return out.select("doc_id", "size", "source_size", "target", "whole", "extra", taken.cast("long").alias("taken"))


def mixed(docs: DataFrame, weights: DataFrame | None = None, epochs: int = 3, seed: str = SEED) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of the input. Texts stay whole: the document
    of which part of a repetition is due is given once more or not at all, drawn by a second hash with the part as its chance.
    So a source may miss its target by less than the size of that one document."""
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    rows = settle(work.select(F.col("doc.source").alias("source"), draw(F.col("doc.doc_id"), seed).alias("place"), word_count(F.col("doc.text")).alias("size")))
    plan = source_plan(rows, weights, epochs)
    work = work.withColumns({"source": F.col("doc.source"), "size": word_count(F.col("doc.text"))})
    work = with_taken(work, plan, "source", draw(F.col("doc.doc_id"), seed), F.col("size"))
    chance = F.conv(F.substring(draw(F.col("doc.doc_id"), f"{seed}-edge"), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    once_more = F.when(chance * F.col("size") < F.col("extra"), 1).otherwise(0)  # always where a whole repetition is due
    work = work.withColumn("times", (F.col("whole") + once_more).cast("int")).filter("times > 0")
    work = work.withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return work.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def mix_sql(epochs: int = 3, cycle: int = 3, seed: str = SEED) -> str:
    """The same over `documents` in SQL."""
    return rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {cycle} + 1 AS weight, source_size * {epochs} AS cap FROM sums),
levels AS (
  SELECT *, CAST((SELECT sum(source_size) FROM sums) - coalesce(sum(cap) OVER before, 0) AS DOUBLE)
            / CAST(sum(weight) OVER after AS DOUBLE) AS level
  FROM weighed WINDOW before AS (ORDER BY CAST(cap AS DOUBLE) / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                      after AS (ORDER BY CAST(cap AS DOUBLE) / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
water AS (SELECT level FROM levels WHERE level * weight <= cap ORDER BY CAST(cap AS DOUBLE) / weight, source LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN w.level * weight > cap THEN CAST(cap AS DOUBLE) ELSE w.level * weight END AS target
  FROM weighed, water w),
goals AS (
  SELECT *, CAST(round(target) AS BIGINT) AS goal,
         CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS whole FROM targets),
placed AS (
  SELECT s.*, g.source_size, g.target, g.whole, g.goal - g.whole * g.source_size AS rest,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY place, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(whole AS BIGINT) AS whole,
       CAST(greatest(0, least(size, rest - before)) AS BIGINT) AS extra,
       CAST(whole * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM placed"""
