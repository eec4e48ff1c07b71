"""Uniqueness on a table that keeps growing.

A stream counts the rows of every key in Spark's state store, so a batch costs what its own keys cost, however many there are
already. The store is part of the stream's checkpoint: a batch that is run again finds the counts of the batch before. Keys
that repeat, and the number of rows so far, are logged per batch in a folder that a second run of the batch replaces. Counts
only grow, so a key's latest count is its largest; logs of all batches can be merged in any order.

State grows with the number of distinct keys; on a cluster, keep it on disk
(`spark.sql.streaming.stateStore.providerClass`, the RocksDB provider).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.operators.checks import Unique
from plumbline.operators.lookup import Facts
from plumbline.operators.rule import Rule, Scope
from plumbline.sources.tables import read_optional

KEYS = "repeated_keys"
ROWS = "_rows"  # true on the row that counts all rows


def _folder(path: str, rule_id: str) -> str:
    return f"{path}/{KEYS}/{rule_id}"


def count_keys(stream: DataFrame, rules: Sequence[Rule], path: str, **trigger) -> list[StreamingQuery]:
    """Start counting for every uniqueness rule of the pack, one stream each. Results go to folders under `path`, where
    the functions below find them."""
    return [_start(stream, rule, path, trigger) for rule in rules if isinstance(rule.check, Unique)]


def _start(stream: DataFrame, rule: Rule, path: str, trigger: dict) -> StreamingQuery:
    scope = Scope(stream.schema)
    keys = rule.check.present(scope)
    # every row counts for its key and for the table; both counts are made per task before they are shuffled
    own = [rule.check.key(k, scope).alias(k) for k in keys]
    none = [F.lit(None).cast(stream.select(c).schema[0].dataType).alias(k) for c, k in zip(own, keys, strict=True)]
    both = F.array(F.struct(F.lit(False).alias(ROWS), *own), F.struct(F.lit(True).alias(ROWS), *none))
    counts = stream.select(F.inline(both)).groupBy(ROWS, *keys).agg(F.count(F.lit(1)).alias("_n"))

    def log(batch: DataFrame, batch_id: int) -> None:
        batch.filter(F.col(ROWS) | (F.col("_n") > 1)).write.mode("overwrite").parquet(f"{_folder(path, rule.rule_id)}/log/batch_id={batch_id}")

    writer = counts.writeStream.outputMode("update").foreachBatch(log)
    writer = writer.option("checkpointLocation", f"{_folder(path, rule.rule_id)}/stream")
    return writer.trigger(**trigger).start() if trigger else writer.start()


def _latest(spark: SparkSession, path: str, rule: Rule) -> DataFrame | None:
    log = read_optional(spark, f"{_folder(path, rule.rule_id)}/log")
    if log is None:
        return None
    keys = [c for c in log.columns if c not in ("_n", "batch_id")]
    return log.groupBy(*keys).agg(F.max("_n").alias("_n"))


def copies(spark: SparkSession, path: str, rule: Rule) -> DataFrame | None:
    """The keys that occur more than once so far, with their number of rows (`_n`); None before the first batch."""
    latest = _latest(spark, path, rule)
    return None if latest is None else latest.filter(~F.col(ROWS)).drop(ROWS)


def facts(spark: SparkSession, path: str, rule: Rule, scope: Scope) -> Facts | None:
    """The repeated keys as facts to attach to the rows of a table at rest, such as the files the stream has read."""
    found = copies(spark, path, rule)
    if found is None:
        return None
    keys = rule.check.present(scope)
    flag = rule.check.flag
    return Facts(found.withColumn(flag, F.col("_n")), tuple(keys), (flag,), row_keys=tuple(rule.check.key(k, scope) for k in keys))


def tally(spark: SparkSession, path: str, rule: Rule) -> DataFrame | None:
    """One row: total, failed, of all batches so far."""
    latest = _latest(spark, path, rule)
    if latest is None:
        return None
    rows, repeated = F.col(ROWS), ~F.col(ROWS)
    return latest.agg(
        F.coalesce(F.sum(F.when(rows, F.col("_n"))), F.lit(0)).alias("total"), F.coalesce(F.sum(F.when(repeated, F.col("_n"))), F.lit(0)).alias("failed")
    )


def failed_by_batch(spark: SparkSession, path: str, rule: Rule) -> DataFrame:
    """Per batch the rows that fail since: (batch_id, newly_failed). A key's first row fails when the second arrives."""
    log = spark.read.parquet(f"{_folder(path, rule.rule_id)}/log").filter(~F.col(ROWS))
    keys = [c for c in log.columns if c not in ("_n", "batch_id", ROWS)]
    known = F.struct(*keys) if keys else F.lit(1)
    before = F.expr("lag(_n, 1, 0) OVER (PARTITION BY _key ORDER BY batch_id)")
    steps = log.withColumn("_key", known).withColumn("_before", before)
    return steps.groupBy("batch_id").agg(F.sum(F.col("_n") - F.col("_before")).alias("newly_failed"))
