"""Score tables that keep growing: each new batch of files gets its own scorecard and exceptions.

Rules about single rows, and those that look a row up in another table, run as they are: counts of batches add up.
Statistical rules compare with a snapshot taken from a table at rest, or, with `learn`, with statistics of all batches up to
their own, kept as states that add up. Uniqueness rules are counted by streams of their own (`keys.count_keys`), as their
rows meet in different batches. Every batch writes folders of its own and replaces them if it runs again, so a restarted
stream leaves no row twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.operators import statistics
from plumbline.operators.checks import SigmaOutlier, Unique
from plumbline.operators.lookup import Facts
from plumbline.operators.rule import Rule, rule_table
from plumbline.operators.run import SCORECARD_COLUMNS, Run, finish_scorecard
from plumbline.sources.outputs import EXCEPTIONS, SCORECARD
from plumbline.streaming import keys

STATISTICS = "statistics"
COUNTED = [c for c in SCORECARD_COLUMNS if c not in ("Records_Passed", "Pass_Rate_Pct", "Status")]


def snapshot(df: DataFrame, rules: Sequence[Rule]) -> dict[str, Facts]:
    """The group statistics of a table at rest, for the statistical rules of a stream."""
    return Run(df, [r for r in rules if isinstance(r.check, SigmaOutlier)]).stats


def score_stream(
    stream: DataFrame,
    rules: Sequence[Rule],
    path: str,
    as_of: str | None = None,
    run_ts: str | None = None,
    stats: Mapping[str, Facts] | None = None,
    with_exceptions: bool = True,
    learn: bool = False,
    **trigger,
) -> StreamingQuery:
    """Start scoring. Results go to folders under `path`, the stream's own checkpoint to `path`/_stream. `trigger` is
    passed on; availableNow=True scores what is there and stops. `learn`: statistical rules without a snapshot compare with
    what has been seen up to the batch, the batch included."""
    learned: dict[str, list[SigmaOutlier]] = {}
    for rule in rules:
        if isinstance(rule.check, Unique):
            raise ValueError(f"{rule.rule_id} looks at all rows at once; count its keys with keys.count_keys")
        if isinstance(rule.check, SigmaOutlier) and rule.check.by not in (stats or {}):
            if not learn:
                raise ValueError(f"{rule.rule_id} needs a snapshot by {rule.check.by}")
            learned.setdefault(rule.check.by, []).append(rule.check)

    def score(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            own = dict(stats or {})
            for by, checks in learned.items():
                statistics.store(statistics.state(batch, [by], sorted({c.column for c in checks})), f"{path}/{STATISTICS}/{by}", batch_id)
                seen = statistics.stored(batch.sparkSession, f"{path}/{STATISTICS}/{by}", range(batch_id + 1))
                own[by] = statistics.sigma_facts(seen, by, checks, batch.schema).materialized()
            run = Run(batch, rules, as_of=as_of, run_ts=run_ts, stats=own)
            run.scorecard().coalesce(1).write.mode("overwrite").parquet(f"{path}/{SCORECARD}/batch_id={batch_id}")
            if with_exceptions:
                run.exceptions().write.mode("overwrite").parquet(f"{path}/{EXCEPTIONS}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(score).option("checkpointLocation", f"{path}/_stream")
    return writer.trigger(**trigger).start() if trigger else writer.start()


def statistics_so_far(spark: SparkSession, path: str, by: str) -> DataFrame:
    """The statistics that a stream has learned, by group and column."""
    return statistics.describe(statistics.stored(spark, f"{path}/{STATISTICS}/{by}"), [by])


def scorecard_so_far(spark: SparkSession, path: str, rules: Sequence[Rule] = ()) -> DataFrame:
    """One scorecard over all batches; of `rules`, those about uniqueness are read from the key counts."""
    batches = spark.read.parquet(f"{path}/{SCORECARD}")
    text = [c for c in COUNTED if not c.endswith(("_Records", "_Failed"))]
    totals = batches.groupBy(*text).agg(
        F.sum("Total_Records").alias("Total_Records"), F.sum("Records_Failed").alias("Records_Failed")
    )
    for rule in rules:
        if isinstance(rule.check, Unique) and (found := keys.tally(spark, path, rule)) is not None:
            found = found.select(F.lit(rule.rule_id).alias("Rule_ID"), F.col("total").alias("Total_Records"), F.col("failed").alias("Records_Failed"))
            totals = totals.unionByName(found.join(F.broadcast(rule_table(spark, [rule])), "Rule_ID"))
    return finish_scorecard(totals)


def append_histories(scorecards: DataFrame, path: str) -> None:
    """Keep the scorecards of many runs at once, told apart by a column run_date; runs of dates that are there already are
    replaced, the others stay."""
    scorecards.repartition("run_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)


def append_history(scorecard: DataFrame, run_date: str, path: str) -> None:
    """Keep the scorecard of a run; a second run of the same date replaces it."""
    scorecard.coalesce(1).write.mode("overwrite").parquet(f"{path}/run_date={run_date}")


def rate_changes(history: DataFrame) -> DataFrame:
    """Per rule and run: the pass rate, that of the run before, and the change in percentage points."""
    before = F.lag("Pass_Rate_Pct").over(W.partitionBy("Rule_ID").orderBy("run_date"))
    rows = history.select("Rule_ID", "run_date", "Pass_Rate_Pct", before.alias("Previous_Rate_Pct"))
    return rows.withColumn("Change_Pct", F.round(F.col("Pass_Rate_Pct") - F.col("Previous_Rate_Pct"), 2))
