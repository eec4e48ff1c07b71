"""Which records fail which rules, as bitmaps: a bit for each record, 32,768 records to a bitmap.

With numbered records (`tables.with_record_id`) the failing records of a rule are a few kilobytes for each bucket of records.
Rules are united and compared bucket by bucket, so records that fail any of several rules, also of several that look at many
rows, are counted without joining facts back to whole rows: a rule over many rows moves its key and the record's number only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.rates import share
from plumbline.operators.lookup import attach
from plumbline.operators.rule import GroupCheck
from plumbline.operators.run import Run
from plumbline.session import materialize
from plumbline.sources.tables import RECORD_ID


def _bucket(record: Column) -> Column:
    return F.bitmap_bucket_number(record).alias("bucket")


def _failing(run: Run, rule, record: str) -> DataFrame:
    """The numbers (`record`) of the records that fail a rule over many rows."""
    scope, check = run._scope(rule), rule.check
    present = [c for c in check.columns if scope.has(c)]
    narrow = run.df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*present, record])])
    # failing keys are counted with partial sums and heavy ones broadcast, so no key is a task of its own
    return attach(narrow, check.facts(narrow, scope)).filter(check.fails(scope)).select(F.col(f"`{record}`").alias("record"))


def marks(run: Run, record: str = RECORD_ID) -> DataFrame:
    """Rows (Rule_ID, bucket, marks) for every rule and bucket with failing records, written to the shared folder. `record` is
    a column of numbers that tell records apart, best without large gaps."""
    local = [r for r in run.rules if not isinstance(r.check, GroupCheck) or not run._runs(r)]
    number = F.col(f"`{record}`")
    parts = []
    if local:
        bits = [F.bitmap_construct_agg(F.when(run.mask(r), F.bitmap_bit_position(number))).alias(f"m{i}") for i, r in enumerate(local)]
        wide = run.with_stats().groupBy(_bucket(number)).agg(*bits)
        cells = F.array(*[F.struct(F.lit(r.rule_id).alias("Rule_ID"), F.col(f"m{i}").alias("marks")) for i, r in enumerate(local)])
        parts.append(wide.select("bucket", F.inline(cells)))
    for rule in run.group_rules:
        if run._runs(rule):
            found = _failing(run, rule, record).groupBy(_bucket(F.col("record"))).agg(F.bitmap_construct_agg(F.bitmap_bit_position("record")).alias("marks"))
            parts.append(found.select("bucket", F.lit(rule.rule_id).alias("Rule_ID"), "marks"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return materialize(out.filter(F.bitmap_count("marks") > 0).select("Rule_ID", "bucket", "marks"))


def failed_records(found: DataFrame) -> DataFrame:
    """Per rule the number of failing records, from `marks`."""
    return found.groupBy("Rule_ID").agg(F.sum(F.bitmap_count("marks")).alias("records"))


def unique_failed(run: Run, found: DataFrame) -> DataFrame:
    """As `Run.unique_failed`: records, those that fail at least one rule, and the share of clean ones."""
    any_rule = found.groupBy("bucket").agg(F.bitmap_count(F.bitmap_or_agg("marks")).alias("n"))
    counts = any_rule.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failed_records"))
    total = run.df.agg(F.count(F.lit(1)).alias("total_records"))
    both = total.join(F.broadcast(counts))  # one row each
    all_, bad = F.col("total_records"), F.col("failed_records")
    return both.select("total_records", "failed_records", share(all_ - bad, all_).alias("clean_pct"))


def failing_together(found: DataFrame) -> DataFrame:
    """Rows (Rule_ID, With_Rule_ID, records): pairs of rules, the smaller id first, that records fail both of."""
    one = found.select("Rule_ID", "bucket", "marks")
    other = found.select(F.col("Rule_ID").alias("With_Rule_ID"), F.col("bucket").alias("_bucket"), F.col("marks").alias("_marks"))
    pairs = one.join(other, (F.col("bucket") == F.col("_bucket")) & (F.col("Rule_ID") < F.col("With_Rule_ID")))
    both = pairs.select("Rule_ID", "With_Rule_ID", "bucket", F.explode(F.array("marks", "_marks")).alias("m"))
    both = both.groupBy("Rule_ID", "With_Rule_ID", "bucket").agg(F.bitmap_count(F.bitmap_and_agg("m")).alias("n"))
    return both.groupBy("Rule_ID", "With_Rule_ID").agg(F.sum("n").alias("records")).filter("records > 0")
