from collections import Counter

import pytest
from pyspark.sql import functions as F

from plumbline.operators import marks
from plumbline.operators.checks import unique
from plumbline.operators.rule import Scope
from plumbline.operators.run import Run
from plumbline.plans import packs
from plumbline.sources.tables import RECORD_ID, with_record_id


@pytest.fixture(scope="module")
def run(spark, sf_dir):
    lines = packs.with_month(with_record_id(spark.read.parquet(f"{sf_dir}/lineitem.parquet")))
    # far numbers make many buckets
    return Run(lines.withColumn(RECORD_ID, F.col(RECORD_ID) * 1000), packs.lineitem_rules(spark, sf_dir), as_of="2001-06")


def test_marks_count_what_the_scorecard_counts(run):
    found = marks.marks(run)
    assert found.select("bucket").distinct().count() > 100
    wanted = {r["Rule_ID"]: r["Records_Failed"] for r in run.scorecard().collect() if r["Records_Failed"]}
    assert {r["Rule_ID"]: r["records"] for r in marks.failed_records(found).collect()} == wanted
    assert marks.unique_failed(run, found).collect() == run.unique_failed().collect()
    pairs = Counter()
    for row in run.annotated().select("_failed_rules").collect():
        pairs.update((a, b) for a in row[0] for b in row[0] if a < b)
    assert {(r["Rule_ID"], r["With_Rule_ID"]): r["records"] for r in marks.failing_together(found).collect()} == dict(pairs)


def test_marks_without_failures(spark, run):
    none = Run(run.df.limit(0), run.rules, as_of="2001-06")
    found = marks.marks(none)
    assert found.count() == 0
    assert tuple(marks.unique_failed(none, found).first()) == (0, 0, 100.0)
    lenient = Run(run.df.drop("l_linenumber", "l_shipdate"), run.rules, as_of="2001-06", lenient=True)
    wanted = {r["Rule_ID"]: r["Records_Failed"] for r in lenient.scorecard().collect() if r["Records_Failed"]}
    assert {r["Rule_ID"]: r["records"] for r in marks.failed_records(marks.marks(lenient)).collect()} == wanted


def test_only_candidates_are_grouped_by_wide_keys(spark):
    rows = [(i, f"text {i}", None if i % 50 == 0 else i) for i in range(2000)] + [(5000 + i, "text 7", 7) for i in range(3)] + [(None, None, None)] * 2
    df = spark.createDataFrame(rows, "i long, t string, n long").repartition(4)
    for keys in (("t",), ("t", "n"), ("n",)):
        plain, narrow = unique(*keys), unique(*keys, candidates=True)
        scope = Scope(df.schema)
        repeated = {tuple(r) for r in plain.groups(df, scope).filter("_n > 1").collect()}
        assert {tuple(r) for r in narrow.groups(df, scope).filter("_n > 1").collect()} == repeated
        assert plain.tally(df, scope).collect() == narrow.tally(df, scope).collect()
        assert narrow.possible(df, scope).count() == sum(r[-1] for r in repeated)  # no other rows reach the grouping by keys
