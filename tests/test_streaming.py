from pathlib import Path

import pytest
from helpers import by
from pyspark.sql import functions as F

from plumbline.operators.run import Run
from plumbline.plans import packs
from plumbline.plans.queries import QUERIES
from plumbline.streaming import keys, monitor


@pytest.fixture()
def setup(spark, sf_dir, tmp_path):
    lines = packs.lineitem(spark, sf_dir)
    rules = [r for r in packs.lineitem_rules(spark, sf_dir) if r.rule_id not in ("LI-007", "LI-010")]
    source = tmp_path / "in"
    lines.repartition(3, "l_orderkey").write.parquet(str(source))
    return lines, rules, str(source), str(tmp_path / "out")


def start(spark, rules, stats, source, path, lines):
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(source)
    monitor.score_stream(stream, rules, path, as_of="2001-06", run_ts="t", stats=stats, availableNow=True).awaitTermination()


def test_batches_add_up_to_the_table(spark, setup):
    lines, rules, source, path = setup
    stats = monitor.snapshot(lines, rules)
    start(spark, rules, stats, source, path, lines)
    assert spark.read.parquet(f"{path}/scorecard").select("batch_id").distinct().count() == 3
    whole = Run(lines, rules, as_of="2001-06")
    assert by(monitor.scorecard_so_far(spark, path), "Rule_ID") == by(whole.scorecard(), "Rule_ID")
    assert spark.read.parquet(f"{path}/exceptions").count() == whole.exceptions().count()
    # Starting again finds nothing new; new files make a new batch.
    start(spark, rules, stats, source, path, lines)
    lines.limit(10).coalesce(1).write.mode("append").parquet(source)
    start(spark, rules, stats, source, path, lines)
    total = monitor.scorecard_so_far(spark, path).first()["Total_Records"]
    assert total == lines.count() + 10


def test_rules_over_all_rows_are_refused(spark, sf_dir, setup):
    lines, rules, source, path = setup
    stream = spark.readStream.schema(lines.schema).parquet(source)
    with pytest.raises(ValueError, match="LI-007"):
        monitor.score_stream(stream, packs.lineitem_rules(spark, sf_dir)[6:7], path)
    with pytest.raises(ValueError, match="snapshot"):
        monitor.score_stream(stream, [r for r in rules if r.rule_id == "LI-008"], path)


def test_history(spark, sf_dir, tmp_path):
    path = str(tmp_path / "h")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    for day, df in (("2026-01-01", customers), ("2026-02-01", customers.filter("c_acctbal >= 0")), ("2026-02-01", customers.filter("c_acctbal > 10"))):
        monitor.append_history(Run(df, packs.customer_rules()).scorecard(), day, path)
    rows = monitor.rate_changes(spark.read.parquet(path)).orderBy("run_date").collect()
    assert [r["Previous_Rate_Pct"] for r in rows] == [None, rows[0]["Pass_Rate_Pct"]]
    assert rows[1]["Change_Pct"] == round(100 - rows[0]["Pass_Rate_Pct"], 2)


def test_the_query_streams_a_folder_of_files(spark, sf_dir, tmp_path):
    for name in ("lineitem", "orders"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(6).write.parquet(str(tmp_path / f"{name}.parquet"))
    one, many = (by(QUERIES["stream_scorecard"](spark, d), "Rule_ID") for d in (sf_dir, str(tmp_path)))
    assert one == many and len(one) == 10


def count(spark, rule, source, path, lines):
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(source)
    for started in keys.count_keys(stream, [rule], path, availableNow=True):
        started.awaitTermination()


def test_keys_are_counted_over_batches_and_again(spark, sf_dir, tmp_path):
    lines = packs.lineitem(spark, sf_dir)
    lines = lines.withColumn("l_linenumber", F.when(F.col("l_linenumber") != 2, F.col("l_linenumber")))  # NULL is a key like any other
    rule = next(r for r in packs.lineitem_rules(spark, sf_dir) if r.rule_id == "LI-007")
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    lines.repartition(3, "l_partkey").write.parquet(source)
    assert keys.tally(spark, path, rule) is None and keys.copies(spark, path, rule) is None
    count(spark, rule, source, path, lines)
    whole = Run(lines, [rule])
    wanted = (lines.count(), whole.failing_rows("LI-007").count())
    assert tuple(keys.tally(spark, path, rule).first()) == wanted
    # the last batch again, as after a failure between its log and its commit
    commits = Path(path) / keys.KEYS / "LI-007" / "stream" / "commits"
    last = max(int(f.name) for f in commits.iterdir() if f.name.isdigit())
    assert last == 2
    (commits / str(last)).unlink()
    (commits / f".{last}.crc").unlink(missing_ok=True)
    count(spark, rule, source, path, lines)
    assert tuple(keys.tally(spark, path, rule).first()) == wanted
    assert sum(r["newly_failed"] for r in keys.failed_by_batch(spark, path, rule).collect()) == wanted[1]
    found = {tuple(r)[:2]: r["_n"] for r in keys.copies(spark, path, rule).collect()}
    assert found == {(r["l_orderkey"], r["l_linenumber"]): r["duplicate_count"] for r in whole.duplicate_groups("LI-007").collect()}
    # new files are counted on top of what is there
    lines.limit(10).coalesce(1).write.mode("append").parquet(source)
    count(spark, rule, source, path, lines)
    assert keys.tally(spark, path, rule).first()["total"] == wanted[0] + 10


def test_learned_statistics(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    events.repartition(3, "event_id").write.parquet(source)
    rules = packs.event_rules()
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    monitor.score_stream(stream, rules, path, learn=True, availableNow=True).awaitTermination()
    # the last batch was scored by the statistics of all rows
    files = [r[0] for r in stream_files(spark, source)]
    last = Run(spark.read.parquet(files[-1]), rules, stats=monitor.snapshot(events, rules))
    got = spark.read.parquet(f"{path}/scorecard/batch_id=2")
    assert by(got, "Rule_ID") == by(last.scorecard(), "Rule_ID")


def stream_files(spark, source):
    """Files in the order in which a stream reads them: by time, then name."""
    files = sorted(Path(source).glob("part-*.parquet"), key=lambda f: (f.stat().st_mtime_ns // 10**6, str(f)))
    return [(str(f),) for f in files]
