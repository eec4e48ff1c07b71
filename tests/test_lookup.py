from pyspark.sql import functions as F

from plumbline.operators import checks as c
from plumbline.operators import lookup
from plumbline.operators.lookup import Facts, attach
from plumbline.operators.run import Run
from plumbline.plans import packs


def skewed(spark, n=6000):
    """One key with a third of the rows, a third without key, the rest spread."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 1500))
    return spark.range(n).select("id", key.alias("k"), (F.col("id") % 7).cast("double").alias("v"))


def facts_of(rows):
    stats = rows.groupBy("k").agg(F.count(F.lit(1)).alias("_n"), F.sum("v").alias("s"))
    return Facts(stats, ("k",), ("s",)).materialized()


def joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {j: plan.count(j + " [") for j in ("BroadcastHashJoin", "SortMergeJoin")}


def test_all_ways_of_joining_agree(spark):
    rows = skewed(spark)
    facts = facts_of(rows)
    small, split = attach(rows, facts), attach(rows, facts, max_rows=0)
    assert sorted(small.collect(), key=str) == sorted(split.collect(), key=str)
    assert small.count() == 6000
    assert None not in {r["s"] for r in small.filter("k IS NULL").collect()}
    # Without a heavy key no split is needed.
    even = rows.filter("k LIKE 'k%' AND id < 2000").withColumn("k", F.concat("k", "id"))
    plain = attach(even, facts_of(even), max_rows=0)
    assert sorted(plain.collect()) == sorted(attach(even, facts_of(even)).collect())


def test_heavy_rows_are_spread(spark):
    rows = skewed(spark)
    facts = facts_of(rows)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        # Heavy rows find their facts in a broadcast join; in the shuffle join they meet nothing and stand everywhere.
        split = attach(rows, facts, max_rows=0)
        assert joins(split) == {"BroadcastHashJoin": 1, "SortMergeJoin": 1}
        sizes = [r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2 * sum(sizes) / len(sizes)
        assert joins(attach(rows, facts)) == {"BroadcastHashJoin": 1, "SortMergeJoin": 0}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    heavy = facts.df.filter(F.col("_n") * lookup.HEAVY > facts.size["weight"]).count()
    assert heavy == 2  # the hot key and the missing key
    assert heavy < lookup.HEAVY


def test_two_heavy_facts_read_the_rows_once(spark, tmp_path):
    skewed(spark).withColumnRenamed("v", "w").withColumn("v", F.col("w")).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    other = rows.groupBy("v").agg(F.count(F.lit(1)).alias("_n"), F.max("id").alias("t"))
    both = [facts_of(rows), Facts(other, ("v",), ("t",)).materialized()]
    joined = lookup.attach_all(rows, both, max_rows=0)
    assert joined._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sorted(joined.collect(), key=str) == sorted(lookup.attach_all(rows, both).collect(), key=str)


def test_rules_give_the_same_beyond_the_broadcast_limit(spark, sf_dir, monkeypatch):
    df = packs.lineitem(spark, sf_dir)

    def results():
        run = Run(df, packs.lineitem_rules(spark, sf_dir), as_of="2001-06")
        ids = run.annotated().groupBy(F.array_join("_failed_rules", ",").alias("ids")).count()
        return sorted(ids.collect()), sorted(run.scorecard().collect())

    small = results()
    monkeypatch.setattr(attach, "__defaults__", (0, 0))
    monkeypatch.setattr(lookup.attach_all, "__defaults__", (0, 0))
    assert results() == small


def test_hot_group_of_copies(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.col("id").cast("string")).alias("t"))
    run = Run(rows, [packs.rule("U", "unique", "Uniqueness", "t", c.unique("t"))])
    assert run.scorecard().first()["Records_Failed"] == 1000
    assert run.failing_rows("U").count() == 1000


def test_long_heavy_keys_are_not_broadcast(spark, monkeypatch):
    rows = skewed(spark)
    facts = facts_of(rows)
    expected = sorted(attach(rows, facts).collect(), key=str)
    monkeypatch.setattr(lookup, "HEAVY_BYTES", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plain = attach(rows, facts, max_rows=0)
        assert joins(plain) == {"BroadcastHashJoin": 0, "SortMergeJoin": 1}
        assert sorted(plain.collect(), key=str) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_digests_find_the_same_copies(spark):
    rows = [(i, t) for i, t in enumerate(["a" * 50000, "b", "a" * 50000, None, "", None, "b ", "ä"])]
    df = spark.createDataFrame(rows, "i int, t string")
    for digest in (False, True):
        run = Run(df, [packs.rule("U", "unique", "Uniqueness", "t", c.unique("t", digest=digest))])
        assert sorted(r["i"] for r in run.failing_rows("U").collect()) == [0, 2, 3, 5]
        assert run.unique_failed().first()["failed_records"] == 4
        assert run.scorecard().first()["Records_Failed"] == 4
