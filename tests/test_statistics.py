import math

from pyspark.sql import functions as F

from plumbline.operators import statistics
from plumbline.operators.checks import sigma_outlier
from plumbline.operators.run import group_stats
from plumbline.operators.rule import Scope

ROWS = [("a", 1e9 + 1), ("a", 1e9 + 2), ("a", None), ("a", 1e9 + 4), ("b", math.nan), ("b", -3.0), (None, 5.0), (None, 7.0), ("c", None)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "g string, v double")


def numbers(df):
    return {
        r["g"]: (r["records"], r["missing"], r["mean"], None if r["stddev"] is None else round(r["stddev"], 6), r["low"], r["high"], r["distinct_estimate"])
        for r in df.collect()
    }


def test_parts_add_up(spark, tmp_path):
    wanted = numbers(statistics.describe(statistics.state(frame(spark), ["g"], ["v"]), ["g"]))
    assert wanted["a"] == (4, 1, 1e9 + 7 / 3, round(math.sqrt(7 / 3), 6), 1e9 + 1, 1e9 + 4, 3)
    assert wanted["b"] == (2, 1, -3.0, None, -3.0, -3.0, 1) and wanted["c"][:3] == (1, 1, None) and wanted[None][0] == 2
    path = str(tmp_path / "s")
    for part in range(3):
        statistics.store(statistics.state(frame(spark, ROWS[part::3]), ["g"], ["v"]), path, part)
    got = numbers(statistics.describe(statistics.stored(spark, path), ["g"]))
    assert {k: v[:2] + v[4:] for k, v in got.items()} == {k: v[:2] + v[4:] for k, v in wanted.items()}
    assert all(abs((got[k][2] or 0) - (wanted[k][2] or 0)) < 1e-6 and abs((got[k][3] or 0) - (wanted[k][3] or 0)) < 1e-5 for k in wanted)
    # storing a part again changes nothing, and a merged state merges on
    statistics.store(statistics.state(frame(spark, ROWS[1::3]), ["g"], ["v"]), path, 1)
    assert numbers(statistics.describe(statistics.stored(spark, path), ["g"])) == got
    statistics.compact(spark, path, str(tmp_path / "c"), ["g"])
    again = numbers(statistics.describe(statistics.stored(spark, str(tmp_path / "c")), ["g"]))
    assert {k: v[:2] for k, v in again.items()} == {k: v[:2] for k, v in got.items()}
    assert numbers(statistics.describe(statistics.stored(spark, path, [0]), ["g"])).keys() == {r[0] for r in ROWS[0::3]}


def test_quartiles_are_near(spark):
    df = spark.range(20_000).select(F.lit("x").alias("g"), F.col("id").cast("double").alias("v"))
    parts = [statistics.state(df.filter(F.col("v") % 4 == k), ["g"], ["v"]) for k in range(4)]
    states = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    row = statistics.describe(states, ["g"]).first()
    assert all(abs(row[q] / 20_000 - share) < 0.03 for q, share in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)))
    assert abs(row["distinct_estimate"] - 20_000) < 1000


def test_facts_equal_those_from_rows(spark):
    df = frame(spark)
    check = sigma_outlier("v", by="g")
    wanted = {r["g"]: r for r in group_stats(df, Scope(df.schema), "g", [check]).df.collect()}
    got = {r["g"]: r for r in statistics.sigma_facts(statistics.state(df, ["g"], ["v"]), "g", [check], df.schema).df.collect()}
    assert got.keys() == wanted.keys()
    for g, r in wanted.items():
        assert got[g]["_n"] == r["_n"]
        for c in (check.mean, check.std):
            assert (got[g][c] is None) == (r[c] is None) and (r[c] is None or abs(got[g][c] - r[c]) < 1e-6)
