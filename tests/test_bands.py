import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plumbline.operators import bands as b
from plumbline.operators import governance as g
from plumbline.plans import governance_data as gov

SCHEMA = "name string, low string, high string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("most", [100_000, 0])
def test_values_meet_their_band(spark, most):
    draw = random.Random(3)
    edges = sorted({Decimal(draw.randrange(-500, 500)) / 8 for _ in range(60)})
    named = [(f"b{i}", str(x), str(y)) for i, (x, y) in enumerate(zip(edges, edges[1:], strict=False))]
    named = [("below", None, str(edges[0])), *named, ("above", str(edges[-1]), "")]
    checked = b.bands(frame(spark, named), "low", "high")
    values = [float(x) for x in edges] + [draw.uniform(-80, 80) for _ in range(300)] + [None, float("nan"), -1e12, 1e12]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v double")
    got = {r["i"]: r["name"] for r in b.in_band(rows, checked, F.col("v"), max_broadcast=most).collect()}
    assert len(got) == len(values)
    for i, v in enumerate(values):
        if v is None or v != v:
            assert got[i] is None
        else:
            assert got[i] == next(n for n, x, y in named if (x is None or v >= float(x)) and (not y or v < float(y)))


def test_ratios_are_compared_exactly(spark):
    named = [("low", "0", "5"), ("mid", "5", "15"), ("high", "15", None)]
    checked = b.bands(frame(spark, named).withColumns({"low_in": F.col("name") != "high", "high_in": F.col("name") == "mid"}), "low", "high", "low_in", "high_in")
    rows = spark.createDataFrame([(1, 5, 100), (2, 15, 100), (3, 4, 100), (4, 1_500_000_000_000_001, 10**16), (5, 3, 20), (6, 150, 1000), (7, 7, 0)], "i long, part long, whole long")
    found = {r["i"]: r["name"] for r in b.in_band(rows, checked, F.col("part") * 100, F.col("whole")).collect()}
    assert found == {1: "mid", 2: "mid", 3: "low", 4: "high", 5: "mid", 6: "mid", 7: None}


def test_values_outside_have_no_band(spark):
    checked = b.bands(frame(spark, [("a", "0", "1"), ("b", "1", "2")]), "low", "high")
    rows = spark.createDataFrame([(-0.5,), (0.0,), (1.0,), (2.0,)], "v double")
    assert [r["name"] for r in b.in_band(rows, checked, F.col("v")).orderBy("v").collect()] == [None, "a", "b", None]


@pytest.mark.parametrize(
    "rows",
    [
        [("a", "0", "2"), ("b", "1", "3")],  # overlap
        [("a", "0", "1"), ("b", "2", "3")],  # gap
        [("a", "0", "1"), ("b", "0", "1")],  # twice
        [("a", "0", "3"), ("b", "1", "2")],  # one in another
        [("a", None, "3"), ("b", None, "2"), ("c", "3", None)],
        [("a", "0", None), ("b", "1", None)],
        [("a", "2", "1")],
        [("a", "0", "x")],
        [],
    ],
)
def test_bad_bands_raise(spark, rows):
    with pytest.raises(ValueError):
        b.bands(frame(spark, rows), "low", "high")


def test_a_bound_belongs_to_one_side(spark):
    both = frame(spark, [("a", "0", "1"), ("b", "1", "2")])
    for low_in, high_in in ((True, True), (False, False)):
        with pytest.raises(ValueError, match="overlap"):
            b.bands(both.withColumns({"l": F.lit(low_in), "h": F.lit(high_in)}), "low", "high", "l", "h")


def test_escalation_bands_equal_the_constant(spark):
    checked = g.escalation_bands(spark.createDataFrame(gov.BANDS, gov.BAND_SCHEMA))
    rows = [(f"R{f}-{t}", "x", f, t) for t in (100, 300, 1000) for f in range(0, t, 1 + t // 100)]
    score = spark.createDataFrame(rows, "Rule_ID string, CDE_Affected string, Records_Failed long, Total_Records long")
    assert sorted(g.escalation(score).collect()) == sorted(g.escalation(score, checked).collect())
    with pytest.raises(ValueError):
        g.escalation_bands(spark.createDataFrame(gov.BANDS[:1] + gov.BANDS[2:], gov.BAND_SCHEMA))
