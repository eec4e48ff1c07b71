import math

from helpers import failing, one

from plumbline.operators import checks as c
from plumbline.operators.run import Run

NAN = float("nan")


def same(a, b):
    return len(a) == len(b) and all(
        x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
        for x, y in zip(a, b, strict=True)
    )


def test_not_null_counts_nan_but_not_blank(spark):
    assert same(failing(spark, c.not_null("v"), [1.0, None, NAN, 0.0], "double"), [None, NAN])
    assert failing(spark, c.not_null("v"), ["a", "", " ", None], "string") == [None]


def test_not_null_unless(spark):
    df = spark.createDataFrame([(1, None, "F"), (2, None, None), (3, None, ""), (4, 1.0, "E"), (5, NAN, "r")], "i int, p double, s string")
    found = Run(df, [one(c.not_null("p", unless=("s", "F")))]).failing_rows("X-001")
    assert sorted(r["i"] for r in found.collect()) == [2, 3, 5]


def test_bounds_let_null_nan_and_the_bound_pass(spark):
    values = [None, NAN, -0.01, 0.0, 0.01, 2_000_000.0, 2_000_000.01]
    assert failing(spark, c.non_negative("v"), values, "double") == [-0.01]
    assert failing(spark, c.max_value("v", 2_000_000), values, "double") == [2_000_000.01]
    assert failing(spark, c.Bounds("v", low=0, high=2_000_000), values, "double") == [-0.01, 2_000_000.01]
    assert failing(spark, c.Bounds("v", low=0, high=2_000_000, strict=True), values, "double") == [
        -0.01, 0.0, 2_000_000.0, 2_000_000.01,
    ]
    assert failing(spark, c.min_value("v", 0.01), values, "double") == [-0.01, 0.0]


def test_domain(spark):
    values = ["a", "b", "A", " a", "", None]
    assert failing(spark, c.in_domain("v", ["a", "b"]), values, "string") == ["A", " a", "", None]
    assert failing(spark, c.in_domain("v", ["a", "b"], null_passes=True), values, "string") == ["A", " a", ""]
    assert failing(spark, c.in_domain("v", ["a", "b", ""], null_as=""), values, "string") == ["A", " a"]


def test_month_pattern_accepts_month_13(spark):
    values = ["2020-01", "2020-13", "2020/01", "2020-1", "2020-01x", "x2020-01", "", None]
    pattern = "^[0-9]{4}-[0-9]{2}$"
    assert failing(spark, c.matches("v", pattern), values, "string") == ["2020/01", "2020-1", "2020-01x", "x2020-01", "", None]
    assert None not in failing(spark, c.matches("v", pattern, null_passes=True), values, "string")


def test_not_after(spark):
    values = ["2026-11", "2026-12", "2027-01", "nan", None]
    assert failing(spark, c.not_after("v"), values, "string") == ["2027-01", "nan", None]
    assert failing(spark, c.not_after("v", null_fails=False), values, "string") == ["2027-01", "nan"]
    assert failing(spark, c.not_after("v", "2026-11"), values, "string") == ["2026-12", "2027-01", "nan", None]


def test_mapping(spark):
    rows = [(1, "Ontario", "ON"), (2, "Ontario", "QC"), (3, "Ontario", None), (4, "Atlantis", "XX"), (5, None, "ON")]
    df = spark.createDataFrame(rows, "i int, n string, c string")
    found = Run(df, [one(c.maps_to("n", "c", {"Ontario": "ON"}))]).failing_rows("X-001")
    assert sorted(r["i"] for r in found.collect()) == [2, 3]


def test_compare_needs_both_sides(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0), (2, 1.0, 1.0), (3, 0.0, 1.0), (4, None, 1.0), (5, NAN, 1.0)], "i int, a double, b double")
    found = Run(df, [one(c.compare("a", ">", "b"))]).failing_rows("X-001")
    assert sorted(r["i"] for r in found.collect()) == [2, 3]


def test_where_takes_sql_or_a_function(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "i int, a int")
    for predicate in ("a > 5", lambda scope: scope.col("a") > 5):
        assert [r["i"] for r in Run(df, [one(c.where(predicate, ["a"]))]).failing_rows("X-001").collect()] == [3]


def sigma_table(spark):
    rows = [("g", 10.0)] * 20 + [("g", 100.0), ("lone", 50.0), ("lone2", 20001.0), (None, 20001.0), (None, 5.0), ("g", None), ("g", NAN)]
    rows += [("void", None), ("void", None)]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, k string, v double")


def test_sigma(spark):
    df = sigma_table(spark)
    run = Run(df, [one(c.sigma_outlier("v", by="k", high=20000))])
    # The outlier of g; lone rows and rows without a group are held to the cap only.
    assert sorted(r["i"] for r in run.failing_rows("X-001").collect()) == [20, 22, 23]


def test_sigma_floor_and_two_sides(spark):
    rows = [(i, "g", 10.0 + i % 3) for i in range(30)] + [(30, "g", -60.0), (31, "g", None)]
    df = spark.createDataFrame(rows, "i int, k string, v double")
    upper = Run(df, [one(c.sigma_outlier("v", by="k"))]).failing_rows("X-001")
    both = Run(df, [one(c.sigma_outlier("v", by="k", two_sided=True))]).failing_rows("X-001")
    floor = Run(df, [one(c.sigma_outlier("v", by="k", low=10.5))]).failing_rows("X-001")
    assert upper.count() == 0
    assert [r["i"] for r in both.collect()] == [30]
    assert sorted(r["i"] for r in floor.collect()) == [*range(0, 30, 3), 30]


def test_unique_takes_nulls_as_equal_and_fails_every_copy(spark):
    rows = [(1, "a", None), (2, "a", None), (3, "a", "x"), (4, None, None), (5, None, "x"), (6, None, "x")]
    df = spark.createDataFrame(rows, "i int, k string, l string")
    run = Run(df, [one(c.unique("k", "l"))])
    assert sorted(r["i"] for r in run.failing_rows("X-001").collect()) == [1, 2, 5, 6]
    assert run.scorecard().first()["Records_Failed"] == 4
    assert sorted(r["duplicate_count"] for r in run.duplicate_groups("X-001").collect()) == [2, 2]


def test_reference(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z"), (5, "z")], "i int, k string")
    ref = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "r string")
    for null_passes, expected in ((False, [3, 4, 5]), (True, [4, 5])):
        run = Run(df, [one(c.in_reference("k", ref, "r", null_passes=null_passes))])
        assert sorted(r["i"] for r in run.failing_rows("X-001").collect()) == expected
        assert run.scorecard().first()["Records_Failed"] == len(expected)
        assert run.unique_failed().first()["failed_records"] == len(expected)
