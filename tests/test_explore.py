import re

import pytest
from helpers import by
from pyspark.sql import functions as F

from plumbline.operators import explore, rca
from plumbline.operators.run import Run
from plumbline.plans import housing as pack
from plumbline.plans.fixture import housing


@pytest.fixture(scope="module")
def exceptions(spark, sf_dir):
    return Run(housing(spark, sf_dir), pack.rules(), as_of="2026-12", run_ts="t").exceptions().cache()


def test_filters(exceptions):
    assert explore.filter_exceptions(exceptions).count() == 315
    assert explore.filter_exceptions(exceptions, rule="DQ-002").count() == 40
    assert explore.filter_exceptions(exceptions, dimension="Uniqueness", rule="DQ-010").count() == 139
    assert explore.filter_exceptions(exceptions.drop("GEO_CODE"), rule="DQ-002", geo="ON").count() == 40
    assert explore.project_existing(exceptions, ["GEO", "nowhere"]).columns == ["GEO"]


def test_options_are_sorted_without_null(exceptions):
    found = [r["option"] for r in explore.options(exceptions, "GEO_CODE").collect()]
    assert found == sorted(found) and None not in found and "XX" in found


def test_counts(exceptions):
    assert explore.exception_counts(exceptions).first().asDict() == {"exceptions": 315, "rules": 15}
    assert explore.exception_counts(exceptions.limit(0)).first().asDict() == {"exceptions": 0, "rules": 0}


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([(v,) for v in "bbaaccd"] + [(None,)], "v string")
    assert [tuple(r) for r in explore.top_values(df, "v", 3).collect()] == [("a", 2), ("b", 2), ("c", 2)]
    assert explore.top_values(df, "v", None).count() == 4


def test_pages_by_number_and_by_key_agree(exceptions):
    order = ["record_key", "_rule_id"]
    whole = [tuple(r) for r in exceptions.orderBy(*order).select(*order).collect()]
    assert explore.page_count(315) == 4 and explore.page_count(0) == 1 and explore.page_count(300) == 3
    pages = [[tuple(r) for r in explore.page(exceptions, order, p).select(*order).collect()] for p in (1, 2, 3, 4)]
    assert sum(pages, []) == whole
    for i in (0, 1, 2):
        after = explore.page_after(exceptions, order, pages[i][-1]).select(*order).collect()
        assert [tuple(r) for r in after] == pages[i + 1]


def test_root_causes(exceptions):
    from pyspark.sql import functions as F

    causes = rca.root_causes(exceptions, pack.ROOT_CAUSES, {"year": F.substring("REF_DATE", 1, 4)})
    rows = causes.filter("breakdown = 'negative_starts_by_province'")
    assert rows.agg(F.sum("failures")).first()[0] == 40
    top = by(rca.top_causes(causes), "breakdown")
    for name, row in top.items():
        best = causes.filter(F.col("breakdown") == name).orderBy(F.desc("failures"), "key").first()
        assert (row["top_key"], row["top_failures"]) == (best["key"], best["failures"])
    assert rca.root_causes(exceptions.limit(0), pack.ROOT_CAUSES, {"year": F.lit("x")}).count() == 0


def test_a_rule_can_have_two_breakdowns(exceptions):
    spec = [("a", "DQ-002", "GEO_CODE"), ("b", "DQ-002", "DWELLING_TYPE"), ("c", "DQ-002", "absent")]
    causes = rca.root_causes(exceptions, spec)
    totals = {r["breakdown"]: r["sum(failures)"] for r in causes.groupBy("breakdown").sum("failures").collect()}
    assert totals == {"a": 40, "b": 40}


def test_stored_pages(spark, tmp_path):
    rows = [(i % 97, f"k{i}", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a long, b string, c long").repartition(5)
    path = str(tmp_path / "pages")
    explore.store_pages(df, ["a", "b"], path, range_rows=100)
    ordered = sorted(rows)
    for number in (1, 2, 7, 33, 34, 35):
        got = [tuple(r) for r in explore.stored_page(spark, path, ["a", "b"], number, size=30).collect()]
        assert got == ordered[(number - 1) * 30 : number * 30]

    def ranges(number):
        page = explore.stored_page(spark, path, ["a", "b"], number, size=30)
        found = page._jdf.queryExecution().optimizedPlan().toString()
        return len(re.findall(r"_range#\d+ = \d+", found)) or len(re.search(r"_range#\d+ IN \(([^)]*)\)", found).group(1).split(","))

    # a far page reads what a near one reads
    assert {ranges(n) for n in (1, 17, 33)} <= {1, 2}
    explore.store_pages(df.limit(0), ["a", "b"], str(tmp_path / "none"))
    assert explore.stored_page(spark, path, ["a", "b"], 99).count() == 0
    assert explore.stored_page(spark, str(tmp_path / "none"), ["a", "b"], 1).collect() == []


def test_short_ranges_share_a_part(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(explore, "PART_ROWS", 1000)
    rows = [(i % 97, f"k{i}", i) for i in range(3000)]
    path = str(tmp_path / "pages")
    explore.store_pages(spark.createDataFrame(rows, "a long, b string, c long").repartition(5), ["a", "b"], path, range_rows=10)
    # 300 ranges, but a folder for each thousand rows
    assert len(list((tmp_path / "pages" / "rows").glob("_part=*"))) == 3
    ordered = sorted(rows)
    for number in (1, 33, 34, 35, 66, 67, 68, 100):  # pages over the seams of ranges and parts
        got = [tuple(r) for r in explore.stored_page(spark, path, ["a", "b"], number, size=30).collect()]
        assert got == ordered[(number - 1) * 30 : number * 30]
    with pytest.raises(ValueError, match="_part"):
        explore.store_pages(spark.range(1).withColumn("_part", F.lit(1)), ["id"], path)
