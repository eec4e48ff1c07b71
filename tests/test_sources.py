import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import housing_rows

from plumbline.operators import scorecards
from plumbline.operators.remediate import remediate
from plumbline.operators.run import Run
from plumbline.plans import housing as pack
from plumbline.plans.fixture import housing
from plumbline.sources import outputs, tables


def test_csv_blank_and_null_texts_are_null(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text(
        "GEO,HOUSING_STARTS,REF_DATE,unknown\nOntario,12,2020-01,a\n,NA,,b\n\"New, Brunswick\",1.5,n/a,\nnull,,2020-02,NaN\n"
    )
    df = tables.read_table(spark, str(path), tables.HOUSING_SCHEMA, "csv")
    assert dict(df.dtypes) == {"GEO": "string", "HOUSING_STARTS": "double", "REF_DATE": "string", "unknown": "string"}
    assert [tuple(r) for r in df.collect()] == [
        ("Ontario", 12.0, "2020-01", "a"), (None, None, None, "b"), ("New, Brunswick", 1.5, None, None), (None, None, "2020-02", None),
    ]
    with pytest.raises(ValueError):
        tables.read_table(spark, str(path), fmt="csv")


def test_csv_quotes_line_ends_and_headers(spark, tmp_path):
    path = tmp_path / "q"
    path.mkdir()
    (path / "a.csv").write_text('GEO,STATUS\n"a ""b"" c","two\nlines"\n')
    df = tables.read_csv(spark, str(path), tables.HOUSING_SCHEMA, multiLine=True)
    assert [tuple(r) for r in df.collect()] == [('a "b" c', "two\nlines")]
    (path / "b.csv").write_text("STATUS,GEO\nx,y\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_csv(spark, str(path), tables.HOUSING_SCHEMA).collect()


def test_record_ids_over_several_files(spark, tmp_path):
    rows, sizes = 0, (10, 5000, 200)
    for i, n in enumerate(sizes):
        spark.range(rows, rows + n, numPartitions=1).write.mode("append").parquet(str(tmp_path / f"p/part={i}"))
        spark.range(rows, rows + n, numPartitions=1).write.option("header", True).csv(str(tmp_path / f"c/part={i}"))
        rows += n
    for df in (spark.read.parquet(str(tmp_path / "p")), spark.read.option("header", True).csv(str(tmp_path / "c"))):
        got = tables.with_record_id(df.select(F.col("id").cast("long").alias("id"))).collect()
        assert all(r["_record_id"] == r["id"] + 1 for r in got) and len(got) == rows


def test_a_clean_run_leaves_no_old_exceptions(spark, tmp_path):
    path = str(tmp_path / "out")
    for change, left in (({"HOUSING_STARTS": -1.0}, 1), ({}, None)):
        df = housing_rows(spark, change, {})
        run = Run(df, pack.rules()[:5], as_of="2026-12")
        fixed = remediate(df, pack.rules(), pack.REMEDIATION, "2026-12-01", as_of="2026-12")
        outputs.write_outputs(path, fixed, run.exceptions(), run.scorecard(), lambda s: scorecards.summary(s, "d", "x"), scorecards.by_dimension)
        back = tables.read_optional(spark, f"{path}/{outputs.EXCEPTIONS}")
        assert (back and back.count()) == left


def test_optional_table(spark, tmp_path):
    assert tables.read_optional(spark, str(tmp_path / "absent")) is None
    spark.range(3).write.parquet(str(tmp_path / "there"))
    assert tables.read_optional(spark, str(tmp_path / "there")).count() == 3


def test_column_gate_names_every_missing_column(spark):
    df = housing_rows(spark, {}).drop("GEO", "REF_DATE")
    with pytest.raises(ValueError, match="REF_DATE, GEO$"):
        tables.require_columns(df, pack.REQUIRED_COLUMNS)
    tables.require_columns(housing_rows(spark, {}), pack.REQUIRED_COLUMNS)


def test_template(spark):
    df = tables.empty_template(spark, [*pack.REQUIRED_COLUMNS, "STATUS"])
    assert df.columns == [*pack.REQUIRED_COLUMNS, "STATUS"] and df.count() == 0


def test_record_ids_follow_the_file(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("v\n" + "\n".join(f"row{i:05d}" for i in range(5000)) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = spark.read.option("header", True).csv(str(path))
        assert df.rdd.getNumPartitions() > 3
        rows = tables.with_record_id(df).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r["_record_id"], r["v"]) for r in rows) == [(i + 1, f"row{i:05d}") for i in range(5000)]


def joins(df):
    return set(re.findall(r"\w+Join\b", df._jdf.queryExecution().executedPlan().toString()))


def test_numbering_does_not_bring_a_file_into_one_task(spark, tmp_path):
    spark.range(50).write.parquet(str(tmp_path / "p"))
    spark.range(50).write.option("header", True).csv(str(tmp_path / "c"))
    rejects = lambda: tables.read_csv_lenient(spark, str(tmp_path / "c"), T._parse_datatype_string("id long"))[1]
    for df in (spark.read.parquet(str(tmp_path / "p")), spark.read.csv(str(tmp_path / "c")), spark.range(50), rejects):
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        try:
            assert joins(df() if df is rejects else tables.with_record_id(df)) == {"BroadcastHashJoin"}
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_record_ids_from_keys(spark):
    df = spark.createDataFrame([(1, "a")], "k int, l string")
    assert tables.with_record_id(df, ["k"]).first()["_record_id"] == 1
    assert tables.with_record_id(df, ["k", "l"]).first()["_record_id"] == '{"k":1,"l":"a"}'


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "NaN"), (1.0, None)], "d double, s string")
    assert [tuple(r) for r in tables.without_nan(df).collect()] == [(None, "NaN"), (1.0, None)]


def test_outputs_round_trip(spark, sf_dir, tmp_path):
    df = housing(spark, sf_dir)
    run = Run(df, pack.rules(), as_of="2026-12", run_ts="t")
    score = run.scorecard().cache()
    fixed = remediate(df, pack.rules(), pack.REMEDIATION, "2026-12-01", as_of="2026-12")
    path = str(tmp_path / "out")
    outputs.write_outputs(
        path, fixed, run.exceptions(), score, lambda s: scorecards.summary(s, "d", "x"), scorecards.by_dimension
    )
    back = tables.read_optional(spark, f"{path}/{outputs.EXCEPTIONS}")
    assert back.count() == 315
    plan = back.filter("_rule_id = 'DQ-002'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_rule_id" in plan
    assert back.filter("_rule_id = 'DQ-002'").count() == 40
    assert spark.read.parquet(f"{path}/{outputs.REMEDIATED}").count() == 1500
    assert spark.read.parquet(f"{path}/{outputs.SCORECARD}").count() == 15
    assert spark.read.parquet(f"{path}/{outputs.SUMMARY}").count() == 1


def test_no_exceptions_no_file(spark, tmp_path):
    df = housing_rows(spark, {}, {})
    run = Run(df, pack.rules()[:5], as_of="2026-12")
    score = run.scorecard().cache()
    fixed = remediate(df, pack.rules(), pack.REMEDIATION, "2026-12-01", as_of="2026-12")
    path = str(tmp_path / "out")
    outputs.write_outputs(path, fixed, run.exceptions(), score, lambda s: scorecards.summary(s, "d", "x"), scorecards.by_dimension)
    assert tables.read_optional(spark, f"{path}/{outputs.EXCEPTIONS}") is None


def test_csv_export(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, ["x"])], "s string, n int, l array<string>")
    outputs.export_csv(df, str(tmp_path / "e"))
    assert spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "e")).first().asDict() == {"s": "a", "n": "1", "l": '["x"]'}


def test_reference_tables_keep_quoted_commas(spark, tmp_path):
    (tmp_path / "g.csv").write_text('CDE,Rule\nA,"x, ""y"""\n')
    assert tables.read_reference(spark, str(tmp_path / "g.csv")).first().asDict() == {"CDE": "A", "Rule": 'x, "y"'}


def test_rejects_are_set_aside(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text('id,price,name\n1,2.5,x\ntwo,3,"a ""quoted"" one"\n3,NA,y\n4,5,z,surplus\n5,6\n')
    (folder / "b.csv").write_text("id,price,name\n6,much,\n7,8,w\nx,y,v\n")
    schema = "id long, price double, name string"
    good, rejects = tables.read_csv_lenient(spark, str(folder), T._parse_datatype_string(schema))
    assert sorted((r["id"], r["price"], r["name"]) for r in good.collect()) == [(1, 2.5, "x"), (3, None, "y"), (7, 8.0, "w")]
    got = {(r["file"].rsplit("/", 1)[1], r["row"]): (r["reason"], r["columns"]) for r in rejects.collect()}
    assert got == {
        ("a.csv", 2): ("cell", ["id"]), ("a.csv", 4): ("cells", []), ("a.csv", 5): ("cells", []),
        ("b.csv", 1): ("cell", ["price"]), ("b.csv", 3): ("cell", ["id", "price"]),
    }
    lines = {r["row"]: r["line"] for r in rejects.filter("file LIKE '%a.csv'").collect()}
    assert "surplus" in lines[4] and "two" in lines[2]
    with pytest.raises(ValueError, match="rename"):
        (folder / "c.csv").write_text("id,_place\n1,2\n")
        tables.read_csv_lenient(spark, str(folder / "c.csv"), T._parse_datatype_string(schema))


def test_rows_are_numbered_over_splits(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("id,price\n" + "".join(f"{i},{'x' if i % 100 == 0 else i}\n" for i in range(1, 3001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        good, rejects = tables.read_csv_lenient(spark, str(path), T._parse_datatype_string("id long, price long"))
        assert good.count() == 2970
        assert sorted(r["row"] for r in rejects.collect()) == list(range(100, 3001, 100))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
