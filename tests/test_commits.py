import pytest

from plumbline.sources import commits


def writer(spark, n, fail_at=None):
    def write(folder):
        for name in ("one", "two", "three"):
            if name == fail_at:
                raise RuntimeError("broken")
            spark.range(n).write.parquet(f"{folder}/{name}")

    return write


NAMES = ("one", "two", "three")


def counts(spark, path):
    seen = commits.committed(spark, path)
    return [commits.read_committed(spark, path, n, seen).count() for n in NAMES]


def test_readers_see_whole_runs_only(spark, tmp_path):
    path = str(tmp_path / "t")
    assert commits.committed(spark, path) is None and commits.read_committed(spark, path, "one") is None
    with pytest.raises(RuntimeError):
        commits.commit_tables(spark, path, writer(spark, 3, "two"), NAMES)
    assert commits.committed(spark, path) is None
    commits.commit_tables(spark, path, writer(spark, 5), NAMES, "a")
    for broken in NAMES:
        with pytest.raises(RuntimeError):
            commits.commit_tables(spark, path, writer(spark, 9, broken), NAMES)
        assert counts(spark, path) == [5, 5, 5]
    assert commits.commit_tables(spark, path, writer(spark, 7), NAMES, "b")["number"] == 2
    assert counts(spark, path) == [7, 7, 7]
    assert [m["note"] for m in commits.history(spark, path)] == ["a", "b"]
    assert commits.read_committed(spark, path, "four") is None


def test_a_commit_during_another_takes_the_next_number(spark, tmp_path):
    path = str(tmp_path / "t")

    def late(folder):
        commits.commit_tables(spark, path, writer(spark, 1), NAMES, "inner")
        writer(spark, 2)(folder)

    commits.commit_tables(spark, path, late, NAMES, "outer")
    assert [(m["number"], m["note"]) for m in commits.history(spark, path)] == [(1, "inner"), (2, "outer")]
    # a number that another run has taken without having committed yet is passed over
    (tmp_path / "t" / commits.MANIFESTS / f"{3:012d}.taken").write_text("x")
    assert commits.commit_tables(spark, path, writer(spark, 3), NAMES)["number"] == 4
    assert counts(spark, path) == [3, 3, 3]


def test_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    runs = [commits.commit_tables(spark, path, writer(spark, n), NAMES)["run"] for n in (1, 2, 3)]
    with pytest.raises(RuntimeError):
        commits.commit_tables(spark, path, writer(spark, 9, "two"), NAMES)
    assert commits.vacuum(spark, path, keep=2) == runs[:1]
    assert [m["run"] for m in commits.history(spark, path)] == runs[1:]
    assert counts(spark, path) == [3, 3, 3]
    assert len(commits.vacuum(spark, path, keep=2, abandoned_s=-1)) == 1  # the broken run
    assert commits.commit_tables(spark, path, writer(spark, 4), NAMES)["number"] == 4


def test_tables_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")

    def write(folder):
        spark.range(3).selectExpr("id", "id % 2 AS part").filter("id < 0").write.partitionBy("part").parquet(f"{folder}/one")

    commits.commit_tables(spark, path, write, ["one"])
    assert commits.read_committed(spark, path, "one").count() == 0
