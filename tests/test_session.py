"""The shared folder: what is written there, told apart and released."""

from plumbline import session
from plumbline.plans.fixture import housing


def test_release_deletes_what_was_written(spark, sf_dir, tmp_path):
    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    try:
        rows = session.write_rows(spark.range(5))
        assert rows.count() == 5 and session.materialize(rows).count() == 5
        n = housing(spark, sf_dir).count()
        path = rows.inputFiles()[0]
        assert session.is_there(spark, path)
        session.release(spark)
        assert not session.is_there(spark, path)
        assert housing(spark, sf_dir).count() == n
    finally:
        spark.sparkContext.setCheckpointDir(before or str(tmp_path))


def test_a_changed_table_is_another(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    one = session.file_states(spark, path)
    assert one == session.file_states(spark, path)
    spark.range(4).write.mode("overwrite").parquet(path)
    assert one != session.file_states(spark, path)
