"""Queries that write files for themselves: larger tables make more files, not larger ones."""

import pytest

from plumbline.plans import io_queries
from plumbline.plans.queries import QUERIES


@pytest.fixture
def written(monkeypatch, tmp_path):
    """The folder that the queries write to, in files of 100 rows."""
    monkeypatch.setattr(io_queries, "FILE_ROWS", 100)
    monkeypatch.setattr(io_queries, "_folder", lambda spark, name: str(tmp_path / name))
    return tmp_path


def test_a_numbered_folder_has_files_of_bounded_size(spark, sf_dir, written):
    rows = QUERIES["record_ids_folder"](spark, sf_dir).select("_record_id", "o_orderkey").collect()
    assert len(list(written.glob("orders/part=1/*.parquet"))) > 10
    assert [r["_record_id"] for r in sorted(rows, key=lambda r: r["o_orderkey"])] == list(range(1, 1501))


def test_a_stream_has_files_of_bounded_size_and_no_more_batches(spark, sf_dir, written):
    found = QUERIES["stream_copies"](spark, sf_dir).count()
    assert len(list(written.glob("lineitem-files/*.parquet"))) > 50
    assert len(list(written.glob("stream-copies/repeated_keys/LI-007/log/batch_id=*"))) == 3
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey", "l_linenumber").count()
    assert found == lines.filter("count > 1").agg({"count": "sum"}).first()[0]


def test_damaged_files_are_of_bounded_size(spark, sf_dir, written):
    good = {r["o_orderkey"] for r in QUERIES["csv_good_rows"](spark, sf_dir).collect()}
    assert len(list(written.glob("orders-csv/file=*"))) == 15
    assert all(len(f.read_text().splitlines()) == 101 for f in written.glob("orders-csv/file=*/*.txt"))
    assert good == {k for k in range(1500) if k % 11 and k % 7 and k % 13}
