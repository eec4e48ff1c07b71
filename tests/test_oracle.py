"""Every query against its SQL, on whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from plumbline.plans.oracle import ORACLE
from plumbline.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return [(v is None, str(type(v)), str(v)) for v in row]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, sql, name):
    df = QUERIES[name](spark, sf_dir)
    order = sorted(df.columns)
    mine = sorted([[r[c] for c in order] for r in df.collect()], key=_key)
    if name not in ORACLE:
        assert mine
        return
    cursor = sql.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == order
    places = [columns.index(c) for c in order]
    theirs = sorted([[r[i] for i in places] for r in cursor.fetchall()], key=_key)
    assert mine == theirs


def test_entry(spark):
    assert entry_point.entry(spark).count() == 15
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
