"""Every query against its SQL twin on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import rows

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(os.path.join(SF, "*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_a_twin():
    """But for the corpus operators that SQL cannot state, whose own tests hold them against
    plain versions."""
    assert set(ORACLE) <= set(QUERIES)
    assert all(name.startswith("op") or name == "pipeline" for name in set(QUERIES) - set(ORACLE))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    cursor = db.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(columns, cursor.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() >= 0
