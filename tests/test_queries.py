import os

import duckdb
import pytest

import __spark_entry__ as entry
from tilewright.plans import catalog
from tools.compare import TABLES, canonical


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_against_sql(spark, sf_dir, duck, name):
    got = catalog.QUERIES[name](spark, sf_dir).toPandas()
    want = duck.execute(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry(spark, sf_dir):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_kernel_queries_give_a_row_for_each_plane(spark, sf_dir, name):
    rows = catalog.QUERIES[name](spark, sf_dir).collect()
    assert len(rows) == len({r.plane for r in rows}) > 0
    assert any(r.error_type is None for r in rows)
