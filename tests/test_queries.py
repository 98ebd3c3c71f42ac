"""Every query with SQL gives the rows that DuckDB gives."""

import os

import duckdb
import pytest

from corpusloom.plans.catalog import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows):
    return sorted([tuple(v if v is None or isinstance(v, (str, bool)) else round(float(v), 6) for v in r) for r in rows], key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_rows_equal_sql(spark, con, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.sql(ORACLE_SQL[name]).select(*(f'"{x}"' for x in columns)).fetchall()
    assert plain(map(tuple, got.select(*columns).collect())) == plain(want) and want
