"""Every registered query against its DuckDB oracle on the smallest tables
(row count, column names, order-insensitive value hash)."""

import duckdb
import pytest

import __spark_entry__ as E
from sectionmap.oracle import all_sql
from sectionmap.queries import all_queries
from sectionmap.sources.fixtures import BASE_TABLES
from tests.conftest import SF001
from tools.oracle_check import digest
from tools.type_check import NORM

QUERIES = all_queries()
SQL = all_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    otypes = dict(zip(rel.columns, (str(t) for t in rel.types)))
    stypes = {f.name: NORM.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) for f in df.schema.fields}
    assert stypes == otypes
    cur = con.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["map_id"] and df.count() > 0
