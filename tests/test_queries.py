"""Every registered query against its SQL on the smallest driver tables."""

import duckdb
import pytest
from conftest import SF

from __spark_entry__ import entry, oracle_sql, queries
from citeloom.plans.oracle import ORACLE
from citeloom.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {
    "INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def ordered(values):
    return sorted(values, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) == set(ORACLE)
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    result = duck.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    types = dict(zip(names, (TYPES[str(d[1])] for d in result.description)))
    assert sorted(names) == columns
    assert types == {f.name: f.dataType.simpleString() for f in df.schema}
    at = [names.index(c) for c in columns]
    expected = [tuple(r[i] for i in at) for r in result.fetchall()]
    assert ordered(got) == ordered(expected)
