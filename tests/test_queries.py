"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as contract
from sievemark.plans import oracles
from sievemark.plans import queries as registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_each_query_has_its_sql():
    assert set(registry.registered()) == set(oracles.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows]
    return sorted(columns), sorted(plain, key=repr)


@pytest.mark.parametrize("name", sorted(registry.registered()))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    result = duck.execute(contract.oracle_sql()[name])
    expected = _rows([d[0] for d in result.description], result.fetchall())
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == expected
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}
    types = {d[0]: str(d[1]) for d in duck.execute(contract.oracle_sql()[name]).description}
    for column, kind in df.dtypes:
        assert types[column] in (kinds[kind], "NUMBER", "STRING", "bool", "BOOL"), column


def test_entry(spark):
    assert contract.entry(spark).count() == 4
