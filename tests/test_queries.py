"""Every registered query against its SQL twin on the same tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from workload import oracle as workload_oracle
from workload import queries as workload_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = workload_queries.queries()
ORACLE = workload_oracle.oracle_sql()
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "array<string>": "VARCHAR[]",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return str(list(value)) if isinstance(value, (list, tuple)) else value


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = duck.execute(ORACLE[name])
    described = {d[0]: str(d[1]) for d in result.description}
    assert sorted(described) == columns
    for field in df.schema.fields:
        assert TYPES[field.dataType.simpleString()] == described[field.name], field.name
    order = [list(described).index(c) for c in columns]
    expected = sorted(
        (tuple(plain(row[i]) for i in order) for row in result.fetchall()), key=str
    )
    got = sorted((tuple(plain(row[c]) for c in columns) for row in df.collect()), key=str)
    assert got == expected and got


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
