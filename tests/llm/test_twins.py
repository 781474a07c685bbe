"""The operators' queries against their SQL twins."""

import duckdb
import pytest

from adstrata.llm import oracle, queries

ORACLE = oracle.oracle_sql()
TABLES = "documents embeddings pages benchmark labels conversations".split()


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = queries.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = con.execute(ORACLE[name])
    described = [d[0] for d in result.description]
    assert sorted(described) == columns
    at = [described.index(c) for c in columns]
    expected = sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=str)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str) == expected and expected
