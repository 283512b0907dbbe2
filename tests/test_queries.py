"""Every registered query of the cohort operators against its SQL twin in DuckDB, on the smallest tables."""

import decimal
import os

import duckdb
import pytest

from cohortloom import registry
from cohortloom.fixtures import TABLES
from conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{SMALL}/{t}.parquet"
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return c


def canonical(rows, columns):
    def text(v):
        if isinstance(v, (float, decimal.Decimal)):
            return f"{float(v):.6g}"
        return v.isoformat()[:19] if hasattr(v, "isoformat") else repr(v)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SMALL)
    want = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(registry.QUERIES.keys() - registry.ORACLE_SQL.keys()))
def test_query_without_sql_has_rows(spark, name):
    assert registry.QUERIES[name](spark, SMALL).limit(1).count() == 1
