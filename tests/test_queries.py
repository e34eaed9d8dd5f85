"""Every registered query against its SQL on an independent engine."""

import math

import duckdb
import pytest

import __spark_entry__ as registry
from ridelake.catalogue.oracle import ORACLE
from ridelake.catalogue.queries import QUERIES

TABLES = ("orders", "events")


@pytest.fixture(scope="module")
def engine(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def canonical(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(round(value, 9))
        return str(value)

    return sorted(tuple(plain(r[i]) for i in order) for r in records)


def test_registry_is_consistent():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert set(QUERIES) - set(ORACLE) == {"footprint"}
    assert set(QUERIES) <= set(registry.queries()) and set(ORACLE) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, engine, name):
    df = QUERIES[name](spark, sf_dir)
    got = canonical(df.collect(), df.columns)
    sql = ORACLE.get(name)
    if sql is None:
        assert got
        return
    result = engine.execute(sql)
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == canonical(result.fetchall(), columns)


def test_entry(spark):
    top = registry.entry(spark)
    assert top.columns == ["month", "station_id", "trips"] and top.count() > 0
