"""Every registered query against its SQL, on the given tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from millrace.registry import ORACLES, QUERIES

SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "decimal(12,2)": "DECIMAL(12,2)",
    "decimal(38,0)": "DECIMAL(38,0)",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def sorted_rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    found = df.collect()
    assert found
    if name not in ORACLES:
        return
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    assert sorted(df.columns) == sorted(columns)
    assert {f.name: SPARK_TO_SQL[f.dataType.simpleString()] for f in df.schema.fields} == types
    assert sorted_rows(df.columns, found) == sorted_rows(columns, result.fetchall())


def test_entry_points(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
