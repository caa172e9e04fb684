"""Every registered query against an independent engine on the same files."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as registered
from roundhaul.plans.oracles import ORACLES
from roundhaul.plans.queries import QUERIES

NAMES = sorted(QUERIES)


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    if isinstance(value, (int, Decimal)):
        return Decimal(value).normalize()
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    kept = [tuple(plain(row[i]) for i in order) for row in data]
    return sorted(columns), sorted(kept, key=repr)


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= registered.queries().items()
    assert ORACLES.items() <= registered.oracle_sql().items()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, database, sf_dir, name):
    found = registered.queries()[name](spark, sf_dir)
    expected = database.execute(registered.oracle_sql()[name])
    wanted = rows([c[0] for c in expected.description], expected.fetchall())
    got = rows(found.columns, found.collect())
    assert got[0] == wanted[0]
    assert len(got[1]) == len(wanted[1])
    assert got[1] == wanted[1]


def test_entry(spark):
    result = registered.entry(spark).first()
    assert result["total_rows"] == 1500
