"""Every registered query against its SQL oracle on the whole tables."""

import datetime
import math
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from tillroll.registry.oracles import ORACLES
from tillroll.registry.queries import QUERIES

TABLES = ("nation", "customer", "part", "orders", "lineitem")
SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _bag(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(name, spark, duck):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = duck.sql(ORACLES[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    ours_bag = _bag(ours.columns, ours.collect())
    theirs_bag = _bag(theirs.columns, theirs.fetchall())
    assert ours_bag.total() > 0
    assert ours_bag == theirs_bag
