"""Every registered query gives what its SQL gives."""

import math
import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from metricwatch.plans.oracle import ORACLE
from metricwatch.plans.queries import QUERIES

SF_DIR = os.environ.get("METRICWATCH_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.6f}")
    return value


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = database.execute(ORACLE[name])
    columns = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(columns)
    wanted = Counter(tuple(map(plain, row)) for row in expected.fetchall())
    found = Counter(tuple(plain(row[c]) for c in columns) for row in result.collect())
    assert sum(wanted.values()) > 0
    missing, extra = list((wanted - found).items()), list((found - wanted).items())
    assert not missing and not extra, (missing[:3], extra[:3])
