"""Every query against its SQL in DuckDB, as sets of rows with equal columns and values."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from fixtures.contract import QUERIES

DATA = os.environ.get("CONTRACT_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer part orders lineitem documents embeddings conversations labels benchmark".split()
FITTED = {"ml_metrics", "feature_importance", "late_risk_scores"}


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}") + 0.0
    return value


def as_set(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(normal(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    return connection


def test_only_fitted_models_lack_sql():
    assert set(QUERIES) - set(contract.oracle_sql()) == FITTED
    assert set(QUERIES) | set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(name, spark, duck):
    table = contract.queries()[name](spark, DATA)
    answer = duck.execute(contract.oracle_sql()[name])
    columns, expected = as_set([column[0] for column in answer.description], answer.fetchall())
    types = [str(column[1]) for column in answer.description]
    actual_columns, actual = as_set(table.columns, [tuple(row) for row in table.collect()])
    assert actual_columns == columns
    assert not [t for t in types if "HUGEINT" in t or "DECIMAL" in t], types
    assert sum(actual.values()) == sum(expected.values()) > 0
    assert not list((actual - expected).items())[:3], list((expected - actual).items())[:3]


@pytest.mark.parametrize("name", sorted(FITTED))
def test_fitted_query_has_rows(name, spark):
    assert contract.queries()[name](spark, DATA).count() > 0


def test_entry(spark):
    table = contract.entry(spark)
    assert table.columns[0] == "shipping_mode" and table.count() == 5
