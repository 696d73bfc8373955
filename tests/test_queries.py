"""Every registered query against its oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tidewire.plans.fixtures import TABLES

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str([row[i] for i in order]) for row in rows)


def test_only_searches_without_a_definite_answer_lack_an_oracle():
    apart = {name for name in QUERIES if name.startswith("op") or name == "pipeline"}  # tested with their own part
    assert set(QUERIES) - set(ORACLES) - apart == set() and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(name for name in QUERIES if not name.startswith("op") and name != "pipeline"))
def test_query(spark, oracle, name):
    result = QUERIES[name](spark, SMALL)
    rows = comparable([tuple(r) for r in result.collect()], result.columns)
    if name not in ORACLES:
        assert rows
        return
    answer = oracle.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(result.columns) == sorted(columns)
    assert rows == comparable(answer.fetchall(), columns)


def test_entry(spark):
    assert entry.entry(spark).columns == ["raw_name", "canonical_name", "match_type", "score"]
