"""Registered queries of this part against their SQL, on the smallest tables."""

import duckdb
import pytest

from tests.conftest import SMALL
from tests.test_queries import comparable
from tidewire.llm import registry


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    result = registry.QUERIES[name](spark, SMALL)
    answer = connection.execute(registry.ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(result.columns)
    assert comparable([tuple(r) for r in result.collect()], result.columns) == comparable(answer.fetchall(), columns)


def test_personal_data_query_has_the_patterns_columns(spark):
    from tests.llm.test_models import brute_personal

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for row in registry.QUERIES["op1_pii"](spark, SMALL).collect():
        base = brute_personal(texts[row.doc_id])
        assert [row[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(b[0] == k for b in base) for k in ("email", "ip", "card", "phone")]
        named = [":".join(map(str, b)) for b in base]
        assert set(filter(None, row.spans.split(","))) >= set(named)
        import hashlib
        assert row.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
