"""Queries that SQL can express, against that SQL over whole tables."""

import duckdb
import pytest

from farebox.llm import registry

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("key", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, key):
    base = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "conversations"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = base.execute(registry.oracle_sql()[key])
    names = [c[0] for c in cursor.description]
    df = registry.queries()[key](spark, SF)
    assert sorted(df.columns) == sorted(names)
    rows = lambda found: sorted(map(tuple, found), key=str)
    assert rows(df.select(names).collect()) == rows(cursor.fetchall())


def test_all_queries_are_there():
    names = list(registry.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
