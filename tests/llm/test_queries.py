import duckdb
import pytest

from hourgrid.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    with duckdb.connect() as other:
        for table in ("documents", "embeddings", "pages", "benchmark", "labels"):
            other.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        want = other.execute(ORACLE[name])
        columns = [c[0] for c in want.description]
        rows = sorted(map(str, want.fetchall()))
    got = QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(str(tuple(r)) for r in got.select(*columns).collect()) == rows
