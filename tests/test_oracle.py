"""Every query with an SQL counterpart gives the same rows as an independent engine."""

import os

import pytest

import __spark_entry__ as entry
from conftest import DATA
from hourgrid.plans.oracle import ORACLE
from hourgrid.plans.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
FOLDER = f"{DATA}/sf0.01"
# Trees of many levels have no SQL; their parts have.
TREES = {"gbt_metrics", "gbt_trials", "gbt_importance", "gbt_predictions", "gbt_default_predictions", "actual_vs_predicted"}
MEASURES = {"entries", "total_entries", "avg_entries", "upper_cap", "mae", "value", "transfers"}


@pytest.fixture(scope="module")
def other_engine():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{file}'")
    return con


def canonical(df):
    df = df[sorted(df.columns)].copy()
    for column in df.columns:
        kind = str(df[column].dtype)
        if kind.startswith("datetime"):
            df[column] = df[column].astype("datetime64[us]").astype(str)
        elif kind in ("object", "str", "string", "bool"):
            df[column] = df[column].astype(str)
        else:
            df[column] = df[column].astype(float)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLE)))
def test_rows_agree(spark, other_engine, name):
    import pandas

    ours = canonical(QUERIES[name](spark, FOLDER).toPandas())
    theirs = canonical(other_engine.execute(ORACLE[name]).df())
    assert list(ours.columns) == list(theirs.columns)
    pandas.testing.assert_frame_equal(ours, theirs, check_dtype=False, rtol=0, atol=1e-6)
    # Zeros against zeros would prove nothing.
    for column in MEASURES & set(ours.select_dtypes("number").columns):
        assert len(ours) == 1 or ours[column].nunique() > 1, f"all values of {column} are equal"
        assert ours[column].abs().max() > 0


def test_every_query_but_the_trees_has_sql():
    assert set(QUERIES) - set(ORACLE) == TREES and not set(ORACLE) - set(QUERIES)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [r.model for r in rows] == ["rolling_avg_24h", "naive"] and all(r.mae > 0 for r in rows)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
