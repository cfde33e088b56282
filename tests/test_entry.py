"""Driver contract: entry() runs, every oracle has a query, a sample of queries match DuckDB at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem embeddings".split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert set(df.columns) == {"days_to_delivery", "perc_returned", "total_items"}


def test_oracles_have_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.oracle_sql()) >= 50


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "date") and hasattr(v, "hour"):
        return v.date()
    return v


@pytest.mark.parametrize("name", ["color_family", "size_bucket", "order_stats", "return_history", "join_orders",
                                  "rate_by_weekday", "cutoff_sweep", "population_fitness", "knn_vote"])
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    d = con.execute(E.oracle_sql()[name]).fetchdf()
    want = sorted((tuple(_norm(None if (isinstance(x, float) and x != x) else (x.to_pydatetime() if hasattr(x, "to_pydatetime") else x))
                         for x in rec) for rec in d[cols].itertuples(index=False)), key=repr)
    assert len(got) == len(want)
    assert [tuple(map(str, g)) for g in got] == [tuple(map(str, w)) for w in want]
