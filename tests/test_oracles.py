"""Every core query with an oracle gives DuckDB's rows on the smallest tables."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from caseflux.plans import catalog

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def rows_of(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
            return "null"
        if isinstance(v, (bool, np.bool_)):
            return str(bool(v))
        if isinstance(v, (int, float, np.integer, np.floating)):
            return f"{float(v):.6g}"
        return str(v)

    df = df.reindex(sorted(df.columns), axis=1)
    return sorted(tuple(plain(v) for v in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_gives_the_oracles_rows(spark, duck, name):
    mine = catalog.QUERIES[name](spark, FOLDER).toPandas()
    theirs = duck.execute(catalog.ORACLES[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows_of(mine) == rows_of(theirs)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_oracle_runs(spark, name):
    rows = catalog.QUERIES[name](spark, FOLDER)
    assert rows.columns and rows.count() >= 0


@pytest.mark.parametrize("name", ["j14_candidate_pairs", "j15_fuzzy_pairs"])
def test_pairs_of_blocks_that_are_cut_into_parts(spark, duck, monkeypatch, name):
    from caseflux.plans import dedupe

    monkeypatch.setattr(dedupe, "BLOCK_ROWS", 3)
    mine = catalog.QUERIES[name](spark, FOLDER)
    # no distinct over the pairs on their way out
    assert not mine._jdf.queryExecution().optimizedPlan().toString().startswith("Aggregate")
    assert rows_of(mine.toPandas()) == rows_of(duck.execute(catalog.ORACLES[name]).df())
