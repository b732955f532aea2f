"""Every registered query against its SQL on the smallest tables."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from tidemark.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canon(frame: pd.DataFrame):
    def cell(v):
        if v is None or (not isinstance(v, (list, np.ndarray)) and pd.isna(v)):
            return "NULL"
        if isinstance(v, (int, float, bool, np.number, np.bool_)):
            return format(float(v) + 0.0, ".6f").replace("-0.000000", "0.000000")
        return str(v)

    return sorted(tuple(map(cell, r)) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_oracle(name, spark, duck, sf_dir):
    ours, theirs = registry.QUERIES[name](spark, sf_dir).toPandas(), duck.sql(registry.ORACLE[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canon(ours) == canon(theirs)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_runs(name, spark, sf_dir):
    assert registry.QUERIES[name](spark, sf_dir).count() >= 0
