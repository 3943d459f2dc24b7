"""Every registered query of the library against its SQL on the smallest tables."""

import os

import pytest

from eligo.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def plain(frame):
    import pandas as pd

    cell = lambda v: "" if pd.isna(v) else repr(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    columns = sorted(frame.columns)
    return columns, sorted(tuple(map(cell, r)) for r in frame[columns].astype(object).itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split():
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name in ORACLES:
        assert plain(got) == plain(duck.sql(ORACLES[name]).df())
    else:
        assert len(got)
