"""Every venue query against its SQL at the smallest size."""

import duckdb
import numpy as np
import pandas as pd
import pytest

import venuegrid.plans.schedules  # noqa: F401  registers its queries with the catalog
from venuegrid.plans import catalog

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    return con


def plain(value):
    """A value of either engine: arrays as lists, what is missing as None."""
    if value is None or value is pd.NA:
        return None
    return [plain(x) for x in value] if isinstance(value, np.ndarray | list) else int(value) if isinstance(value, np.integer) else value


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, D).toPandas()
    if name not in catalog.ORACLE:
        assert len(got)
        return
    want = duck.execute(catalog.ORACLE[name]).df()
    cols = sorted(want.columns)
    assert cols == sorted(got.columns)
    order = lambda f: f[cols].astype(object).map(plain).astype(str).sort_values(cols).reset_index(drop=True)
    assert order(want).equals(order(got))
