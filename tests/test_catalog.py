"""Every query with SQL against DuckDB on the small tables."""

import duckdb
import numpy as np
import pytest

from marlstone.plans import catalog

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, con, name):
    got, want = catalog.QUERIES[name](spark, D).toPandas(), con.sql(catalog.ORACLES[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns) and len(got) == len(want)
    by = [c for c in cols if got[c].dtype.kind != "f"] + [c for c in cols if got[c].dtype.kind == "f"]
    a, b = (x[cols].sort_values(by).reset_index(drop=True) for x in (got, want))
    for c in cols:
        if a[c].dtype.kind == "f":
            assert np.allclose(a[c], b[c].astype(float), rtol=1e-9, atol=1e-12, equal_nan=True), c
        else:
            assert ((a[c] == b[c]) | (a[c].isna() & b[c].isna())).all(), c
