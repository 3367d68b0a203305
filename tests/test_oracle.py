"""Every registered query of the engine against its SQL, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from quern.plans import registry

AT = os.environ.get("ORACLE_SF", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{AT}/{t}.parquet'")
    return con


def rows(frame: pd.DataFrame) -> list[str]:
    frame = frame[sorted(frame.columns)]
    show = lambda v: "null" if pd.isna(v) else f"{v:.6g}" if isinstance(v, float) else str(int(v)) if isinstance(v, (bool,)) else str(v)
    return sorted("|".join(map(show, r)) for r in frame.astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    got = registry.QUERIES[name](spark, AT).toPandas()
    if name not in registry.ORACLE:
        assert len(got.columns)
        return
    want = con.execute(registry.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
    assert len(got)
