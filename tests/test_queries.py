"""Every query of the registry against its SQL on the smallest tables."""

import math

import duckdb
import pytest

from captionloom.plans import oracle, registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return "nan" if math.isnan(v) else f"{float(v):.9g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, SF)
    if name not in oracle.SQL:
        assert df.count() > 0
        return
    want = con.sql(oracle.SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert rows == sorted(tuple(plain(r[k]) for k in at) for r in want.fetchall())
