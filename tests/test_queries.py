"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from tractlake.plans import registry

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6g}"
    if isinstance(value, list | tuple):
        return [plain(x) for x in value]
    return str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    got = sorted(str([plain(row[c]) for c in names]) for row in df.collect())
    if name not in registry.ORACLE:
        assert got
        return
    result = duck.execute(registry.ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == names
    want = sorted(str([plain(row[columns.index(c)]) for c in names]) for row in result.fetchall())
    assert got == want
