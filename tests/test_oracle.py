"""Every registered query of the engine's own operators against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from casemill.plans import queries

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) if not isinstance(v, (bool, str)) else v


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    if name not in queries.ORACLE_SQL:
        assert got
        return
    cursor = duck.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == names
    assert got == sorted((tuple(plain(dict(zip(columns, r))[c]) for c in names) for r in cursor.fetchall()), key=repr)
