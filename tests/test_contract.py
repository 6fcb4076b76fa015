"""Every query with SQL against the other engine, on the smallest tables."""

import datetime

import duckdb
import pytest

from tallyloom import plans

plans.load()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 8) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return [plain(x) for x in v] if isinstance(v, list) else v


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in plans.SQL:
        assert rows
        return
    out = duck.execute(plans.SQL[name])
    columns = [c[0] for c in out.description]
    assert sorted(columns) == sorted(df.columns)
    order = lambda have, r: tuple(plain(r[have.index(c)]) for c in sorted(have))
    assert sorted((order(df.columns, r) for r in rows), key=repr) == sorted((order(columns, r) for r in out.fetchall()), key=repr)
