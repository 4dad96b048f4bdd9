"""Every query beside its SQL on the smallest tables."""

import datetime
import decimal

import duckdb
import pytest

from ledgerlark.plans.catalogue import QUERIES, SQL


def plain(v):
    if isinstance(v, float):
        return round(v, 5)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 5)
    return str(v) if isinstance(v, (list, datetime.date)) else v


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events embeddings documents".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert rows
    if name in SQL:
        result = duck.execute(SQL[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        assert sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=repr) == rows
