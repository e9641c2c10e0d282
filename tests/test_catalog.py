"""Every registered query against its SQL at the smallest scale."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name not in entry.oracle_sql():
        assert rows
        return
    found = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_entry(spark):
    assert entry.entry(spark).count() > 0
