"""Every query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from solidspark.plans import carrier

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(frame):
    frame = frame[sorted(frame.columns)]
    rows = frame.astype(object).where(frame.notna(), None).values.tolist()
    return list(frame.columns), sorted(repr([float(v) if isinstance(v, float) else str(v) for v in r]) for r in rows)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
@pytest.mark.parametrize("name", sorted(carrier.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert normal(carrier.queries()[name](spark, SF).toPandas()) == normal(duck.sql(carrier.SQL[name]).df())


def test_entry(spark):
    assert entry.entry(spark).count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries())
