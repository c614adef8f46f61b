"""Every query beside its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from wickwork.plans import catalogue

SF = "/root/testdata/sf0.01"


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_against_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted(str([plain(r[c]) for c in columns]) for r in df.collect())
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    theirs = sorted(str([plain(r[names.index(c)]) for c in columns]) for r in result.fetchall())
    assert sorted(names) == columns and ours == theirs


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["feature", "VIF"] and df.count() == 112


def test_all_have_sql_but_the_flagship():
    assert set(catalogue.QUERIES) - set(catalogue.ORACLE) == {"pipeline_features_vif"}


def test_candles_are_one_shuffle(spark):
    plan = catalogue.QUERIES["candles_1h"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "props" not in plan
