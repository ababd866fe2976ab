"""Every registered query of the library runs on the smallest tables and equals its SQL there."""

import os

import duckdb
import pytest

import fleetlens.plans.registry as registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return c


def rows(pdf):
    return sorted(map(str, pdf[sorted(pdf.columns)].itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    assert len(got.columns) == len(set(got.columns))
    if name in registry.ORACLES:
        want = duck.sql(registry.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got)
