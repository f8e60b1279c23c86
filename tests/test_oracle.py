"""Every registered query against its SQL oracle (the driver's correctness gate), on the smallest test data."""

import pytest

import __spark_entry__ as entry_mod
from monthplan.plans import catalog
from monthplan.plans.compare import compare, duck
from monthplan.plans.oracle import oracle_sql

from conftest import MEDIUM, SMALL

QUERIES = catalog.QUERIES
ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def cons():
    return {SMALL: duck(SMALL), MEDIUM: duck(MEDIUM)}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM])  # sf0.01 is the driver's gate
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, cons, name, sf_dir):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = cons[sf_dir].execute(ORACLE[name]).df()
    r = compare(got, want)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["stockorg_code", "sku_code", "dt", "begin_stock_qty", "demand_qty", "production_qty",
                          "trans_in_qty", "trans_out_qty", "safety_stock_qty", "todo_qty", "end_stock_qty"]
    assert df.count() > 0
