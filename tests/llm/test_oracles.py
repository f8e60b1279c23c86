"""Queries that SQL can express, against their SQL."""

import pytest
from conftest import MEDIUM, SMALL
from monthplan.llm.queries import ORACLE_SQL, QUERIES
from monthplan.plans.compare import compare, duck


@pytest.mark.parametrize("sf_dir", [SMALL, MEDIUM])
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name, sf_dir):
    got = compare(QUERIES[name](spark, sf_dir).toPandas(), duck(sf_dir).execute(ORACLE_SQL[name]).df())
    assert got["columns_match"] and got["values_match"], got


def test_registered_with_the_other_queries():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())
