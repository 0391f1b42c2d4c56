"""Every query with a SQL statement must equal it row by row."""

import pytest

from checks.compare import differences, duck
from checks.oracle import oracle
from loanpanel.plans.queries import all_queries

ORACLE = oracle()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, sf, con, name):
    got = all_queries()[name](spark, sf).toPandas()
    assert len(got.columns) > 0
    if name in ORACLE:
        assert differences(got, con.execute(ORACLE[name]).df()) is None
    else:
        assert len(got) > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(all_queries())


def test_entry_reads_the_tables(spark):
    import __spark_entry__ as e
    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
