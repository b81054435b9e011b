"""Every query with SQL returns the same rows, names and types as that SQL."""

import compare
import pytest

from punctual.plans.oracle import oracle_sql
from punctual.plans.queries import queries


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, small, medium, con, name):
    # the range of the AUC holds from 60,000 flights on
    folder = medium if name == "gbt_train" else small
    con = compare.connect(medium) if name == "gbt_train" else con
    df, sql = queries()[name](spark, folder), oracle_sql()[name]
    assert compare.kinds(df, con, sql) == {}
    assert compare.spark_rows(df) == compare.sql_rows(con, sql)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 6
