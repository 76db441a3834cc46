"""Every registered query against its check SQL on the smallest tables."""

import pytest
from conftest import SMALL

import __spark_entry__ as contract
from ledgerloom.queries import ORACLE_SQL, QUERIES

CHECKS = contract.oracle_sql()


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row])


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_agrees_with_sql(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    result = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    expected = duck.execute(CHECKS[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == columns
    expected = [tuple(r[names.index(c)] for c in columns) for r in expected.fetchall()]
    assert ordered(result) == ordered(expected)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLE_SQL) <= set(CHECKS)


def test_entry_has_the_report_columns(spark):
    assert len(contract.entry(spark).columns) == 71
