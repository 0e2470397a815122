"""Queries of the subpackage that SQL can express, against DuckDB."""

import pytest

from conftest import ordered, rows
from ledgerloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    r = duck.execute(queries.oracle_sql()[name])
    columns = [x[0] for x in r.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    assert sorted(df.columns) == sorted(columns)
    assert rows(df) == ordered(tuple(x[k] for k in order) for x in r.fetchall())
