"""Every registered query of the engine against DuckDB on the smallest tables."""

import pytest

from conftest import ordered, rows
from ledgerloom.plans import queries as plans

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    got = rows(df)
    if name not in plans.ORACLES:
        assert got
        return
    r = duck.execute(plans.ORACLES[name])
    columns = [x[0] for x in r.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    assert sorted(df.columns) == sorted(columns)
    assert got == ordered(tuple(x[k] for k in order) for x in r.fetchall())


def test_signers_of_all_checkpoints(spark):
    import duckdb

    d = "/root/testdata/sf0.01"
    c = duckdb.connect()
    for t in ("orders", "lineitem", "part", "supplier"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    r = c.execute(plans.ORACLES["signer_stake"])
    columns = [x[0] for x in r.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    got = rows(plans.QUERIES["signer_stake"](spark, d))
    assert got == ordered(tuple(x[k] for k in order) for x in r.fetchall())
    assert len(got) == c.execute("SELECT count(DISTINCT floor(o_orderkey / 10)) FROM orders").fetchone()[0] > 200


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(e.oracle_sql()) <= set(e.queries())
