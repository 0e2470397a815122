import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    base = tempfile.mkdtemp(prefix="spark-")
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.local.dir", base + "/local").config("spark.checkpoint.dir", f"file://{base}/shared").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    d = "/root/testdata/sf0.001"
    for f in os.listdir(d):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{d}/{f}'")
    return c


def rows(df):
    """Rows of a DataFrame, columns by name, in an order that nulls do not upset."""
    return ordered(tuple(r) for r in df.select(*(f"`{c}`" for c in sorted(df.columns))).collect())


def ordered(found):
    return sorted(found, key=lambda r: tuple((x is None, str(x)) for x in r))
