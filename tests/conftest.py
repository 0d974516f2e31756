import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="spark-warehouse-")).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def duck(sf_dir: str, sql: str):
    """Rows of `sql` over the tables of `sf_dir`, as a sorted list, and its column names."""
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        if f.endswith(".parquet"):
            path = os.path.join(sf_dir, f)
            con.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    got = con.sql(sql)
    return got.columns, got.fetchall()


def same(df, sf_dir: str, sql: str) -> None:
    """Both engines give the same columns and the same rows in any order."""
    columns, rows = duck(sf_dir, sql)
    assert sorted(columns) == sorted(df.columns)
    shape = lambda rs: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rs), key=repr)
    left, right = shape(tuple(r) for r in df.select(*columns).collect()), shape(rows)
    assert len(left) == len(right)
    for a, b in zip(left, right, strict=True):
        assert a == b
