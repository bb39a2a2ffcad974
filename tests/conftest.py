import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def compare():
    """Holds a query against its SQL over one folder: rows, columns and values, whatever the order."""
    import duckdb

    open_: dict = {}

    def db(folder):
        if folder not in open_:
            c = duckdb.connect()
            c.execute("set timezone='UTC'")
            for f in sorted(os.listdir(folder)):
                c.execute(f"create view {f[:-8]} as select * from '{folder}/{f}'")
            open_[folder] = c
        return open_[folder]

    def text(v):
        if v is None or v != v:
            return "null"
        return f"{v:.6g}" if isinstance(v, float) else str(v)

    def check(df, sql, folder):
        rel = db(folder).execute(sql)
        names = [x[0] for x in rel.description]
        order = sorted(names)
        assert sorted(df.columns) == order
        want = sorted(tuple(text(r[names.index(c)]) for c in order) for r in rel.fetchall())
        got = sorted(tuple(text(r[c]) for c in order) for r in df.collect())
        assert len(got) == len(want)
        assert got == want

    return check
