import os
import sys
from collections import Counter

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(home / "warehouse")).config("spark.checkpoint.dir", f"file://{home}/shared").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def _plain(v):
    if isinstance(v, float):
        return round(v, 9)
    return tuple(map(_plain, v)) if isinstance(v, list | tuple) else v


def rows_of(df, columns=None):
    columns = columns or sorted(df.columns)
    return Counter(tuple(_plain(x) for x in r) for r in df.select(columns).collect())


@pytest.fixture(scope="session")
def same_as_sql():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{DATA}/{f}')")

    def check(df, sql):
        r = con.execute(sql)
        names = [c[0] for c in r.description]
        assert sorted(names) == sorted(df.columns)
        want = Counter(tuple(_plain(x[names.index(c)]) for c in sorted(names)) for x in r.fetchall())
        got = rows_of(df)
        assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])

    return check
