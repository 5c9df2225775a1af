"""Every query with oracle SQL agrees with DuckDB on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from layoutlake.plans.catalogue import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def rows(columns, data):
    def value(v):
        return round(v, 6) + 0.0 if isinstance(v, float) and not math.isnan(v) else v

    return sorted((tuple(value(r[c]) for c in columns) for r in data), key=repr)


def same(a, b):
    return len(a) == len(b) and all(x == y or isinstance(x, (int, float)) and isinstance(y, (int, float)) and math.isclose(x, y, abs_tol=1e-6) or str(x) == str(y) for r, s in zip(a, b) for x, y in zip(r, s))


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cur = duck.execute(SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    got = sorted(([r[c] for c in columns] for r in df.collect()), key=lambda r: [str(v) for v in r if not isinstance(v, float)])
    want = sorted((list(r) for r in cur.fetchall()), key=lambda r: [str(v) for v in r if not isinstance(v, float)])
    assert len(got) == len(want)
    key = lambda r: repr([round(float(v), 5) if isinstance(v, (int, float)) or hasattr(v, "as_integer_ratio") and not isinstance(v, bool) else str(v) for v in r])
    assert sorted(map(key, got)) == sorted(map(key, want))


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_partitions_do_not_matter(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    want = sorted(map(tuple, QUERIES["q13_assign_margin"](spark, SF).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert sorted(map(tuple, QUERIES["q13_assign_margin"](spark, SF).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
