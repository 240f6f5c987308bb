import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from tidemill import plans


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def plain(x):
    if isinstance(x, float) and not math.isnan(x):
        return float(f"{x:.10g}")
    return x.replace(tzinfo=None) if hasattr(x, "tzinfo") else x


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in plans.ORACLE_SQL:
        assert rows
        return
    con = duck.execute(plans.ORACLE_SQL[name])
    names = [d[0] for d in con.description]
    assert sorted(names) == sorted(df.columns)
    mine = sorted((tuple(plain(r[c]) for c in names) for r in rows), key=repr)
    assert mine == sorted((tuple(map(plain, r)) for r in con.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 55
