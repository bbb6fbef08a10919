"""Registered queries against their checking SQL on the smallest tables."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from trajlake.plans.registry import REGISTERED

SF = "/root/testdata/sf0.001"
# the two that take longest are compared on larger tables elsewhere
NAMES = sorted(n for n in entry.oracle_sql() if n in REGISTERED and n not in ("mean_force_by_sim", "bead_unlimited"))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("orders", "lineitem", "part", "events", "embeddings"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def table(columns, rows):
    order = sorted(columns)
    at = [columns.index(c) for c in order]
    clean = [tuple("NaN" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in at) for r in rows]
    return order, sorted(clean, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    found = duck.execute(entry.oracle_sql()[name])
    want = table([d[0] for d in found.description], found.fetchall())
    got = table(df.columns, [tuple(r) for r in df.collect()])
    assert got == want and got[1]


def test_every_query_is_callable():
    assert set(entry.oracle_sql()) <= set(entry.queries())
