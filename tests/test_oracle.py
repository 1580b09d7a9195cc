"""Every query with oracle SQL must equal DuckDB on sf0.001 (the driver's gate, smaller)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402
from tests.conftest import SF001  # noqa: E402

# Slow here; test_experiments runs a small one.
SLOW = {"experiment_results"}
LLM = tuple(f"op{n}_" for n in range(1, 14))  # have their own tests
NAMES = sorted(n for n in set(E.oracle_sql()) - SLOW if not n.startswith(LLM))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF001, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]
