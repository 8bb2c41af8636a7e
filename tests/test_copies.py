"""Queries on several copies of the tables with shifted keys, against their check SQL."""

import duckdb
import pytest

from conftest import SMALL
from oracle_check import compare, duck
from tidemark.bindings import BASE_TABLES

KEYS = {
    "customer": {"c_custkey": "customer"},
    "supplier": {"s_suppkey": "supplier"},
    "part": {"p_partkey": "part"},
    "orders": {"o_orderkey": "orders", "o_custkey": "customer"},
    "lineitem": {"l_orderkey": "orders", "l_partkey": "part", "l_suppkey": "supplier"},
    "events": {"event_id": "events"},
}


@pytest.fixture(scope="module")
def copies(tmp_path_factory):
    """Three copies of the smallest tables."""
    out, con = tmp_path_factory.mktemp("copies"), duckdb.connect()
    n = {t: con.execute(f"select count(*) from '{SMALL}/{t}.parquet'").fetchone()[0] for t in KEYS}
    for t in BASE_TABLES:
        shifted = ", ".join(f"{c} + r * {n[of]} as {c}" for c, of in KEYS.get(t, {}).items())
        rows = f"select * from '{SMALL}/{t}.parquet'"
        if t == "events":  # two events a user, so that some users only have low sequences
            shifted += f", event_id * 7 % {n[t] // 2} + r * {n[t]} as user_id"
        if shifted:
            rows = f"select s.* replace ({shifted}) from ({rows}) s, (select unnest(range(3)) as r)"
        con.execute(f"copy ({rows}) to '{out}/{t}.parquet'")
    return str(out)


@pytest.mark.parametrize("name", ["d04_versioned_silver"])
def test_query_on_copies(spark, copies, name):
    assert compare(spark, duck(copies), name, copies) is None
