"""Queries with check SQL equal it on the small tables."""

import pytest
from conftest import SMALL
from oracle_check import compare, duck

from tidemark.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    con = duck(SMALL)
    for table in ("documents", "pages", "conversations"):
        con.execute(f"create or replace view {table} as select * from '{SMALL}/{table}.parquet'")
    assert compare(spark, con, name, SMALL) is None
