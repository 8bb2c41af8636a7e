"""Every registered query equals its check SQL on the smallest data set."""

import pytest
from conftest import SMALL
from oracle_check import compare, duck

import __spark_entry__ as entry
import tidemark.catalog as catalog


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, SMALL) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "id", "clinic_key", "clinic_name", "month_start_date_key", "number_booking",
    ]
    assert df.limit(1).count() == 1


def test_every_query_has_check_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES) <= set(entry.oracle_sql())


def test_names():
    for name in catalog.QUERIES:
        assert "pipeline" not in name and not name.startswith("op")
