import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        spark__sql__streaming__stateStore__stateSchemaCheck="true",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def wh(spark):
    from tidemark.catalog.registry import warehouse

    return warehouse(spark, SMALL)


def rows(df, *order):
    """Rows as tuples, sorted by text so that nulls sort too."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
