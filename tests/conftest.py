import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from vintagewise.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions=4, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows(spark):
    """Rows of a frame as tuples, sorted."""
    return lambda df, *columns: sorted(
        (tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
