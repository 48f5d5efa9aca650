import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from almoner.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[4]", spark__sql__shuffle__partitions=4, spark__ui__enabled="false", spark__driver__memory="4g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Collect a frame as a list of tuples sorted by their text."""

    def collect(df, *names):
        picked = df.select(*names) if names else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
