import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from oracle import session
    from tallyhouse.session import configure

    s = configure(session())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows(spark):
    """Sorted rows of a frame as plain tuples."""

    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)

    return collect
