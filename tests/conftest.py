import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgermill.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, 4)


@pytest.fixture
def sf():
    return SF


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *columns):
        df = df.select(*[f"`{c}`" for c in columns]) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
