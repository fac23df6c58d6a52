import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from carelattice.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", shuffle_partitions=4, memory="6g", app="tests")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""

    def collect(df, *columns):
        found = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in found.collect()), key=repr)

    return collect
