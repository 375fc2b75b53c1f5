import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from claimwise.session import local_session

    s = local_session(4, shuffle_partitions=4, app="claimwise-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as sorted list of tuples (optionally selecting columns)."""
    if cols:
        df = df.select(*cols)
    return sorted(tuple(r) for r in df.collect())
