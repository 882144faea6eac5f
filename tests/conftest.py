import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from snaplake.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="snaplake-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all columns by default)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))
