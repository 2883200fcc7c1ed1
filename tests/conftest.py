import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from balances.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app="balances-tests")
    yield s


def rows(df, *cols):
    """Collect a small test result as a list of tuples ordered by ``cols``."""
    out = df.orderBy(*cols).collect() if cols else df.collect()
    return [tuple(r) for r in out]
