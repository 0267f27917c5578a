import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session

    s = local_session(4, app="tessera-tests")
    yield s


def rows(df, *cols):
    """Collect a (small, test-only) result as sorted tuples."""
    sel = df.select(*cols) if cols else df
    return sorted([tuple(r) for r in sel.collect()], key=lambda t: tuple((x is None, x) for x in t))
