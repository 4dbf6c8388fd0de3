import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    s = build_session("local[4]", 8, app_name="strata-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (order-insensitive compare)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
