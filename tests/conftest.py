import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from bibgraph.session import build_session, checkpoint_dir

    s = build_session(master="local[4]", partitions=4, app="bibgraph-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (all columns, or the given ones)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
