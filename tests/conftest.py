import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from paneltide.session import local_session

    s = local_session("*", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    """Collect selected columns as a list of tuples, in DataFrame order."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
