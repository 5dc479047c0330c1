import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from voltaic.session import local_session

    s = local_session(4, shuffle_partitions=4)
    yield s


def rows(df, order=None):
    """Collect as a sorted list of dicts (tests compare small results)."""
    out = [r.asDict() for r in df.collect()]
    key = order or sorted(out[0]) if out else None
    return sorted(out, key=lambda d: tuple(str(d[k]) for k in key)) if out else out
