import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from coldspot.session import checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app_name="coldspot-tests")
    checkpoint_dir(s)  # sets one of our own only where the session has none
    yield s


@pytest.fixture()
def tmp_dir():
    # A fresh folder per test; never cleared with rm.
    return tempfile.mkdtemp(prefix="coldspot-test-")


def rows(df, *cols):
    """Sorted tuples of the given columns (all when none)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
