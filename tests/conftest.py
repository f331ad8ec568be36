import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventide.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="eventide-tests", shuffle_partitions=4,
                    extra={"spark.local.dir": tempfile.mkdtemp(prefix="eventide-test-local-")})
    yield s
    s.stop()


def rows(df, *cols):
    """Collect a (small, test-only) DataFrame as sorted tuples."""
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
