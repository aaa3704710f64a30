import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pitchside.session import build_session, checkpoint_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="pitchside-warehouse-")
    s = build_session("pitchside-tests", master="local[4]", shuffle_partitions=4,
                      conf={"spark.sql.warehouse.dir": warehouse})
    checkpoint_root(s)  # picks a local folder only when spark.checkpoint.dir is unset
    yield s
    s.stop()


def rows(df, *order):
    """Collected rows as plain tuples, sorted for order-insensitive comparison."""
    out = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return out if order else sorted(out, key=repr)
